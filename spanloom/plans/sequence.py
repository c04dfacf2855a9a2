"""Queries over ordered events, conversations and lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.functions.time import micros
from spanloom.operators import sequence as seq

from .registry import register
from .relational import table

HOUR = 3_600_000_000
ORDER = ["t", "event_id"]


def events(spark, sf):
    return table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "props", micros("ts").alias("t"))


_E = "with e as (select event_id, user_id, event_type, value, props, epoch_us(ts) t from events)"


@register("q_runs", _E + """,
b as (select *, case when lag(t) over w is null or event_type = 'error' or t - lag(t) over w >= 28800000000 then 1 else 0 end s from e window w as (partition by user_id order by t, event_id)),
r as (select *, sum(s) over (partition by user_id order by t, event_id) run_id from b)
select user_id, run_id::bigint run_id, count(*) n, max(t) - min(t) run_dur, case when max(t) - min(t) >= 21600000000 then 'long' else 'short' end "domain" from r group by user_id, run_id""")
def runs(spark, sf):
    found = seq.runs(events(spark, sf), ["user_id"], ORDER, "t", "t", 8 * HOUR, F.col("event_type") == "error")
    return seq.run_facts(found, ["user_id"], "t", "t", 6 * HOUR).select("user_id", "run_id", "n", "run_dur", "domain")


@register("q_carry_name", _E + """,
n as (select *, case when event_type = 'signup' then cast(json_extract(props, '$.k') as bigint) end name,
  case when lag(t) over w is null or event_type = 'error' or t - lag(t) over w > 86400000000 then 1 else 0 end s from e window w as (partition by user_id order by t, event_id)),
z as (select *, sum(s) over (partition by user_id order by t, event_id) zone from n),
c as (select *, last_value(name ignore nulls) over (partition by user_id, zone order by t, event_id rows between unbounded preceding and current row) carried from z)
select event_id, carried, carried is not null and name is null inherited from c""")
def carry_name(spark, sf):
    named = events(spark, sf).withColumn("name", F.when(F.col("event_type") == "signup", F.get_json_object("props", "$.k").cast("long")))
    reset = (F.col("event_type") == "error") | (seq.gap_before(["user_id"], ORDER, "t", "t") > 24 * HOUR)
    return seq.carry(named, ["user_id"], ORDER, "name", reset, "carried").select("event_id", "carried", "inherited")


def _fold_sql(gap: int, span: int, key: str, strict: str) -> str:
    return f"""
with recursive o as (select {key} k, epoch_us(ts) t, row_number() over (partition by {key} order by epoch_us(ts), event_id) rn from events),
f as (select k, rn, t, t us, 1 u from o where rn = 1
  union all select o.k, o.rn, o.t, case when o.t - f.t <= {gap} and o.t - f.us <= {span} then f.us else o.t end,
    case when o.t - f.t <= {gap} and o.t - f.us <= {span} then f.u else f.u + 1 end from f join o on o.k = f.k and o.rn = f.rn + 1)
select k, min(t) unit_start, max(t) unit_end, count(*) n from f group by k, u"""


@register("q_fold_merge", "select k user_id, unit_start, unit_end, n from (" + _fold_sql(12 * HOUR, 24 * HOUR, "user_id", "") + ")")
def fold_merge(spark, sf):
    return seq.merge_capped(events(spark, sf), ["user_id"], ORDER, "t", "t", -HOUR, 12 * HOUR, 24 * HOUR)


@register("q_dedupe_anchor", """
with recursive o as (select user_id, event_type, epoch_us(ts) t, value, row_number() over (partition by user_id, event_type order by epoch_us(ts), event_id) rn from events),
f as (select user_id, event_type, rn, t, value, t anchor from o where rn = 1
  union all select o.user_id, o.event_type, o.rn, o.t, o.value, case when o.t - f.anchor <= 86400000000 then f.anchor else o.t end
  from f join o on o.user_id = f.user_id and o.event_type = f.event_type and o.rn = f.rn + 1)
select user_id, event_type, anchor as "at", max(t) "last", max(value) best, count(*) n from f group by user_id, event_type, anchor""")
def dedupe_anchor(spark, sf):
    return seq.dedupe_anchored(events(spark, sf), ["user_id", "event_type"], ORDER, "t", "value", 24 * HOUR)


@register("q_bursts", _E + """,
f as (select *, (select count(distinct o.user_id) from e o where o.t between e.t and e.t + 600000000) >= 4 as b from e)
select event_id, coalesce((select bool_or(o.b) from f o where o.t between f.t - 600000000 and f.t), false) in_burst from f""")
def bursts(spark, sf):
    return seq.bursts(events(spark, sf), "t", "user_id", 600_000_000, 4).select("event_id", "in_burst")


@register("q_scene_cap", "select k event_day, unit_start, unit_end, n from (" + _fold_sql(HOUR // 2, 2 * HOUR, "epoch_us(ts) // 86400000000", "") + ")")
def scene_cap(spark, sf):
    dated = events(spark, sf).withColumn("event_day", F.floor(F.col("t") / (24 * HOUR)))
    return seq.scenes(dated, ["event_day"], ORDER, "t", "t", HOUR // 2, 2 * HOUR)


_UNION = _E + """,
i as (select user_id, t a, t + cast(floor(value * 60000000) as bigint) b, event_id from e),
p as (select *, max(b) over (partition by user_id order by a, b rows between unbounded preceding and 1 preceding) r from i),
s as (select *, sum(case when r is null or a > r then 1 else 0 end) over (partition by user_id order by a, b rows unbounded preceding) g from p),
u as (select user_id, min(a) a, max(b) b, count(*) n from s group by user_id, g)"""


def _intervals(spark, sf):
    return events(spark, sf).select("user_id", F.col("t").alias("a"), (F.col("t") + F.floor(F.col("value") * 60_000_000).cast("long")).alias("b"))


@register("q_interval_union", _UNION + " select user_id, a, b, n from u")
def interval_union(spark, sf):
    return seq.interval_union(_intervals(spark, sf), ["user_id"], "a", "b")


@register("q_gap_bridge", _UNION + """,
g as (select *, sum(case when a - lag_b > 1800000000 then 1 else 0 end) over (partition by user_id order by a rows unbounded preceding) h
  from (select *, lag(b) over (partition by user_id order by a) lag_b from u))
select user_id, min(a) a, max(b) b, sum(n)::bigint n from g group by user_id, h""")
def gap_bridge(spark, sf):
    return seq.bridge_gaps(seq.interval_union(_intervals(spark, sf), ["user_id"], "a", "b"), ["user_id"], "a", "b", HOUR // 2)


@register("q_rolling_median", _E + """
select event_id, round(median(value) over w, 6) med, abs(value - median(value) over w) > 20 as far from e
window w as (partition by user_id order by t, event_id rows between 7 preceding and 7 following)""")
def rolling_median(spark, sf):
    found = seq.rolling_median(events(spark, sf), ["user_id"], ORDER, "value", 7, "m")
    return found.select("event_id", F.round("m", 6).alias("med"), (F.abs(F.col("value") - F.col("m")) > 20).alias("far"))


@register("q_neighbours", _E + """
select event_id, coalesce(array_to_string(list(event_id) over (partition by user_id order by t, event_id rows between 2 preceding and 1 preceding), ','), '') "before",
  coalesce(array_to_string(list(event_id) over (partition by user_id order by t, event_id rows between 1 following and 2 following), ','), '') "after" from e""")
def neighbours(spark, sf):
    found = seq.neighbours(events(spark, sf), ["user_id"], ORDER, "event_id", 2)
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    return found.select("event_id", text("before"), text("after"))


@register("q_adjacent", _E + """,
p as (select *, row_number() over (partition by user_id order by t, event_id) a from e),
k as (select *, a - row_number() over (partition by user_id order by t, event_id) g from p where event_type = 'click')
select user_id, g group_no, count(*) n, min(event_id) first_id from k group by user_id, g""")
def adjacent(spark, sf):
    found = seq.adjacent_groups(events(spark, sf), ["user_id"], ORDER, F.col("event_type") == "click")
    return found.groupBy("user_id", F.col("group_no").cast("long").alias("group_no")).agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@register("q_confident_split", _E + """,
v as (select *, case when value > 10 then event_type end vote from e),
p as (select *, last_value(vote ignore nulls) over (partition by user_id order by t, event_id rows between unbounded preceding and 1 preceding) was from v)
select event_id, sum(case when vote <> was then 1 else 0 end) over (partition by user_id order by t, event_id rows unbounded preceding)::bigint part from p""")
def confident_split(spark, sf):
    voted = events(spark, sf).withColumn("vote", F.when(F.col("value") > 10, F.col("event_type")))
    return seq.split_on_votes(voted, ["user_id"], ORDER, "vote").select("event_id", "part")


@register("q_voice_split", _E + """,
v as (select *, case when value > 5 then event_type = 'view' end flag from e),
f as (select *, last_value(flag ignore nulls) over (partition by user_id order by t, event_id rows between unbounded preceding and current row) g from v),
c as (select *, case when row_number() over w = 1 or g is distinct from lag(g) over w then 1 else 0 end s from f window w as (partition by user_id order by t, event_id))
select event_id, sum(s) over (partition by user_id order by t, event_id rows unbounded preceding)::bigint part from c""")
def voice_split(spark, sf):
    flagged = events(spark, sf).withColumn("flag", F.when(F.col("value") > 5, F.col("event_type") == "view"))
    return seq.split_on_flags(flagged, ["user_id"], ORDER, "flag").select("event_id", "part")


@register("q_stratified_rr", _E + """,
r as (select event_id, event_type, row_number() over (partition by event_type order by sha1(event_id::varchar), event_id) turn from e)
select event_id, event_type, turn from r order by turn, sha1(event_type) limit 200""")
def stratified_rr(spark, sf):
    return seq.in_turn(events(spark, sf), "event_type", "event_id", 200).select("event_id", "event_type", "turn")


@register("q_interleave3", """
with r as (select p_partkey, (row_number() over (order by p_retailprice desc, p_partkey) - 1) * 3 a, (row_number() over (order by p_size desc, p_partkey) - 1) * 3 + 1 b,
  (row_number() over (order by p_name, p_partkey) - 1) * 3 + 2 c from part)
select p_partkey, least(a, b, c) place from r order by place limit 60""")
def interleave3(spark, sf):
    key = F.col("p_partkey")
    return seq.interleave(table(spark, sf, "part"), "p_partkey", [[F.desc("p_retailprice"), key], [F.desc("p_size"), key], [F.col("p_name"), key]], 60).select("p_partkey", F.col("place").cast("long").alias("place"))


@register("q_change_point", _E + """,
c as (select user_id, event_type, row_number() over (partition by user_id order by count(*) desc, event_type) r from e group by user_id, event_type),
p as (select user_id, max(event_type) filter (r = 1) v1, max(event_type) filter (r = 2) v2 from c where r <= 2 group by user_id having count(*) = 2),
o as (select e.user_id, v1, v2, (event_type = v1)::int f, row_number() over (partition by e.user_id order by t, event_id) j, count(*) over (partition by e.user_id) n
  from e join p on p.user_id = e.user_id and event_type in (v1, v2)),
s as (select *, sum(f) over (partition by user_id order by j) c1, sum(f) over (partition by user_id) n1 from o),
w as (select *, least((j - c1) + n1 - c1, c1 + (n - n1) - (j - c1)) err from s where j < n)
select user_id, v1 first_voice, v2 second_voice, j cut, err::bigint errors from (select *, row_number() over (partition by user_id order by err, j) k from w) where k = 1""")
def change_point(spark, sf):
    return seq.change_point(events(spark, sf), ["user_id"], ORDER, "event_type")


@register("q_prop_split", """
with l as (select doc_id, unnest(string_split(text, chr(10))) line, unnest(range(len(string_split(text, chr(10))))) k from documents where text is not null),
s as (select *, sum(length(line)) over (partition by doc_id order by k) e, sum(length(line)) over (partition by doc_id) n from l)
select doc_id, k::bigint line_no, round((e - length(line)) / nullif(n, 0), 6) share_start, round(e / nullif(n, 0), 6) share_end from s""")
def prop_split(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("k", "line")).select("doc_id", F.col("k").cast("long").alias("line_no"), F.length("line").alias("w"))
    found = seq.share_of_span(lines, ["doc_id"], ["line_no"], "w")
    return found.select("doc_id", "line_no", F.round("share_start", 6).alias("share_start"), F.round("share_end", 6).alias("share_end"))


@register("q_recap_like", """
with f as (select conv_id, min(turn) a from conversations where regexp_matches(text, '(?i)the') group by conv_id)
select c.conv_id, a first_at, max(turn) filter (regexp_matches(text, '(?i)and') and turn > a and turn <= a + 4) then_at from conversations c join f using (conv_id) group by c.conv_id, a""")
def recap_like(spark, sf):
    text = F.col("text")
    return seq.last_after_first(table(spark, sf, "conversations"), ["conv_id"], "turn", text.rlike("(?i)the"), text.rlike("(?i)and"), 4)
