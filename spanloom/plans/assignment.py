"""Queries of the assignment pipeline and its parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.operators import assign as asg
from .registry import register
from .relational import table
from .sequence import _E, HOUR, events
from .vector import _LOO, vectors


def _items(spark, sf):
    """Odd vectors as items: runs of five, episodes by id, durations of 0.5 to 3.5 seconds."""
    k = F.col("vec_id")
    return vectors(spark, sf).select("vec_id", "label", "embedding", F.floor(k / 10).alias("run"), (k % 7 * 0.5 + 0.5).alias("dur"), (F.floor(k / 50)).alias("episode"))


@register("q_assign", """
with x as (select vec_id, vec_id // 10 as run, vec_id % 7 * 0.5::double + 0.5::double dur, vec_id // 50 as episode, label, unnest(embedding)::double x, unnest(range(64)) d from embeddings),
m as (select label, d, sum(x * pow(0.5, (5 - episode) / 3.0) * dur) / sum(pow(0.5, (5 - episode) / 3.0) * dur) m from x where vec_id % 2 = 0 and episode <= 5 group by label, d),
u as (select label, d, m / (sqrt(sum(m * m) over (partition by label)) + 1e-9) m from m),
s as (select vec_id, any_value(run) run, any_value(dur) dur, u.label other, round(sum(x.x * u.m), 6) score from x join u using (d) where vec_id % 2 = 1 group by vec_id, u.label),
r as (select *, row_number() over (partition by vec_id order by score desc, other) k from s),
i as (select vec_id, any_value(run) run, any_value(dur) dur, max(other) filter (k = 1) a, max(score) filter (k = 1) s1, max(score) filter (k = 2) s2 from r group by vec_id),
v as (select *, case when dur >= 1.0 and s1 >= 0.2 and round(s1 - s2, 6) >= 0.03 then a end vote from i),
w as (select *, last_value(vote ignore nulls) over (partition by run order by vec_id rows between unbounded preceding and 1 preceding) was from v),
p as (select *, sum(case when vote <> was then 1 else 0 end) over (partition by run order by vec_id rows unbounded preceding) part from w),
g as (select p.run, part, d, sum(x * p.dur) / sum(p.dur) g from p join x using (vec_id) group by 1, 2, 3),
h as (select run, part, d, g / (sqrt(sum(g * g) over (partition by run, part)) + 1e-9) g from g),
q as (select run, part, label, round(sum(g * m), 6) score from h join u using (d) group by 1, 2, 3),
z as (select *, row_number() over (partition by run, part order by score desc, label) k from q),
t as (select run, part, max(label) filter (k = 1) label, max(score) filter (k = 1) top1, max(score) filter (k = 2) top2 from z group by 1, 2),
f as (select run, part, sum(dur) secs, count(*) n from p group by 1, 2)
select run, part::bigint part, label, top1, case when top1 < 0.15 then 'no_candidate' when top1 >= 0.2 and round(top1 - top2, 6) >= 0.03 then case when secs < 2.0 then 'too_short' else 'auto' end else 'low_margin' end decision, secs, n
from t join f using (run, part)""")
def assign(spark, sf):
    rules = asg.Rules(accept=0.2, margin=0.03, floor=0.15)
    items = _items(spark, sf)
    profiles = asg.build_profiles(items.filter("vec_id % 2 = 0"), ["label"], "embedding", 5, rules)
    found = asg.assign(items.filter("vec_id % 2 = 1").drop("label"), profiles, "vec_id", "run", ["vec_id"], "embedding", "dur", "label", rules)
    return found.select("run", "part", "label", "top1", "decision", "secs", "n")


@register("q_candidates", """
with i as (select event_id, user_id % 5 as season, cast(day(ts) as int) episode, case when value < 5 then 'recap' else 'body' end segment from events),
p as (select distinct season, episode, event_type as label from (select user_id % 5 as season, cast(day(ts) as int) episode, event_type, value from events) where value > 30)
select event_id, coalesce((select string_agg(label, ',' order by label) from p where p.season = i.season and p.episode = case when i.segment = 'recap' then i.episode - 1 else i.episode end), '') candidates from i""")
def candidates(spark, sf):
    rows = table(spark, sf, "events").select("event_id", (F.col("user_id") % 5).alias("season"), F.dayofmonth("ts").alias("episode"), F.when(F.col("value") < 5, "recap").otherwise("body").alias("segment"), F.col("event_type").alias("label"), "value")
    found = asg.candidates(rows.select("event_id", "season", "episode", "segment"), rows.filter("value > 30").select("season", "episode", "label"), "season", "episode", "segment")
    return found.select("event_id", F.coalesce(F.array_join("candidates", ","), F.lit("")).alias("candidates"))


@register("q_majority_remap", """
with h as (select l_orderkey // 2 as old_id, l_orderkey // 3 as new_id, count(distinct l_orderkey * 10 + l_linenumber) n from lineitem group by 1, 2)
select old_id, new_id from (select *, row_number() over (partition by old_id order by n desc, new_id) r from h) where r = 1""")
def majority_remap(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("key"))
    old, new = (lines.select(F.floor(F.col("l_orderkey") / n).alias(name), "key") for n, name in ((2, "old_id"), (3, "new_id")))
    return asg.majority_remap(old, new, "old_id", "new_id", "key")


@register("q_containing_window", _E + """,
w as (select user_id, t ws, t + 36000000000 we from e where event_type = 'view'),
p as (select c.event_id, ws, least(c.t - ws, we - (c.t + 600000000)) room, row_number() over (partition by c.event_id order by least(c.t - ws, we - (c.t + 600000000)) desc, ws) r
  from e c join w on w.user_id = c.user_id and ws <= c.t and we >= c.t + 600000000 where c.event_type = 'click')
select event_id, ws, room from p where r = 1""")
def containing_window(spark, sf):
    rows = events(spark, sf)
    items = rows.filter("event_type = 'click'").select("event_id", "user_id", F.col("t").alias("s"), (F.col("t") + 600_000_000).alias("n"))
    windows = rows.filter("event_type = 'view'").select("user_id", F.col("t").alias("ws"), (F.col("t") + 10 * HOUR).alias("we"))
    return asg.containing_window(items, windows, ["user_id"], "event_id", "s", "n", "ws", "we", 10 * HOUR)


@register("q_segment_tags", _E + """, b as (select user_id, min(t) + 259200000000 a, max(t) - 172800000000 z from e group by user_id)
select segment, count(*) n, sum(event_id)::bigint ids from (select event_id, case when t < a then 'recap' when t >= z then 'preview' else 'body' end segment from e join b using (user_id)) group by 1""")
def segment_tags(spark, sf):
    rows = events(spark, sf).select("event_id", "user_id", "t")
    bounds = rows.groupBy("user_id").agg((F.min("t") + 72 * HOUR).alias("recap_end"), (F.max("t") - 48 * HOUR).alias("preview_start"))
    return asg.tag_segments(rows, bounds, ["user_id"], "t").groupBy("segment").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@register("q_tally_merge", """
select user_id, count(*) n, count(*) filter (event_type = 'click') clicks from events group by user_id""")
def tally_merge(spark, sf):
    rows = table(spark, sf, "events")
    count = lambda some: some.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "click").alias("clicks"))
    return asg.merged_tally(count(rows.filter("event_id % 3 = 0")), count(rows.filter("event_id % 3 <> 0")), ["user_id"], ["n", "clicks"])


@register("q_undo", """
select o_orderkey k, case when o_orderkey % 11 = 0 then o_orderstatus else 'Z' end label from orders where o_orderkey % 13 <> 0""")
def undo(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("label"))
    now = orders.withColumn("label", F.lit("Z"))
    logged = orders.filter("k % 11 = 0 or k % 13 = 0").select("k", F.when(F.col("k") % 13 != 0, F.to_json(F.struct("k", "label"))).alias("previous"), F.lit(2).alias("at"))
    older = logged.select("k", F.lit('{"k":-1,"label":"no"}').alias("previous"), F.lit(1).alias("at"))
    return asg.undo(now, logged.unionByName(older).fillna({"previous": "null"}), "k", "k long, label string").filter("k is not null")


@register("q_calibrated", _LOO + """
select decision, count(*) n from (select case when sim >= 0.35 then case when 1 / (1 + exp(-(sim * 10 - 4))) >= 0.6 then 'auto' else 'low_margin' end else 'no_candidate' end decision from loo) group by 1""")
def calibrated(spark, sf):
    from spanloom.operators.vector import leave_one_out

    scored = leave_one_out(vectors(spark, sf), "vec_id", "label", "embedding").select(F.col("sim").alias("top1"), F.lit(4.0).alias("secs"), F.when(F.col("sim") < 0.35, "no_candidate").otherwise("low_margin").alias("decision"))
    return asg.calibrated(scored, 1 / (1 + F.exp(-(F.col("top1") * 10 - 4))), 0.6).groupBy("decision").agg(F.count("*").alias("n"))


@register("q_text_prior", """
with d as (select o_orderkey k, o_orderstatus label, case when o_orderkey % 4 = 0 then 'auto' when o_orderkey % 4 = 1 then 'no_candidate' when o_orderkey % 4 = 2 then 'low_margin' else 'name_mentioned' end decision from orders),
p as (select o_orderkey k, case when o_orderkey % 3 = 0 then 'F' else 'O' end guess, 'P' "second", (o_orderkey % 10) / 10.0::double conf from orders where o_orderkey % 5 <> 0),
j as (select d.*, guess, coalesce(decision <> 'auto' and conf >= 0.8 and (decision = 'no_candidate' or guess = label or guess = "second" or (decision = 'name_mentioned' and guess <> label)), false) take from d left join p using (k))
select k, case when take then guess else label end label, case when take then 'auto_text' else decision end decision from j""")
def text_prior(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("label"))
    kinds = F.element_at(F.array(*map(F.lit, ("auto", "no_candidate", "low_margin", "name_mentioned"))), (F.col("k") % 4 + 1).cast("int"))
    prior = orders.filter("k % 5 <> 0").select("k", F.when(F.col("k") % 3 == 0, "F").otherwise("O").alias("guess"), F.lit("P").alias("second"), ((F.col("k") % 10) / 10.0).alias("conf"))
    return asg.with_text_prior(orders.withColumn("decision", kinds), prior, ["k"], "label")
