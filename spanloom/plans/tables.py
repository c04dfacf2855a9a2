"""Queries that rewrite tables: replaced partitions, cascades, verdicts, card labels, fresh outputs; and plain column work."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.operators import annotate as an
from spanloom.operators import assign as asg
from spanloom.operators import merge as mg
from spanloom.operators import sequence as seq
from spanloom.operators.running import zip_rows

from .registry import register
from .relational import table
from .sequence import _E, ORDER, events


def _orders(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderstatus").alias("label"), F.col("o_totalprice").alias("w"))


_O = "with o as (select o_orderkey k, o_custkey c, o_orderstatus label, o_totalprice w from orders)"


@register("q_replace_partition", _O + """
select k, c, label, w from o where c % 4 <> 1 union all select k, c, 'N', w / 2 from o where c % 4 = 1 and c in (select c from o where k % 3 = 0) and k % 3 = 0
union all select k, c, label, w from o where c % 4 = 1 and c not in (select c from o where k % 3 = 0)""")
def replace_partition(spark, sf):
    orders = _orders(spark, sf)
    new = orders.filter("c % 4 = 1 and k % 3 = 0").select("k", "c", F.lit("N").alias("label"), (F.col("w") / 2).alias("w"))
    return mg.replace_partitions(orders, new, ["c"])


@register("q_cascade", _O + """, g as (select k from o where c % 5 = 0)
select 'labels' of, count(*) n, sum(k)::bigint keys from o where k not in (select k from g) union all select 'lines', count(*), sum(l_orderkey)::bigint from lineitem where l_orderkey not in (select k from g)""")
def cascade(spark, sf):
    orders, lines = _orders(spark, sf), table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), "l_linenumber")
    left = mg.delete_cascade({"labels": orders, "lines": lines}, orders.filter("c % 5 = 0"), "k")
    counts = [df.agg(F.lit(name).alias("of"), F.count("*").alias("n"), F.sum("k").alias("keys")) for name, df in left.items()]
    return counts[0].unionByName(counts[1])


@register("q_insert_select", _O + """
select k, label, 'auto' source, w conf from o where k % 6 <> 0 union all select k, label, 'human', 1.0 from o where k % 6 = 0""")
def insert_select(spark, sf):
    orders = _orders(spark, sf)
    labels = orders.select("k", "label", F.lit("auto").alias("source"), F.col("w").alias("conf")).filter("k % 6 <> 0 or k % 4 = 0")
    return mg.insert_from(labels, orders.filter("k % 6 = 0").select("k", "label"), "k", {"source": F.lit("human"), "conf": F.lit(1.0)})


@register("q_resolve_queue", _O + " select k, label reason, case when k % 5 = 0 then 1 else 0 end::int resolved from o")
def resolve_queue(spark, sf):
    orders = _orders(spark, sf)
    queue = orders.select("k", F.col("label").alias("reason"), F.lit(0).alias("resolved"))
    return mg.resolve_queue(queue, orders.filter("k % 5 = 0"), "k")


_VERDICTS = _O + """, n as (select k, label, 'auto' source from o where k % 3 <> 0), v as (select k, case when k % 7 = 0 then 'X' else 'Y' end label, k % 11 as "at" from o where k % 4 = 0 union all select k, 'old', -1 from o where k % 8 = 0)"""


def _verdicts(spark, sf):
    orders = _orders(spark, sf)
    now = orders.filter("k % 3 <> 0").select("k", "label", F.lit("auto").alias("source"))
    said = orders.filter("k % 4 = 0").select("k", F.when(F.col("k") % 7 == 0, "X").otherwise("Y").alias("label"), (F.col("k") % 11).alias("at"))
    return now, said.unionByName(orders.filter("k % 8 = 0").select("k", F.lit("old").alias("label"), F.lit(-1).cast("long").alias("at")))


@register("q_verdicts", _VERDICTS + """, w as (select k, arg_max(label, "at") label from v group by k)
select k, label, 'human' source from w union all select k, label, source from n where k not in (select k from w)""")
def verdicts(spark, sf):
    now, said = _verdicts(spark, sf)
    return mg.record_verdicts(now, said, "k", "label", "at")[0].withColumn("source", F.coalesce("source", F.lit("human")))


@register("q_verdict_undo", _VERDICTS + " select k, label, source from n")
def verdict_undo(spark, sf):
    """Verdicts recorded and all taken back: the table as it was."""
    now, said = _verdicts(spark, sf)
    after, log = mg.record_verdicts(now, said, "k", "label", "at")
    return asg.undo(after, log, "k", "k long, label string, source string")


@register("q_bulk_update", _O + " select k, case when w >= 100000 and label = 'O' then 'human' else 'auto' end source, case when w >= 100000 and label = 'O' then 1.0 else w / 500000 end conf from o")
def bulk_update(spark, sf):
    labels = _orders(spark, sf).select("k", "label", F.lit("auto").alias("source"), (F.col("w") / 500_000).alias("conf"))
    sure = (F.col("conf") >= 0.2) & (F.col("label") == "O")
    return mg.update_where(labels, sure, {"source": F.lit("human"), "conf": F.lit(1.0)}).select("k", "source", "conf")


@register("q_backfill", "select c_custkey, coalesce(case when c_custkey % 3 <> 0 then c_mktsegment end, n_name) seg, r_name region from customer left join nation on n_nationkey = c_nationkey left join region on r_regionkey = n_regionkey")
def backfill(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("seg"))
    facts = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("r_regionkey") == F.col("n_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("seg"), F.col("r_name").alias("region"))
    return mg.backfill(rows, facts, "c_nationkey", ["seg", "region"]).select("c_custkey", "seg", "region")


@register("q_set_ops", """
with a as (select distinct o_custkey c from orders where o_orderstatus = 'F'), b as (select distinct o_custkey c from orders where o_orderstatus = 'P')
select 'union' op, count(*) n, sum(c)::bigint s from (select c from a union select c from b) union all select 'both', count(*), sum(c)::bigint from (select c from a intersect select c from b) union all select 'only', count(*), sum(c)::bigint from (select c from a except select c from b)""")
def set_ops(spark, sf):
    orders = table(spark, sf, "orders")
    a, b = (orders.filter(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("c")).distinct() for s in "FP")
    found = {"union": a.union(b).distinct(), "both": a.intersect(b), "only": a.subtract(b)}
    rows = [df.agg(F.lit(op).alias("op"), F.count("*").alias("n"), F.sum("c").alias("s")) for op, df in found.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@register("q_renamed_structs", """select s_suppkey as "key", '{"name":"' || lower(s_name) || '","acct":' || s_suppkey || '}' as "row" from supplier""")
def renamed_structs(spark, sf):
    raw = table(spark, sf, "supplier")
    named = raw.toDF(*(c.lower().strip().removeprefix("s_") for c in raw.columns)).drop("acctbal", "nationkey", "not_there")
    return named.select(F.col("suppkey").alias("key"), F.to_json(F.struct(F.lower("name").alias("name"), F.col("suppkey").alias("acct"))).alias("row"))


@register("q_zipped", "select p_partkey, p_name, p_retailprice * 2 as twice from part")
def zipped(spark, sf):
    """Results put beside their rows by key, as a table has no positions to go by."""
    part = table(spark, sf, "part")
    return part.select("p_partkey", "p_name").join(part.select("p_partkey", (F.col("p_retailprice") * 2).alias("twice")), "p_partkey")


_CARDS = """
with i as (select o_orderkey k, o_orderstatus l, case when o_orderkey % 4 = 0 then o_orderstatus end x from orders), lab as (select k, 'Z' label, case when k % 3 = 0 then 'human' when k % 3 = 1 then 'card' else 'auto' end source, 0.5 confidence from i where k % 2 = 0),
c as (select k, case when k % 5 = 0 then 'F' else 'O' end label, 80 + k % 20 as score, k * 1.5 t_s from i where k % 7 < 4), ch as (select t_s, label, case when k % 14 = 0 then k end ck from c where k % 7 = 0),
told as (select ck k, c.label, 1.0 confidence, c.t_s, true sure from c join ch using (t_s, label) where ck is not null union all select k, label, score / 100, t_s, false from c where (t_s, label) not in (select (t_s, label) from ch)),
o as (select told.*, x from told join i using (k) where k not in (select k from lab where source = 'human'))"""


def _cards(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("l"))
    items = orders.select("k", F.when(F.col("k") % 4 == 0, F.col("l")).alias("explicit"))
    source = F.when(F.col("k") % 3 == 0, "human").when(F.col("k") % 3 == 1, "card").otherwise("auto")
    labels = orders.filter("k % 2 = 0").select("k", F.lit("Z").alias("label"), source.alias("source"), F.lit(0.5).alias("confidence"))
    cards = orders.filter("k % 7 < 4").select("k", F.when(F.col("k") % 5 == 0, "F").otherwise("O").alias("label"), (F.col("k") % 20 + 80).alias("score"), (F.col("k") * 1.5).alias("t_s"))
    checks = cards.filter("k % 7 = 0").select("t_s", "label", F.when(F.col("k") % 14 == 0, F.col("k")).alias("checked_key"))
    return mg.card_labels(cards, items, labels, checks, "k")


@register("q_card_labels", _CARDS + """, f as (select k, label, 'card' source, confidence from o where sure or not coalesce(x <> label, false))
select k, label, source, confidence::double confidence from f union all select k, label, source, confidence from lab where source <> 'card' and k not in (select k from f)""")
def card_labels(spark, sf):
    return _cards(spark, sf)[0]


@register("q_card_conflicts", _CARDS + " select k, label, x explicit, t_s::double t_s from o where not sure and x <> label")
def card_conflicts(spark, sf):
    return _cards(spark, sf)[1]


@register("q_stale", _O + " select k, case when k % 4 = 0 then 'missing' else 'changed' end reason from o where k % 4 = 0 or (k % 6 = 1 and k % 4 <> 0)")
def stale(spark, sf):
    orders = _orders(spark, sf).select("k", F.col("c").alias("version"))
    done = orders.filter("k % 4 <> 0").withColumn("version", F.when(F.col("k") % 6 == 1, F.col("version") + 1).otherwise(F.col("version")))
    return mg.stale(orders, done, "k", "version")


@register("q_refreshed", _O + " select k, c as version, case when k % 4 = 0 or k % 6 = 1 then 'new' else 'kept' end made from o where k % 10 <> 9")
def refreshed(spark, sf):
    orders = _orders(spark, sf).select("k", F.col("c").alias("version"))
    done = orders.filter("k % 4 <> 0").select("k", F.when(F.col("k") % 6 == 1, F.col("version") + 1).otherwise(F.col("version")).alias("version"), F.lit("kept").alias("made"))
    return mg.refreshed(orders.filter("k % 10 <> 9"), done, "k", "version", lambda some: some.withColumn("made", F.lit("new")))


@register("q_sibling_fill", """
with p as (select o_orderkey::varchar || s k, case when s = 'a' and o_orderkey % 3 = 0 then o_orderstatus when s = 'b' and o_orderkey % 5 = 0 then 'Q' end label, o_orderkey % 10 / 10.0::double conf, o_orderkey o, s from orders cross join (values ('a'), ('b')) t(s))
select p.k, coalesce(p.label, q.label) label, case when p.label is null then case when q.label is not null then q.conf * 0.9 end else p.conf end conf from p join p q on q.o = p.o and q.s <> p.s""")
def sibling_fill(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("s"))
    label = F.when((F.col("s") == "a") & (F.col("o_orderkey") % 3 == 0), F.col("o_orderstatus")).when((F.col("s") == "b") & (F.col("o_orderkey") % 5 == 0), "Q")
    parts = orders.select(F.concat(F.col("o_orderkey").cast("string"), "s").alias("k"), label.alias("label"), (F.col("o_orderkey") % 10 / 10.0).alias("conf"))
    return mg.fill_from_sibling(parts, "k", "label", "conf")


@register("q_keep_newest", "select o_custkey, o_orderkey from (select *, row_number() over (partition by o_custkey order by o_orderkey desc) r from orders) where r <= 3")
def keep_newest(spark, sf):
    return mg.keep_newest(table(spark, sf, "orders"), "o_custkey", "o_orderkey", 3).select("o_custkey", "o_orderkey")


@register("q_changes_only", """
with recursive o as (select user_id, event_id, value, row_number() over (partition by user_id order by epoch_us(ts), event_id) rn from events where value is not null),
f as (select user_id, event_id, rn, value last, true keep from o where rn = 1
  union all select o.user_id, o.event_id, o.rn, case when abs(o.value - f.last) >= 15 then o.value else f.last end, abs(o.value - f.last) >= 15 from f join o on o.user_id = f.user_id and o.rn = f.rn + 1)
select user_id, event_id from f where keep""")
def changes_only(spark, sf):
    return seq.changes_only(events(spark, sf).select("user_id", "t", "event_id", "value"), ["user_id"], ORDER, "value", 15.0).select("user_id", "event_id")


@register("q_fill_times", """
with w as (select conv_id, turn, case when turn % 3 = 0 then turn * 10.0::double end s, case when turn % 3 = 0 then turn * 10.0 + 4 end::double e, length(text) + 1 as z from conversations),
l as (select *, last_value(e ignore nulls) over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding) lo, first_value(s ignore nulls) over (partition by conv_id order by turn rows between 1 following and unbounded following) hi,
  sum((s is not null)::int) over (partition by conv_id order by turn) g from w),
u as (select *, sum(z) over (partition by conv_id, g, s is not null order by turn) / sum(z) over (partition by conv_id, g, s is not null) upto, z / sum(z) over (partition by conv_id, g, s is not null) own from l)
select conv_id, turn, round(coalesce(s, coalesce(lo, hi) + (coalesce(hi, lo) - coalesce(lo, hi)) * (upto - own)), 5) s, round(coalesce(e, coalesce(lo, hi) + (coalesce(hi, lo) - coalesce(lo, hi)) * upto), 5) e from u""")
def fill_times(spark, sf):
    known = F.col("turn") % 3 == 0
    words = table(spark, sf, "conversations").select("conv_id", "turn", F.when(known, F.col("turn") * 10.0).alias("s"), F.when(known, F.col("turn") * 10.0 + 4).alias("e"), F.length("text").alias("z"))
    found = an.fill_missing_times(words, ["conv_id"], "turn", "s", "e", F.col("z"))
    return found.select("conv_id", "turn", F.round("s", 5).alias("s"), F.round("e", 5).alias("e"))


@register("q_nearest_cut", _E + """,
w as (select user_id, t s, t + 600000000 n, lag(t + 600000000) over (partition by user_id order by t, event_id) b, row_number() over (partition by user_id order by t, event_id) k from e),
c as (select user_id, (b + s) / 2 cut, k - 1 "after" from w where b is not null), m as (select user_id, avg(t) mid from e group by 1),
d as (select user_id, cut, "after", row_number() over (partition by user_id order by round(abs(cut - mid), 9), cut, "after") q from c join m using (user_id)) select user_id, cut, "after" from d where q = 1""")
def nearest_cut(spark, sf):
    words = events(spark, sf).select("user_id", F.struct("t", "event_id").alias("o"), F.col("t").alias("s"), (F.col("t") + 600_000_000).alias("n"))
    cuts = an.candidate_cuts(words, ["user_id"], "o", "s", "n", F.lit(-(1 << 60)), F.lit(1 << 60), 0)
    return an.nearest_cut(cuts, events(spark, sf).groupBy("user_id").agg(F.avg("t").alias("mid")), ["user_id"], "mid").withColumn("after", F.col("after").cast("long"))


@register("q_mention_split", """
with m as (select conv_id, turn, regexp_matches(text, '(?i)the') hit from conversations), c as (select *, case when turn = min(turn) over (partition by conv_id) or hit is distinct from lag(hit) over (partition by conv_id order by turn) then 1 else 0 end s,
  bool_and(hit) over (partition by conv_id) or not bool_or(hit) over (partition by conv_id) plain from m)
select conv_id, turn, case when plain then 1 else sum(s) over (partition by conv_id order by turn) end::bigint part from c""")
def mention_split(spark, sf):
    flagged = table(spark, sf, "conversations").select("conv_id", "turn", F.col("text").rlike("(?i)the").alias("hit"))
    return seq.split_on_mentions(flagged, ["conv_id"], ["turn"], "hit").select("conv_id", "turn", "part")


@register("q_mention_split_sure", """
with m as (select conv_id, turn, regexp_matches(text, '(?i)the') hit, avg((role = 'user')::int) over (partition by conv_id) >= 0.5 and count(*) over (partition by conv_id) > 1 sure from conversations), c as (select *, case when turn = min(turn) over (partition by conv_id) or hit is distinct from lag(hit) over (partition by conv_id order by turn) then 1 else 0 end s,
  bool_and(hit) over (partition by conv_id) or not bool_or(hit) over (partition by conv_id) or not sure plain from m)
select conv_id, turn, case when plain then 1 else sum(s) over (partition by conv_id order by turn) end::bigint part from c""")
def mention_split_sure(spark, sf):
    """Groups whose prediction is sure (its score at or over the bar) are cut by what their rows mention; the others stay whole."""
    rows = table(spark, sf, "conversations").select("conv_id", "turn", F.col("text").rlike("(?i)the").alias("hit"), (F.col("role") == "user").cast("int").alias("one"))
    score = rows.groupBy("conv_id").agg(F.avg("one").alias("top1"), F.count("*").alias("n"))
    flagged = rows.join(score, "conv_id")
    return seq.split_on_mentions(flagged, ["conv_id"], ["turn"], "hit", confident=(F.col("top1") >= 0.5) & (F.col("n") > 1)).select("conv_id", "turn", "part")


@register("q_zipped_frames", """
with a as (select c_custkey, row_number() over (order by c_acctbal desc, c_custkey) k from customer), b as (select o_orderkey, row_number() over (order by o_totalprice, o_orderkey) k from orders)
select coalesce(a.k, b.k) - 1 as at, c_custkey, o_orderkey from a full join b on a.k = b.k""")
def zipped_frames(spark, sf):
    """Two tables side by side, each in an order of its own."""
    a = table(spark, sf, "customer").select("c_custkey", (-F.col("c_acctbal")).alias("x"))
    b = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return zip_rows(a, ["x", "c_custkey"], b, ["o_totalprice", "o_orderkey"], "at").select("at", "c_custkey", "o_orderkey")


@register("q_preview_start", """
with l as (select *, max(turn) over (partition by conv_id) z from conversations) select conv_id, max(turn) preview_at from l where regexp_matches(text, '(?i)the') and turn >= 0.75 * z group by 1""")
def preview_start(spark, sf):
    rows = table(spark, sf, "conversations")
    return seq.last_near_end(rows, ["conv_id"], "turn", F.col("text").rlike("(?i)the"), 0.75, "preview_at")
