"""Queries on tracks, boards and corpus splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.operators import annotate as an

from .registry import register
from .relational import table
from .sequence import _E, events


@register("q_track_relabel", _E + """,
f as (select user_id, row_number() over (partition by user_id order by t, event_id) - 1 as frame, case event_type when 'error' then -1 when 'click' then 0 when 'view' then 1 when 'purchase' then 2 else 3 end voice from e),
p as (select user_id, voice, least(row_number() over (partition by user_id order by count(*) desc, voice) - 1, 2) p from f where voice >= 0 group by 1, 2)
select f.user_id, frame, coalesce(p, -1)::bigint voice from f left join p using (user_id, voice) where frame % 4 = 2""")
def track_relabel(spark, sf):
    from pyspark.sql import Window

    voice = F.when(F.col("event_type") == "error", -1).when(F.col("event_type") == "click", 0).when(F.col("event_type") == "view", 1).when(F.col("event_type") == "purchase", 2).otherwise(3)
    frame = (F.row_number().over(Window.partitionBy("user_id").orderBy("t", "event_id")) - 1).cast("long")
    return an.relabel_by_presence(events(spark, sf).select("user_id", frame.alias("frame"), voice.alias("voice")), ["user_id"], "frame", "voice", 4)


@register("q_wide_argmax", """
with m as (select l_orderkey % 500 as g, avg(l_discount) a, avg(l_tax) b, avg(l_quantity / 1000) c from lineitem group by 1),
u as (select g, 'l_discount' best, a mean from m union all select g, 'l_tax', b from m union all select g, 'l_units', c from m),
s as (select *, mean / sum(mean) over (partition by g) share, row_number() over (partition by g order by mean desc, best) r from u)
select g, max(best) filter (r = 1) best, round(max(mean), 7) mean, round(-sum(share * ln(share)), 6) entropy from s group by g""")
def wide_argmax(spark, sf):
    lines = table(spark, sf, "lineitem").select((F.col("l_orderkey") % 500).alias("g"), "l_discount", "l_tax", (F.col("l_quantity") / 1000).alias("l_units"))
    found = an.best_wide_column(lines, ["g"], ["l_discount", "l_tax", "l_units"])
    return found.select("g", "best", F.round("mean", 7).alias("mean"), F.round("entropy", 6).alias("entropy"))


@register("q_nested_counts", """
select user_group, sum(n)::bigint n, string_agg(event_type || '=' || n, ',' order by event_type) per_type from (select user_id % 10 as user_group, event_type, count(*) n from events group by 1, 2) group by 1""")
def nested_counts(spark, sf):
    found = an.nested_counts(events(spark, sf).withColumn("user_group", F.col("user_id") % 10), "user_group", "event_type")
    text = F.array_join(F.transform(F.map_entries("per_other"), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string"))), ",")
    return found.select("user_group", "n", text.alias("per_type"))


@register("q_one_per_group", """
with r as (select *, row_number() over (partition by p_brand order by p_retailprice desc, p_partkey) g from part)
select p_partkey, p_brand from r order by g > 1, p_retailprice desc, p_partkey limit 50""")
def one_per_group(spark, sf):
    return an.one_per_group_first(table(spark, sf, "part"), "p_brand", [F.desc("p_retailprice"), F.col("p_partkey")], 50).select("p_partkey", "p_brand")


@register("q_queue_order", """
with q as (select o_custkey k, o_orderstatus reason, case o_orderstatus when 'P' then 1 when 'F' then 2 else 3 end p, o_totalprice d from orders),
r as (select *, row_number() over (partition by k order by p, reason) n, max(d) over (partition by k) m from q)
select k, reason, p::bigint priority, m d from r where n = 1 order by p, m desc, k limit 200""")
def queue_order(spark, sf):
    queue = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("reason"), F.col("o_totalprice").alias("d"))
    return an.queue_order(queue, "k", "reason", "d", ["P", "F"]).limit(200)


@register("q_coverage", """
with o as (select l_suppkey k, count(*) n, sum(l_quantity) s, count(*) filter (l_returnflag = 'R') r from lineitem group by 1)
select s_suppkey k, coalesce(n, 0) n, coalesce(s, 0.0) secs, coalesce(r, 0) n_open, case when coalesce(n, 0) >= 600 and coalesce(s, 0) >= 15000 then 'banked' when coalesce(s, 0) < 14500 then 'quiet' else 'thin' end status
from supplier left join o on k = s_suppkey""")
def coverage(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("k"), "l_quantity", "l_returnflag")
    return an.coverage(lines, "k", "l_quantity", F.col("l_returnflag") == "R", table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k")), 600, 15_000.0, 14_500.0)


@register("q_split_sets", """
with i as (select o_orderkey, 'S' || o_custkey % 9 as season, (o_orderkey % 6) as episode from orders)
select o_orderkey, case when season in ('S3', 'S7') then 'test' when episode = max(episode) over w and min(episode) over w < max(episode) over w then 'dev' else 'train' end split from i window w as (partition by season)""")
def split_sets(spark, sf):
    items = table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("S"), (F.col("o_custkey") % 9).cast("string")).alias("season"), (F.col("o_orderkey") % 6).alias("episode"))
    return an.split_sets(items, "season", "episode", ["S3", "S7"]).select("o_orderkey", "split")


@register("q_truncated", "select o_orderkey, o_totalprice - o_custkey * 20 < o_totalprice - greatest(5.0, o_totalprice * 0.02) truncated from orders")
def truncated(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") - F.col("o_custkey") * 20).alias("a"), F.col("o_totalprice").alias("w"))
    return an.flags_of_interval(orders, "a", "w").select("o_orderkey", "truncated")


@register("q_words_to_lines", """
with w as (select doc_id, unnest(range(n_chars)) k from documents),
l as (select doc_id, line, (doc_id + line * 7) % 11 as n from documents cross join range(5) t(line)),
e as (select *, sum(n) over (partition by doc_id order by line) z, line = max(line) over (partition by doc_id) last from l where n > 0)
select w.doc_id, line::bigint line, count(*) n_words, min(k)::bigint first_no, max(k)::bigint last_no from w join e on e.doc_id = w.doc_id and k >= z - n and (k < z or last) group by 1, 2""")
def words_to_lines(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("n_chars").alias("n"))
    words = docs.filter("n > 0").select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("word_no"))
    lines = docs.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4).cast("long"))).alias("line_no")).withColumn("k", (F.col("doc_id") + F.col("line_no") * 7) % 11)
    found = an.words_to_lines(words, lines, ["doc_id"], "word_no", "line_no", "k")
    return found.groupBy("doc_id", "line").agg(F.count("*").alias("n_words"), F.min("word_no").alias("first_no"), F.max("word_no").alias("last_no"))


@register("q_candidate_cuts", _E + """,
w as (select user_id, t s, t + 600000000 n, lag(t + 600000000) over (partition by user_id order by t, event_id) b, row_number() over (partition by user_id order by t, event_id) k, min(t) over (partition by user_id) a, max(t) over (partition by user_id) z from e)
select user_id, (b + s) / 2 cut, k - 1 "after" from w where b is not null and (b + s) / 2 - a >= 432000000000 and z - (b + s) / 2 >= 432000000000""")
def candidate_cuts(spark, sf):
    from pyspark.sql import Window

    whole = Window.partitionBy("user_id")
    words = events(spark, sf).select("user_id", F.struct("t", "event_id").alias("o"), F.col("t").alias("s"), (F.col("t") + 600_000_000).alias("n"), F.min("t").over(whole).alias("a"), F.max("t").over(whole).alias("z"))
    return an.candidate_cuts(words, ["user_id"], "o", "s", "n", F.col("a"), F.col("z"), 432_000_000_000).select("user_id", "cut", F.col("after").cast("long").alias("after"))


@register("q_path_roots", """
with p as (select page_id, regexp_replace(url, '^https?://', '/net/') path from pages)
select page_id, case when starts_with(path, '/net/tionsh.example.net/') then '/a' || substr(path, 24) when starts_with(path, '/net/') then '/b' || substr(path, 5) else path end path from p""")
def path_roots(spark, sf):
    paths = table(spark, sf, "pages").select("page_id", F.regexp_replace("url", "^https?://", "/net/").alias("path"))
    roots = spark.createDataFrame([("/net", "/b"), ("/net/tionsh.example.net", "/a")], "root string, new_root string")
    return an.rewrite_roots(paths, "path", roots, "root", "new_root")


@register("q_accuracy", """
select l_returnflag, count(*) n, round(avg((l_returnflag = case when l_discount > 0.05 then 'N' else 'R' end)::int), 6) accuracy from lineitem group by 1""")
def accuracy(spark, sf):
    from spanloom.operators.evaluate import accuracy_by

    lines = table(spark, sf, "lineitem").withColumn("guess", F.when(F.col("l_discount") > 0.05, "N").otherwise("R"))
    found = accuracy_by(lines, "l_returnflag", "guess")
    return found.select("l_returnflag", "n", F.round("accuracy", 6).alias("accuracy"))


@register("q_signal_lag", _E + """,
h as (select user_id, t // 3600000000 as h, sum(value) v from e group by 1, 2), a as (select user_id, row_number() over (partition by user_id order by h) - 1 i, v from h),
n as (select user_id, count(*) n, avg(v) m, sum(v) / (count(*) + 3) mb from a group by 1), x as (select user_id, i, v - m v from a join n using (user_id)),
y as (select user_id, i + 3 as i, v - mb v from a join n using (user_id) union all select user_id, unnest(range(3)), -mb from n),
l as (select user_id, unnest(range(-10, 11)) lag from n), nx as (select user_id, sqrt(sum(v * v)) q from x group by 1), ny as (select user_id, sqrt(sum(v * v)) q from y group by 1),
c as (select l.user_id, l.lag, coalesce(sum(x.v * y.v), 0) / (any_value(nx.q) * any_value(ny.q) + 1e-9) s from l join nx using (user_id) join ny using (user_id) left join x on x.user_id = l.user_id left join y on y.user_id = l.user_id and x.i = y.i + l.lag group by 1, 2),
b as (select user_id, arg_max(lag, (round(s, 9), -lag)) k, max(s) s from c group by 1)
select b.user_id, k::bigint lag, round((any_value(b.s) - avg(c.s)) / (stddev_pop(c.s) + 1e-9), 3) score from b join c on c.user_id = b.user_id and abs(c.lag - k) > 5 group by 1, 2""")
def signal_lag(spark, sf):
    users = events(spark, sf).groupBy("user_id", F.floor(F.col("t") / 3_600_000_000).alias("h")).agg(F.sum("value").alias("v"))
    series = users.groupBy("user_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("h", "v"))), lambda x: x["v"]).alias("a"))
    found = an.lag_of_signals(series.withColumn("b", F.concat(F.array(F.lit(0.0), F.lit(0.0), F.lit(0.0)), F.col("a"))), "user_id", "a", "b", 10)
    return found.withColumn("score", F.round("score", 3))


@register("q_sample_pairs", """
with i as (select vec_id, label, vec_id % 4 as season, sha1('pairs' || vec_id) h from embeddings),
s as (select vec_id a, lead(vec_id) over w b, row_number() over w r from i window w as (partition by label order by h)),
o as (select vec_id a, h, season, label, lead(vec_id) over w b, lead(label) over w l from i window w as (partition by season order by h)), d as (select *, row_number() over (partition by season order by h) r from o where l <> label)
select a, b, 1 target from s where b is not null and r <= 20 union all select a, b, 0 from d where r <= 20""")
def sample_pairs(spark, sf):
    items = table(spark, sf, "embeddings").select("vec_id", "label", (F.col("vec_id") % 4).alias("season"))
    return an.sample_pairs(items, "vec_id", "label", "season", 20)


@register("q_min_support", "select l_suppkey, l_partkey, l_orderkey from lineitem where l_suppkey in (select l_suppkey from lineitem group by 1 having count(*) >= 610)")
def min_support(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey")
    enough = lines.groupBy("l_suppkey").agg(F.count("*").alias("n")).filter("n >= 610").select("l_suppkey")
    return lines.join(enough, "l_suppkey", "left_semi")


@register("q_group_unique", "select o_custkey, case when count(distinct o_orderpriority) = 1 then max(o_orderpriority) end sole from orders group by 1")
def group_unique(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.when(F.min("o_orderpriority") == F.max("o_orderpriority"), F.min("o_orderpriority")).alias("sole"))
