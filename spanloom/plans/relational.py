"""Queries of counting, choosing and joining."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions.numbers import wilson_low
from spanloom.functions.time import micros, mmss
from spanloom.operators import relational as rel
from spanloom.operators.temporal import within_band

from .registry import register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("q_source_summary", """
select source, quality, count(*) n, sum(n_chars)::bigint chars, count(distinct lang) langs
from documents join labels using (doc_id) group by source, quality""")
def source_summary(spark, sf):
    both = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return both.groupBy("source", "quality").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"), F.countDistinct("lang").alias("langs"))


@register("q_label_coverage", """
select source, count(*) n, count(quality) labelled, round(sum(case when quality = 1 then n_chars else 0 end) / greatest(sum(n_chars), 1), 6) good_share
from documents left join labels using (doc_id) group by source""")
def label_coverage(spark, sf):
    both = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    good = F.sum(F.when(F.col("quality") == 1, F.col("n_chars")).otherwise(0))
    return both.groupBy("source").agg(F.count("*").alias("n"), F.count("quality").alias("labelled"), F.round(good / F.greatest(F.sum("n_chars"), F.lit(1)), 6).alias("good_share"))


@register("q_unlabelled", "select doc_id, source from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)")
def unlabelled(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "source").join(table(spark, sf, "labels"), "doc_id", "left_anti")


@register("q_recent_semi", """
select event_id, user_id from events e where exists (select 1 from events p where p.user_id = e.user_id and p.event_type = 'purchase'
  and p.event_id <> e.event_id and abs(epoch_us(p.ts) - epoch_us(e.ts)) <= 21600000000)""")
def recent_semi(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", micros("ts").alias("t"))
    near = events.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("other_id"), F.col("t").alias("other_t"))
    pairs = within_band(events, near, ["user_id"], "t", "other_t", 21_600_000_000, 21_600_000_000)
    return pairs.filter("event_id <> other_id").select("event_id", "user_id").distinct()


@register("q_chooser", """
select s_nationkey, n_name, s_suppkey, tier, size_bucket from (
  select *, row_number() over (partition by s_nationkey order by tier, size_bucket, s_acctbal desc, s_suppkey) rn from (
    select s_nationkey, s_suppkey, s_acctbal, case when s_acctbal >= 5000 then 0 when s_acctbal >= 0 then 1 else 2 end tier,
      case when abs(s_acctbal - 4000) <= 500 then 0 else cast(floor(abs(s_acctbal - 4000) / 1000 + 0.5) as bigint) end size_bucket from supplier))
join nation on n_nationkey = s_nationkey where rn = 1""")
def chooser(spark, sf):
    tier = F.when(F.col("s_acctbal") >= 5000, 0).when(F.col("s_acctbal") >= 0, 1).otherwise(2)
    away = F.abs(F.col("s_acctbal") - 4000)
    bucket = F.when(away <= 500, F.lit(0).cast("long")).otherwise(F.floor(away / 1000 + F.lit(0.5)))
    rated = table(spark, sf, "supplier").withColumns({"tier": tier, "size_bucket": bucket})
    best = rel.first_per_group(rated, ["s_nationkey"], [F.col("tier"), F.col("size_bucket"), F.desc("s_acctbal"), F.col("s_suppkey")])
    return best.join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_nationkey", "n_name", "s_suppkey", "tier", "size_bucket")


@register("q_top3_array", """
select l_partkey, rank_no, l_orderkey, l_linenumber, revenue from (
  select l_partkey, l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) revenue,
    row_number() over (partition by l_partkey order by round(l_extendedprice * (1 - l_discount), 4) desc, l_orderkey, l_linenumber) rank_no from lineitem)
where rank_no <= 3""")
def top3_array(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("revenue", F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4))
    best = rel.first_per_group(lines, ["l_partkey"], [F.desc("revenue"), F.col("l_orderkey"), F.col("l_linenumber")], 3)
    return best.select("l_partkey", "rank_no", "l_orderkey", "l_linenumber", "revenue")


@register("q_having", """
select o_custkey, count(*) n_orders, count(distinct o_orderstatus) n_status from orders group by o_custkey
having count(*) >= 5 and count(distinct o_orderstatus) >= 2""")
def having(spark, sf):
    counted = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.countDistinct("o_orderstatus").alias("n_status"))
    return counted.filter("n_orders >= 5 and n_status >= 2")


@register("q_rollup_audit", """
select coalesce(event_type, 'all') event_type, n, k, round(k / n, 6) rate,
  round((k / n + 1.96*1.96/(2*n) - 1.96 * sqrt(k / n * (1 - k / n) / n + 1.96*1.96/(4*n*n))) / (1 + 1.96*1.96/n), 6) low
from (select event_type, count(*)::double n0, count(*) n, count(*) filter (value >= 10) k from events group by rollup (event_type))""")
def rollup_audit(spark, sf):
    sums = rel.subtotals(table(spark, sf, "events"), "event_type", {"n": F.count("*"), "k": F.count_if(F.col("value") >= 10)})
    return sums.select("event_type", "n", "k", F.round(F.col("k") / F.col("n"), 6).alias("rate"), F.round(wilson_low(F.col("k"), F.col("n")), 6).alias("low"))


@register("q_pivot", """
select user_id % 10 as user_group, count(*) filter (event_type = 'click') n_click, count(*) filter (event_type = 'error') n_error,
  count(*) filter (event_type = 'purchase') n_purchase, count(*) filter (event_type = 'signup') n_signup, count(*) filter (event_type = 'view') n_view
from events group by 1""")
def pivot(spark, sf):
    events = table(spark, sf, "events").withColumn("user_group", F.col("user_id") % 10)
    return rel.pivot_counts(events, "user_group", "event_type", ["click", "error", "purchase", "signup", "view"])


@register("q_mode", """
select part_group, l_returnflag mode_value, n from (
  select l_partkey % 100 as part_group, l_returnflag, count(*) n, row_number() over (partition by l_partkey % 100 order by count(*) desc, l_returnflag) rn
  from lineitem group by 1, 2) where rn = 1""")
def mode(spark, sf):
    return rel.mode_per_group(table(spark, sf, "lineitem").withColumn("part_group", F.col("l_partkey") % 100), ["part_group"], "l_returnflag")


@register("q_text_agg", """
select conv_id, substr(string_agg(text, ' ' order by turn), 1, 110) said from conversations where text is not null group by conv_id""")
def text_agg(spark, sf):
    return rel.ordered_text(table(spark, sf, "conversations"), ["conv_id"], "turn", "text", "said", 110)


@register("q_json_flags", """
select coalesce(cast(json_extract(props, '$.k') as bigint), 0) // 10 as k_bucket, count(*) n, count(*) filter (json_extract(props, '$.missing') is null) n_default
from events group by 1""")
def json_flags(spark, sf):
    k = F.coalesce(F.get_json_object("props", "$.k").cast("long"), F.lit(0))
    flagged = table(spark, sf, "events").select(F.floor(k / 10).alias("k_bucket"), F.get_json_object("props", "$.missing").alias("missing"))
    return flagged.groupBy("k_bucket").agg(F.count("*").alias("n"), F.count_if(F.col("missing").isNull()).alias("n_default"))


@register("q_mmss", """
select event_id, lpad(((epoch_us(ts) // 1000000) % 86400 // 60)::varchar, greatest(2, len(((epoch_us(ts) // 1000000) % 86400 // 60)::varchar))::int, '0') || ':' ||
  lpad(((epoch_us(ts) // 1000000) % 60)::varchar, 2, '0') as at from events""")
def minutes(spark, sf):
    day = (micros("ts") / 1_000_000).cast("double")
    whole = F.floor(day).cast("long") % 86400
    return table(spark, sf, "events").select("event_id", mmss(whole).alias("at"))


@register("q_spearman", """
with c as (select c_custkey, any_value(c_acctbal) bal, count(*) n from customer join orders on o_custkey = c_custkey group by 1),
r as (select rank() over (order by bal) + (count(*) over (partition by bal) - 1) / 2 a, rank() over (order by n) + (count(*) over (partition by n) - 1) / 2 b, bal, n from c)
select round(corr(a, b), 6) rho, round(avg(abs(a - b)), 2) mae, count(*) n from r""")
def spearman(spark, sf):
    from spanloom.operators.evaluate import spearman_mae

    orders = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return spearman_mae(table(spark, sf, "customer").join(orders, "c_custkey"), "c_acctbal", "n")
