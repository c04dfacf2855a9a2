"""Queries that join on time."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.operators import temporal as tm

from .registry import register
from .relational import table
from .sequence import _E, HOUR, events


@register("q_asof", _E + """,
p as (select user_id, t pt, max(event_id) pid from e where event_type = 'purchase' group by 1, 2),
c as (select event_id, user_id, t from e where event_type = 'click')
select c.event_id, (select case when c.t - pt <= 86400000000 then pid end from p where p.user_id = c.user_id and pt <= c.t order by pt desc limit 1) prev_id,
  (select case when pt - c.t <= 86400000000 then pid end from p where p.user_id = c.user_id and pt >= c.t order by pt limit 1) next_id from c""")
def asof(spark, sf):
    rows = events(spark, sf)
    clicks = rows.filter("event_type = 'click'").select("event_id", "user_id", "t")
    buys = rows.filter("event_type = 'purchase'").select("user_id", F.col("t").alias("pt"), F.col("event_id").alias("pid"))
    back = tm.as_of(clicks, buys, ["user_id"], "t", "pt", "pid", "prev_id", within=24 * HOUR)
    return tm.as_of(back, buys, ["user_id"], "t", "pt", "pid", "next_id", forward=True, within=24 * HOUR).select("event_id", "prev_id", "next_id")


@register("q_nearest", _E + """,
p as (select c.event_id, v.event_id view_id, abs(v.t - c.t) distance, row_number() over (partition by c.event_id order by abs(v.t - c.t), v.event_id) r
  from e c join e v on v.user_id = c.user_id and v.event_type = 'view' and abs(v.t - c.t) <= 3600000000 where c.event_type = 'click')
select event_id, view_id, distance from p where r = 1""")
def nearest(spark, sf):
    rows = events(spark, sf)
    clicks = rows.filter("event_type = 'click'").select("event_id", "user_id", "t")
    views = rows.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("t").alias("vt"))
    return tm.nearest(clicks, views, ["user_id"], "event_id", "t", "view_id", "vt", HOUR).select("event_id", "view_id", "distance")


@register("q_overlap_anchor", _E + """,
a as (select event_id, user_id, t s, t + cast(floor(value * 600000000) as bigint) n from e where event_type = 'purchase'),
b as (select event_id oid, user_id, t os, t + cast(floor(value * 600000000) as bigint) o_n from e where event_type = 'view'),
p as (select event_id, a.user_id, oid, least(n, o_n) - greatest(s, os) common, row_number() over (partition by event_id order by least(n, o_n) - greatest(s, os) desc, abs(s - os - 3000000), oid) r
  from a join b on a.user_id = b.user_id and least(n, o_n) > greatest(s, os))
select user_id, event_id, oid, common from p where r = 1""")
def overlap_anchor(spark, sf):
    rows = events(spark, sf).withColumn("stop", F.col("t") + F.floor(F.col("value") * 600_000_000).cast("long"))
    a = rows.filter("event_type = 'purchase'").select("event_id", "user_id", F.col("t").alias("s"), F.col("stop").alias("n"))
    b = rows.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("oid"), F.col("t").alias("os"), F.col("stop").alias("o_n"))
    return tm.overlap_best(a, b, ["user_id"], "event_id", "s", "n", "oid", "os", "o_n", 12 * HOUR, 3_000_000)


@register("q_window_ideal", _E + """,
p as (select c.event_id, v.event_id view_id, abs(c.t - v.t - 10800000000) off, row_number() over (partition by c.event_id order by abs(c.t - v.t - 10800000000), v.event_id) r
  from e c join e v on v.user_id = c.user_id and v.event_type = 'view' and v.t between c.t - 21600000000 and c.t + 3600000000 where c.event_type = 'click')
select event_id, view_id, off from p where r = 1""")
def window_ideal(spark, sf):
    rows = events(spark, sf)
    clicks = rows.filter("event_type = 'click'").select("event_id", "user_id", "t")
    views = rows.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("t").alias("vt"))
    return tm.closest_to_ideal(clicks, views, ["user_id"], "event_id", "t", "view_id", "vt", 6 * HOUR, HOUR, 3 * HOUR).select("event_id", "view_id", "off")


@register("q_asof_dim", """
with o as (select o_orderkey, o_custkey, year(o_orderdate) * 12 + month(o_orderdate) m, o_totalprice from orders),
v as (select o_custkey, m vm, round(max(o_totalprice), 2) top from o where o_orderkey % 3 = 0 group by 1, 2)
select o_orderkey, (select max(vm) from v where v.o_custkey = o.o_custkey and vm <= m) as_of_month,
  (select top from v where v.o_custkey = o.o_custkey and vm <= m order by vm desc limit 1) top from o where o_orderkey % 3 <> 0""")
def asof_dim(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", (F.year("o_orderdate") * 12 + F.month("o_orderdate")).cast("long").alias("m"), "o_totalprice")
    versions = orders.filter("o_orderkey % 3 = 0").groupBy("o_custkey", F.col("m").alias("as_of_month")).agg(F.round(F.max("o_totalprice"), 2).alias("top"))
    return tm.as_of_version(orders.filter("o_orderkey % 3 <> 0").select("o_orderkey", "o_custkey", "m"), versions, ["o_custkey"], "m", "as_of_month", ["top"]).select("o_orderkey", "as_of_month", "top")


@register("q_scalar_top1", """
select o_custkey, o_orderkey last_order, o_orderstatus last_status from (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) r from orders) where r = 1""")
def scalar_top1(spark, sf):
    newest = F.max(F.struct("o_orderdate", "o_orderkey", "o_orderstatus")).alias("b")
    return table(spark, sf, "orders").groupBy("o_custkey").agg(newest).select("o_custkey", F.col("b.o_orderkey").alias("last_order"), F.col("b.o_orderstatus").alias("last_status"))


@register("q_borrow", """
with s as (select n_nationkey, n_regionkey, s_suppkey, s_acctbal, row_number() over (partition by n_nationkey order by s_acctbal desc, s_suppkey) r from nation left join supplier on s_nationkey = n_nationkey and s_acctbal > 5000),
o as (select * from s where r = 1),
b as (select n_regionkey, s_suppkey, row_number() over (partition by n_regionkey order by s_acctbal desc, s_suppkey) r from o where s_suppkey is not null)
select o.n_nationkey, coalesce(o.s_suppkey, b.s_suppkey) s_suppkey, o.s_suppkey is null borrowed from o left join b on b.n_regionkey = o.n_regionkey and b.r = 1""")
def borrow(spark, sf):
    from spanloom.operators.resolve import with_borrowed

    nations = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    rich = table(spark, sf, "supplier").filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("n_nationkey"), "s_suppkey", "s_acctbal")
    return with_borrowed(nations, rich, "n_nationkey", "n_regionkey", "s_suppkey", [F.desc("s_acctbal"), F.col("s_suppkey")])


@register("q_interp", _E + """,
k as (select user_id, t kt, max(value) kv from e where event_type = 'purchase' group by 1, 2),
p as (select event_id, user_id, t from e where event_type = 'click'),
a as (select p.*, x.kt k0, x.kv v0 from p asof left join k x on p.user_id = x.user_id and p.t >= x.kt),
b as (select a.*, y.kt k1, y.kv v1 from a asof left join k y on a.user_id = y.user_id and a.t <= y.kt)
select event_id, round(coalesce(v0 + (v1 - v0) * (t - k0)::double / case when k1 - k0 > 0 then (k1 - k0)::double else 1.0 end, v0, v1), 7) v from b""")
def interp(spark, sf):
    rows = events(spark, sf)
    knots = rows.filter("event_type = 'purchase'").groupBy("user_id", F.col("t").alias("kt")).agg(F.max("value").alias("kv"))
    found = tm.interpolate(rows.filter("event_type = 'click'").select("event_id", "user_id", "t"), knots, ["user_id"], "t", "kt", "kv", "v")
    return found.select("event_id", F.round("v", 7).alias("v"))


@register("q_lopo", _E + """,
d as (select user_id % 20 as g, t // 86400000000 as d, sum(value) s, count(*) n from e group by 1, 2)
select g, d "day", round(s / n, 8) own, round(sum(s) over w / nullif(sum(n) over w, 0), 8) earlier, round((sum(s) over (partition by g) - s) / nullif(sum(n) over (partition by g) - n, 0), 8) others
from d window w as (partition by g order by d rows between unbounded preceding and 1 preceding)""")
def lopo(spark, sf):
    from spanloom.operators.vector import expanding_and_left_out

    rows = events(spark, sf).select((F.col("user_id") % 20).alias("g"), F.floor(F.col("t") / (24 * HOUR)).alias("day"), "value")
    found = expanding_and_left_out(rows, ["g"], "day", "value")
    return found.select("g", "day", *(F.round(c, 8).alias(c) for c in ("own", "earlier", "others")))
