"""Queries that merge, compare and rewrite tables, keep versions of them, and follow streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.operators import merge as mg
from spanloom.sources import snapshots as sn
from spanloom.sources.files import private_folder
from spanloom.streaming import corrections as co
from spanloom.streaming import sessions as ss

from .registry import register
from .relational import table

_V = """with a as (select o_orderkey k, o_orderstatus label, case when o_orderkey % 5 = 0 then 'human' when o_orderkey % 5 = 1 then 'auto' else 'text' end source, o_totalprice w from orders where o_orderkey % 4 <> 3),
b as (select o_orderkey k, case when o_orderkey % 3 = 0 then 'X' else o_orderstatus end label, 'auto' source, o_totalprice w from orders where o_orderkey % 4 <> 1)"""


def versions(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("label"), F.col("o_totalprice").alias("w"))
    source = F.when(F.col("k") % 5 == 0, "human").when(F.col("k") % 5 == 1, "auto").otherwise("text")
    a = orders.filter("k % 4 <> 3").select("k", "label", source.alias("source"), "w")
    b = orders.filter("k % 4 <> 1").select("k", F.when(F.col("k") % 3 == 0, "X").otherwise(F.col("label")).alias("label"), F.lit("auto").alias("source"), "w")
    return a, b


@register("q_upsert", _V + " select * from b union all select * from a where k not in (select k from b)")
def upsert(spark, sf):
    return mg.upsert(*versions(spark, sf), ["k"])


@register("q_protected", _V + " select * from a where source = 'human' union all select * from b where k not in (select k from a where source = 'human')")
def protected(spark, sf):
    return mg.protected_merge(*versions(spark, sf), ["k"], "source", ["human"])


@register("q_precedence", _V + """, u as (select * from a union all select * from b),
r as (select *, row_number() over (partition by k order by case source when 'human' then 1 when 'auto' then 2 end, label) n from u where source in ('human', 'auto')) select k, label, source from r where n = 1""")
def precedence(spark, sf):
    a, b = versions(spark, sf)
    return mg.precedence(a.unionByName(b), "k", "label", "source", ["human", "auto"])


@register("q_flips", _V + """
select k, a.label was, b.label "now", case when a.k is null then 'new' when b.k is null then 'dropped' else 'flipped' end change, coalesce(b.w, a.w) weight
from a full join b using (k) where a.label is distinct from b.label or a.k is null or b.k is null""")
def flips(spark, sf):
    return mg.changes(*versions(spark, sf), ["k"], "label", "w")


@register("q_staleness", _V + """, c as (select k, w + case when k % 7 = 0 then 0.05 else 0.01 end w from b)
select count(*) filter (c.k is null) only_old, count(*) filter (a.k is null) only_new, count(*) filter (abs(a.w - c.w) > 0.02) moved from a full join c using (k)""")
def staleness(spark, sf):
    a, b = versions(spark, sf)
    moved = b.withColumn("w", F.col("w") + F.when(F.col("k") % 7 == 0, 0.05).otherwise(0.01))
    return mg.staleness(a, moved, ["k"], "w", 0.02)


@register("q_split_rows", """
with o as (select o_orderkey::varchar k, o_custkey, 0.0::double s, o_totalprice e, o_orderstatus label, o_orderkey % 6 = 0 as split from orders)
select k, o_custkey, s, e, label from o where not split union all select k || 'a', o_custkey, s, e / 4, label from o where split union all select k || 'b', o_custkey, e / 4, e, null from o where split""")
def split_rows(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("k"), "o_custkey", F.lit(0.0).alias("s"), F.col("o_totalprice").alias("e"), F.col("o_orderstatus").alias("label"))
    return mg.split_rows(rows, F.col("k").cast("long") % 6 == 0, F.col("e") / 4, "k", "s", "e", "label")


@register("q_reanchor", """
with old as (select l_orderkey // 2 as old_id, l_orderkey * 10 + l_linenumber as key, (l_orderkey // 2) % 7 as label from lineitem where l_linenumber <> 2),
new as (select l_orderkey // 3 as new_id, l_orderkey * 10 + l_linenumber as key from lineitem),
n as (select new_id, count(distinct key) n_keys from new group by 1),
h as (select new_id, old_id, label, count(*) hits from (select distinct * from old) join (select distinct * from new) using (key) group by 1, 2, 3),
b as (select *, row_number() over (partition by new_id order by hits desc, old_id) r from h), c as (select new_id, count(distinct label) n_labels from h group by 1)
select new_id, label, hits, n_keys from b join n using (new_id) join c using (new_id) where r = 1 and (hits / n_keys >= 0.6 or n_labels = 1)""")
def reanchor(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("key"))
    half = F.floor(F.col("l_orderkey") / 2)
    old = lines.filter("l_linenumber <> 2").select(half.alias("old_id"), "key", (half % 7).alias("label"))
    return mg.reanchor(old, lines.select(F.floor(F.col("l_orderkey") / 3).alias("new_id"), "key"), "old_id", "new_id", "key", "label")


_SESSIONS = """
with b as (select user_id, ts, case when lag(ts) over w is null or ts - lag(ts) over w > interval 30 minutes then 1 else 0 end s from events window w as (partition by user_id order by ts)),
r as (select *, sum(s) over (partition by user_id order by ts rows unbounded preceding) g from b)
select user_id, min(epoch_us(ts)) start_us, count(*) n from r group by user_id, g"""


def _sessions(found):
    return found.select("user_id", F.unix_micros("session_start").alias("start_us"), "n")


def _stamped(rows):
    """Event time as a timestamp in UTC, whatever the session's zone."""
    return rows.withColumn("at", F.expr("timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts))"))


@register("q_sessions", _SESSIONS)
def sessions(spark, sf):
    return _sessions(ss.sessions(_stamped(table(spark, sf, "events")), "user_id", "at", "30 minutes"))


@register("q_stream_sessions", _SESSIONS)
def stream_sessions(spark, sf):
    shape = table(spark, sf, "events").schema
    stream = spark.readStream.schema(shape).option("pathGlobFilter", "events.parquet").parquet(sf)
    base = private_folder(spark, "stream")
    found = ss.sessions(_stamped(stream), "user_id", "at", "30 minutes", late="1 hour")
    return _sessions(ss.run_available(found, f"{base}/out", f"{base}/state", "complete"))


def _snapshot_rows(rows, version):
    """A version of the orders: the second and third have other totals, the third no open ones."""
    own = rows.filter("o_orderstatus <> 'O'") if version == 3 else rows
    return own.withColumn("o_totalprice", F.col("o_totalprice") + (version - 1) * 10)


@register("q_snapshots", """
with v as (select 1 as version, count(*) n from orders union all select 2, count(*) from orders union all select 3, count(*) from orders where o_orderstatus <> 'O')
select 'v' || version as version, n::bigint n, version <> 2 intact, version = 3 published, version > 1 kept, (version <> 2)::int readable from v""")
def snapshots(spark, sf):
    """Three versions of a table; a file of the second is lost; all are checked, read and rotated."""
    folder = private_folder(spark, "snapshots")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice").repartition(4)
    for version in (1, 2, 3):
        sn.write_snapshot(_snapshot_rows(rows, version), folder, f"v{version}")
    lost = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/v2/data/part-*.parquet")
    files = lost.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(files.globStatus(lost)[0].getPath(), False)
    told, published = [], sn.current(spark, folder)
    for version in sn.versions(spark, folder):
        bad = sn.check_snapshot(spark, folder, version).filter("state <> 'ok'").count()
        n = spark.read.schema("n long").json(f"{folder}/{version}/manifest").agg(F.sum("n")).first()[0]
        try:
            readable = int(sn.read_snapshot(spark, folder, version).count() == n)
        except ValueError:
            readable = 0
        told.append([version, n, not bad, version == published, readable])
    gone = sn.rotate(spark, folder, 2)
    shape = "version string, n long, intact boolean, published boolean, kept boolean, readable int"
    return spark.createDataFrame([(v, n, intact, now, v not in gone, readable) for v, n, intact, now, readable in told], shape)


_DERIVED = "k long, version int, total double, label string, carried boolean"


def _corrected(spark, sf, folder, files):
    """Orders as they come in: all but some at first, then late ones and corrections, and then older versions of some."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("label"))
    parts = [
        orders.filter("k % 5 <> 0").select("k", F.lit(1).alias("version"), "price", "label"),
        orders.filter("k % 5 = 0 or k % 3 = 0").select("k", F.lit(3).alias("version"), (F.col("price") + 1).alias("price"), F.when(F.col("k") % 2 == 0, F.col("label")).alias("label")),
        orders.filter("k % 7 = 0").select("k", F.lit(2).alias("version"), (F.col("price") - 1).alias("price"), "label"),
    ]
    for number in files:
        parts[number].coalesce(1).write.mode("append").parquet(f"{folder}/arrived")  # a file an arrival, as the stream takes them
    return spark.readStream.schema("k long, version int, price double, label string").option("maxFilesPerTrigger", 1).parquet(f"{folder}/arrived")


def _made(inputs, before):
    """A total for each order; a label that the order lacks now is carried from what it had before."""
    had = before.select("k", F.col("label").alias("had"))
    both = inputs.join(had, "k", "left")
    return both.select("k", "version", F.round(F.col("price") * 2, 2).alias("total"), F.coalesce("label", "had").alias("label"), (F.col("label").isNull() & F.col("had").isNotNull()).alias("carried"))


_FOLLOWED = """
with o as (select o_orderkey k, o_totalprice price, o_orderpriority label from orders),
i as (select k, 1 as version, price, label from o where k % 5 <> 0 union all select k, 3, price + 1, case when k % 2 = 0 then label end from o where k % 5 = 0 or k % 3 = 0 union all select k, 2, price - 1, label from o where k % 7 = 0),
n as (select *, row_number() over (partition by k order by version desc) r from i)
select k, n.version::int as version, round(n.price * 2, 2) total, coalesce(n.label, case when n.k % 5 <> 0 then o.label end) as label, n.label is null and n.k % 5 <> 0 carried from n join o using (k) where r = 1"""


@register("q_stream_corrected", _FOLLOWED)
def stream_corrected(spark, sf):
    """Late and corrected inputs, a file a micro-batch: what is derived follows the newest version and keeps labels that were lost."""
    folder = private_folder(spark, "corrected")
    for number in (0, 1, 2):
        co.follow(_corrected(spark, sf, folder, [number]), folder, "k", "version", _made, _DERIVED)
    return co.derived_rows(spark, folder, "k", "version", _DERIVED)


@register("q_stream_resumed", _FOLLOWED)
def stream_resumed(spark, sf):
    """The same, stopped while the second batch is worked on, after its inputs were stored; then gone on with from the checkpoint."""
    folder = private_folder(spark, "resumed")

    def stop(number, step):
        if number == 1 and step == "derived":
            raise InterruptedError("stopped")

    co.follow(_corrected(spark, sf, folder, [0]), folder, "k", "version", _made, _DERIVED)
    try:
        co.follow(_corrected(spark, sf, folder, [1]), folder, "k", "version", _made, _DERIVED, stop)
    except Exception as error:
        if "stopped" not in str(error):
            raise
    co.follow(_corrected(spark, sf, folder, [2]), folder, "k", "version", _made, _DERIVED)
    return co.derived_rows(spark, folder, "k", "version", _DERIVED)
