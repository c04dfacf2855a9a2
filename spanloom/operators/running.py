"""Running sums over all rows of a table, without a window that one task would have to hold."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.sources.files import private_folder

#: Rows that one window may hold without ranges.
FEW = 50_000
#: Ranges that the order is cut into, for each shuffle partition.
RANGES = 2


def running(df: DataFrame, by: str, sums: Mapping[str, str], of: Callable[[str], Column] = F.sum, descending: bool = False, like: DataFrame | None = None) -> DataFrame:
    """``df`` (distinct, non-null numbers in ``by``) with a column for each of ``sums`` (new column: column): ``of`` over the rows up to and with each.

    The order is cut into ranges by approximate quantiles; each range is a window of its own and adds what the ranges before
    it came to, a row a range. Null counts as nothing. ``like``, a cheaper table with numbers in its only column that lie alike, gives the cuts.
    """
    spark = df.sparkSession
    inside = lambda: Window.orderBy(F.desc(by) if descending else F.col(by)).rowsBetween(Window.unboundedPreceding, 0)
    if df.limit(FEW + 1).count() <= FEW:
        return df.select("*", *(of(c).over(inside()).alias(name) for name, c in sums.items()))
    ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = (df.select(by) if like is None else like).toDF("__x").select(F.col("__x").cast("double")).approxQuantile("__x", [k / ranges for k in range(1, ranges)], 0.25 / ranges)
    bounds = F.lit(sorted(set(cuts))) if cuts else F.array().cast("array<double>")
    placed = df.withColumn("__r", F.size(F.filter(bounds, lambda b: b < F.col(by).cast("double"))))
    order = F.desc(by) if descending else F.col(by)
    within = Window.partitionBy("__r").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    range_order = F.desc("__r") if descending else F.col("__r")
    before = Window.orderBy(range_order).rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    totals = placed.groupBy("__r").agg(*(of(c).alias(f"__t_{name}") for name, c in sums.items()))
    ahead = totals.select("__r", *(of(f"__t_{name}").over(before).alias(f"__b_{name}") for name in sums))
    own = placed.withColumns({f"__o_{name}": of(c).over(within) for name, c in sums.items()})
    both = own.join(F.broadcast(ahead), "__r")  # a row a range
    joined = {name: _either(of, f"__b_{name}", f"__o_{name}") for name in sums}
    return both.select(*df.columns, *(c.alias(name) for name, c in joined.items()))


def row_numbers(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """``df`` with a row's place, from 0, in the whole table's ``order``; rows equal in it are in an arbitrary but settled order.

    Sorted ranges are stored with each row's place in its range, and what the ranges before hold is added: no task sees all rows.
    """
    spark = df.sparkSession
    path = private_folder(spark, "ranges")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("__range", F.shiftright("__id", 33))
    sizes = rows.groupBy("__range").agg(F.count("*").alias("n"))  # a row a range
    before = sizes.select("__range", F.coalesce(F.sum("n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    place = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1).cast("long")) + F.col("__before")
    return rows.join(F.broadcast(before), "__range").select(*df.columns, place.alias(out))


def zip_rows(a: DataFrame, a_order: Sequence[str], b: DataFrame, b_order: Sequence[str], at: str) -> DataFrame:
    """Two tables side by side by their rows' places in their own orders; the longer one's last rows stand beside nulls."""
    return row_numbers(a, a_order, at).join(row_numbers(b, b_order, at), at, "full")


def _either(of: Callable, a: str, b: str) -> Column:
    if of is F.max:
        return F.greatest(a, b)  # skips nulls
    return F.coalesce(F.col(a) + F.col(b), F.col(a), F.col(b))
