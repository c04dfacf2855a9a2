"""Choosing, counting and aggregating rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Rows of a few numbers each that a side sent to every task may have.
SMALL_ROWS = 500_000


def small_side(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it has at most SMALL_ROWS rows, counted as far as that; else as it is, for a shuffle join."""
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def spread_join(rows: DataFrame, wide: DataFrame, key: str, most: int = 100_000) -> DataFrame:
    """``rows`` joined with ``wide``, a long row a key: a key with more than ``most`` rows is dealt to several places, its long row to each."""
    heavy = rows.groupBy(key).agg(F.ceil(F.count("*") / most).cast("int").alias("__places")).filter("__places > 1")
    heavy = F.broadcast(heavy)  # one for ``most`` rows at most
    place = F.pmod(F.xxhash64(*(c for c in rows.columns if c != key)), F.coalesce("__places", F.lit(1))).cast("int")
    dealt = rows.join(heavy, key, "left").withColumn("__place", place).drop("__places")
    copies = wide.join(heavy, key, "left").withColumn("__place", F.explode(F.sequence(F.lit(0), F.coalesce("__places", F.lit(1)) - 1))).drop("__places")
    return dealt.join(copies, [key, "__place"]).drop("__place")


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, rank: str = "rank_no") -> DataFrame:
    """The first ``n`` rows of each group by ``order``, numbered in ``rank``."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(rank) <= n)


def mode_per_group(df: DataFrame, keys: Sequence[str], value: str, out: str = "mode_value") -> DataFrame:
    """The most frequent value of each group, the least of equals, and its count ``n``: counted first, so no group is gathered."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    best = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("minus"), F.col(value))).alias("b"))
    return best.select(*keys, F.col(f"b.{value}").alias(out), (-F.col("b.minus")).alias("n"))


def pivot_counts(df: DataFrame, key: str | Column, column: str, values: Sequence[str], prefix: str = "n_") -> DataFrame:
    """A row per key with the count of each of the given values, 0 where there is none."""
    counted = [F.count_if(F.col(column) == v).alias(f"{prefix}{v}") for v in values]
    return df.groupBy(key).agg(*counted)


def ordered_text(df: DataFrame, keys: Sequence[str], order: str, text: str, out: str, limit: int | None = None) -> DataFrame:
    """The group's non-null texts joined by spaces in order, cut to ``limit`` characters."""
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(order), F.col(text)))), lambda x: x[text]), " ")
    return df.filter(F.col(text).isNotNull()).groupBy(*keys).agg((F.substring(joined, 1, limit) if limit else joined).alias(out))


def subtotals(df: DataFrame, key: str, measures: dict[str, Column], total: str = "all") -> DataFrame:
    """Aggregates per key and one row ``total`` over all."""
    return df.rollup(key).agg(F.grouping(key).alias("is_total"), *(c.alias(n) for n, c in measures.items())).withColumn(key, F.when(F.col("is_total") == 1, F.lit(total)).otherwise(F.col(key))).drop("is_total")


def average_rank(partition: Sequence[str], value: str) -> Column:
    """Rank with ties sharing their mean rank, over ``partition`` (all rows if empty)."""
    by = Window.partitionBy(*partition)
    return F.rank().over(by.orderBy(value)) + (F.count("*").over(Window.partitionBy(*partition, value)) - 1) / 2
