"""Joins on time: bands, nearest, overlap, as-of. Bands are cut into bins, so that they plan as equi-joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def within_band(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, other_at: str, before: int, after: int) -> DataFrame:
    """Pairs with equal keys and other_at in [at - before, at + after] (whole numbers). The right side goes to its bin and each left row to the bins its band meets."""
    width = max(1, before + after)
    lo, hi = F.col(at) - before, F.col(at) + after
    binned = left.withColumn("__bin", F.explode(F.sequence(F.floor(lo / width), F.floor(hi / width))))
    other = right.withColumn("__bin", F.floor(F.col(other_at) / width))
    return binned.join(other, [*keys, "__bin"]).filter((F.col(other_at) >= lo) & (F.col(other_at) <= hi)).drop("__bin")


def nearest(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: str, at: str, other_id: str, other_at: str, tolerance: int) -> DataFrame:
    """Per left row the closest right row with equal keys within ``tolerance``, equals by least other_id. Rows without one are left out."""
    pairs = within_band(left, right, keys, at, other_at, tolerance, tolerance)
    best = F.min(F.struct(F.abs(F.col(other_at) - F.col(at)).alias("distance"), F.col(other_id), F.col(other_at)))
    return pairs.groupBy(*keys, left_id, at).agg(best.alias("b")).select(*keys, left_id, at, "b.*")


def closest_to_ideal(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: str, at: str, other_id: str, other_at: str, before: int, after: int, ideal: int) -> DataFrame:
    """Per left row the right row with other_at in [at - before, at + after] that is closest to at - ideal, equals by least other_id."""
    pairs = within_band(left, right, keys, at, other_at, before, after)
    best = F.min(F.struct(F.abs(F.col(at) - F.col(other_at) - ideal).alias("off"), F.col(other_id), F.col(other_at)))
    return pairs.groupBy(*keys, left_id, at).agg(best.alias("b")).select(*keys, left_id, at, "b.*")


def overlap_best(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: str, start: str, end: str, other_id: str, other_start: str, other_end: str, width: int, ideal: int = 0) -> DataFrame:
    """Per left interval the right one that overlaps it most; equals by how close its start is to start - ideal, then by id.

    ``width`` is the bins' size; both sides go to all bins they meet, and a pair is taken in the first bin both meet.
    """
    bins = lambda a, b: F.sequence(F.floor(F.col(a) / width), F.floor(F.col(b) / width))
    l, r = left.withColumn("__bin", F.explode(bins(start, end))), right.withColumn("__bin", F.explode(bins(other_start, other_end)))  # noqa: E741
    common = F.least(F.col(end), F.col(other_end)) - F.greatest(F.col(start), F.col(other_start))
    first = F.floor(F.greatest(F.col(start), F.col(other_start)) / width)
    pairs = l.join(r, [*keys, "__bin"]).filter((F.col("__bin") == first) & (common > 0)).withColumn("common", common)
    best = F.min(F.struct((-F.col("common")).alias("minus"), F.abs(F.col(start) - F.col(other_start) - ideal).alias("off"), F.col(other_id)))
    return pairs.groupBy(*keys, left_id).agg(best.alias("b")).select(*keys, left_id, F.col(f"b.{other_id}").alias(other_id), (-F.col("b.minus")).alias("common"))


def as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, other_at: str, value: str, out: str, forward: bool = False, within: int | None = None) -> DataFrame:
    """``left`` with ``out``, the value of the last right row at or before its time (forward: the first at or after), or null.

    Both sides become one timeline per key, so it is one shuffle whatever the sizes; equal times count, equal right times take the
    greatest value.
    """
    own = left.withColumns({"__t": F.col(at), "__side": F.lit(1), "__v": F.lit(None).cast(right.schema[value].dataType), "__rt": F.lit(None).cast(right.schema[other_at].dataType)})
    there = right.groupBy(*keys, other_at).agg(F.max(value).alias("__v")).select(*keys, F.col(other_at).alias("__t"), F.lit(0).alias("__side"), "__v", F.col(other_at).alias("__rt"))
    both = own.unionByName(there, allowMissingColumns=True)
    order = [F.desc("__t"), F.col("__side")] if forward else [F.col("__t"), F.col("__side")]
    span = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumns({"__fv": F.last("__v", ignorenulls=True).over(span), "__ft": F.last("__rt", ignorenulls=True).over(span)}).filter("__side = 1")
    hit = F.col("__fv") if within is None else F.when(F.abs(F.col("__t") - F.col("__ft")) <= within, F.col("__fv"))
    return found.withColumn(out, hit).select(*left.columns, out)


def as_of_version(left: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, version: str, values: Sequence[str]) -> DataFrame:
    """``left`` with the values of the newest version at or before ``at`` (all null if there is none): a dimension kept by version."""
    packed = versions.select(*keys, F.col(version), F.struct(F.col(version).alias("version"), *values).alias("__v"))
    found = as_of(left, packed, keys, at, version, "__v", "__found")
    return found.select(*left.columns, F.col("__found.version").alias(version), *(F.col(f"__found.{v}").alias(v) for v in values))


def interpolate(points: DataFrame, knots: DataFrame, keys: Sequence[str], at: str, knot_at: str, knot_value: str, out: str) -> DataFrame:
    """``points`` with the piecewise-linear value of the knots at their time, flat beyond the ends; null without knots."""
    packed = knots.select(*keys, F.col(knot_at), F.struct(F.col(knot_at).alias("t"), F.col(knot_value).cast("double").alias("v")).alias("__k"))
    both = as_of(as_of(points, packed, keys, at, knot_at, "__k", "__a"), packed, keys, at, knot_at, "__k", "__b", forward=True)
    span = (F.col("__b.t") - F.col("__a.t")).cast("double")
    inside = F.col("__a.v") + (F.col("__b.v") - F.col("__a.v")) * (F.col(at) - F.col("__a.t")).cast("double") / F.when(span > 0, span).otherwise(1.0)
    return both.withColumn(out, F.coalesce(inside, F.col("__a.v"), F.col("__b.v"))).drop("__a", "__b")


def flag(condition: Column) -> Column:
    """1 where a condition holds, else 0, null included."""
    return F.coalesce(condition, F.lit(False)).cast("int")
