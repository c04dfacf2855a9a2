"""Evaluation: rank statistics, error rates, thresholds, reliability. Bounded results from aggregates over counted scores.

Equal scores are counted first, so the ordered step sees one row per distinct score, and it runs over ranges of scores that add up
(``running``): no task holds all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .running import running


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(truth, predicted, n)."""
    return df.groupBy(truth, predicted).agg(F.count("*").alias("n"))


def accuracy_by(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(truth, n, accuracy) per true label."""
    return df.groupBy(truth).agg(F.count("*").alias("n"), F.avg((F.col(truth) == F.col(predicted)).cast("double")).alias("accuracy"))


def _counted(df: DataFrame, score: str, hit: Column, weight: Column | None = None) -> DataFrame:
    w = weight if weight is not None else F.lit(1.0)
    return df.groupBy(F.col(score).alias("s")).agg(F.sum(F.when(hit, w).otherwise(0.0)).alias("pos"), F.sum(F.when(hit, 0.0).otherwise(w)).alias("neg"))


def auc(df: DataFrame, score: str, hit: Column) -> DataFrame:
    """One row (auc, n_pos, n_neg): the chance that a positive scores above a negative, ties half; null if a class is empty."""
    ranked = running(_counted(df.filter(F.col(score).isNotNull()), score, hit), "s", {"upto": "neg"})
    sums = ranked.agg(F.sum(F.col("pos") * (F.col("upto") - F.col("neg") / 2)).alias("u"), F.sum("pos").alias("p"), F.sum("neg").alias("q"))
    return sums.select((F.col("u") / F.nullif(F.col("p") * F.col("q"), F.lit(0.0))).alias("auc"), F.col("p").cast("long").alias("n_pos"), F.col("q").cast("long").alias("n_neg"))


def eer(df: DataFrame, score: str, hit: Column) -> DataFrame:
    """One row (eer, threshold): where the shares of missed positives and of let-in negatives are closest, and their mean."""
    counted = _counted(df.filter(F.col(score).isNotNull()), score, hit)
    totals = counted.agg(F.sum("pos").alias("p"), F.sum("neg").alias("q"))
    curve = running(counted, "s", {"tp": "pos", "fp": "neg"}, descending=True).crossJoin(F.broadcast(totals))  # one row
    rates = curve.select("s", (1 - F.col("tp") / F.col("p")).alias("frr"), (F.col("fp") / F.col("q")).alias("far"))
    best = rates.agg(F.min(F.struct(F.round(F.abs(F.col("frr") - F.col("far")), 9).alias("gap"), (-F.col("s")).alias("minus"), ((F.col("frr") + F.col("far")) / 2).alias("eer"))).alias("b"))
    return best.select(F.col("b.eer").alias("eer"), (-F.col("b.minus")).alias("threshold"))


def precision_threshold(df: DataFrame, score: str, hit: Column, target: float, weight: Column | None = None) -> DataFrame:
    """One row (threshold): the least score down to which the weighted precision from the top is at least ``target``; 1.0 if none."""
    curve = running(_counted(df.filter(F.col(score).isNotNull()), score, hit, weight), "s", {"tp": "pos", "fp": "neg"}, descending=True)
    return curve.agg(F.coalesce(F.min(F.when(F.col("tp") / (F.col("tp") + F.col("fp")) >= target, F.col("s"))), F.lit(1.0)).alias("threshold"))


def reliability(df: DataFrame, p: str, hit: Column, edges: Sequence[float]) -> DataFrame:
    """(bin, n, mean_p, mean_y) over half-open bins, the last one closed; empty bins are left out."""
    at = F.lit(None).cast("int")
    for k in range(len(edges) - 2, -1, -1):
        last = k == len(edges) - 2
        inside = (F.col(p) >= edges[k]) & ((F.col(p) <= edges[k + 1]) if last else (F.col(p) < edges[k + 1]))
        at = F.when(inside, F.lit(k)).otherwise(at)
    return df.withColumn("bin", at).filter("bin is not null").groupBy("bin").agg(F.count("*").alias("n"), F.avg(p).alias("mean_p"), F.avg(hit.cast("double")).alias("mean_y"))


def bottom_share(df: DataFrame, score: str, key: str, hit: Column, shares: Sequence[float]) -> DataFrame:
    """(share, n, wrong, captured): how many of the wrong are among the lowest-scored share of all rows, equals by (numeric) key.

    Whole scores are counted; only the rows of the score at which a share ends are ordered by key.
    """
    rows = df.select(F.col(score).alias("s"), F.col(key).alias("k"), (~hit).cast("long").alias("wrong")).filter("s is not null")
    counted = running(rows.groupBy("s").agg(F.count("*").alias("n"), F.sum("wrong").alias("w")), "s", {"upto": "n", "w_upto": "w"})
    total = counted.agg(F.max("upto").alias("all_n"), F.max("w_upto").alias("all_wrong"))
    steps = df.sparkSession.createDataFrame([(float(x),) for x in shares], "share double")
    limits = F.broadcast(steps.crossJoin(total).withColumn("end", F.floor(F.col("all_n") * F.col("share"))))  # a row a share
    whole = counted.join(limits, F.col("upto") <= F.col("end")).groupBy("share").agg(F.max("w_upto").alias("below"))
    split = counted.join(limits, (F.col("upto") > F.col("end")) & (F.col("upto") - F.col("n") < F.col("end"))).select("share", F.col("s"), (F.col("end") - F.col("upto") + F.col("n")).alias("more"))
    at_end = rows.join(F.broadcast(split), "s").groupBy("k", "share", "more").agg(F.count("*").alias("n"), F.sum("wrong").alias("w"))
    found = limits.join(whole, "share", "left").withColumn("wrong", F.coalesce("below", F.lit(0)))
    for share in shares:  # a few
        placed = running(at_end.filter(F.col("share") == float(share)), "k", {"upto": "n"})
        # several rows of the last key: those within the limit, the wrong ones last
        extra = placed.filter("upto - n < more").agg(F.coalesce(F.sum(F.when(F.col("upto") <= F.col("more"), F.col("w")).otherwise(F.greatest(F.lit(0), F.col("w") - (F.col("upto") - F.col("more"))))), F.lit(0)).alias("__x"))
        found = found.crossJoin(F.broadcast(extra)).withColumn("wrong", F.col("wrong") + F.when(F.col("share") == float(share), F.col("__x")).otherwise(0)).drop("__x")  # one row
    return found.select("share", F.col("end").alias("n"), "wrong", (F.col("wrong") / F.greatest(F.col("all_wrong"), F.lit(1))).alias("captured"))


def spearman_mae(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row (rho, mae, n): the correlation of average ranks, null for fewer than three rows, and the ranks' mean distance.

    Rows are counted by pair of values, so that no value is a task's work; a value's average rank follows from the rows up to it.
    """
    pairs = df.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null").groupBy("a", "b").agg(F.count("*").alias("n"))
    ranks = {c: running(pairs.groupBy(c).agg(F.sum("n").alias("__n")), c, {"__upto": "__n"}).select(c, (F.col("__upto") - (F.col("__n") - 1) / 2).alias(f"r{c}")) for c in ("a", "b")}
    ranked = pairs.join(ranks["a"], "a").join(ranks["b"], "b")
    n, x, y = F.sum("n"), F.sum(F.col("n") * F.col("ra")), F.sum(F.col("n") * F.col("rb"))
    xy, xx, yy = (F.sum(F.col("n") * F.col(u) * F.col(v)) for u, v in (("ra", "rb"), ("ra", "ra"), ("rb", "rb")))
    rho = (xy - x * y / n) / F.nullif(F.sqrt((xx - x * x / n) * (yy - y * y / n)), F.lit(0.0))
    return ranked.agg(F.when(n >= 3, F.round(rho, 6)).alias("rho"), F.round(F.sum(F.col("n") * F.abs(F.col("ra") - F.col("rb"))) / n, 2).alias("mae"), F.coalesce(n, F.lit(0)).alias("n"))
