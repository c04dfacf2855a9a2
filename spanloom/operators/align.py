"""Words of two texts side by side: matching blocks in order, and the times they give to what was matched."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sequence import fold


def _grams(words: Column, width: int) -> Column:
    """For each run of ``width`` words: its place, a hash of it, and hashes of the words before and after it, null at the ends."""
    hashed = F.transform(words, lambda w: F.xxhash64(w))

    def made(h: Column) -> Column:
        one = lambda i: F.struct(i.alias("at"), F.xxhash64(*(F.get(h, i + k) for k in range(width))).alias("g"), F.get(h, i - 1).alias("before"), F.get(h, i + width).alias("after"))
        return F.when(F.size(h) >= width, F.transform(F.sequence(F.lit(0), F.size(h) - width), one))

    return F.transform(F.array(hashed), made)[0]


def common_runs(pairs: DataFrame, key: str, a_words: str, b_words: str, least: int = 3) -> DataFrame:
    """(key, a_at, b_at, n): all maximal runs of ``least`` or more equal words of two word lists of a row.

    Places with equal runs of ``least`` words meet by an equi-join, which only lets through those where a run begins or ends; along a
    diagonal a beginning's run ends at the first end from there on. So a phrase that is repeated makes as many rows as runs, not as places.
    """
    side = lambda words, name: pairs.filter(F.size(words) >= least).select(F.col(key).alias("__k"), F.explode(_grams(F.col(words), least)).alias(name))
    a, b = side(a_words, "a").select("__k", F.col("a.g").alias("g"), "a"), side(b_words, "b").select(F.col("__k").alias("__o"), F.col("b.g").alias("h"), "b")
    starts = F.coalesce(F.col("a.before") != F.col("b.before"), F.lit(True))
    ends = F.coalesce(F.col("a.after") != F.col("b.after"), F.lit(True))
    met = a.join(b, (F.col("__k") == F.col("__o")) & (F.col("g") == F.col("h")) & (starts | ends))
    turns = met.select(F.col("__k").alias(key), F.col("a.at").cast("long").alias("a_at"), F.col("b.at").cast("long").alias("b_at"), starts.alias("starts"), F.when(ends, F.col("a.at")).alias("end"))
    diagonal = Window.partitionBy(key, F.col("a_at") - F.col("b_at")).orderBy("a_at").rowsBetween(0, Window.unboundedFollowing)
    return turns.withColumn("n", F.min("end").over(diagonal) - F.col("a_at") + least).filter("starts").select(key, "a_at", "b_at", F.col("n").cast("long").alias("n"))


def _chosen(rows: Iterator[tuple], least: int) -> Iterator[tuple]:
    """Of common runs (a_at, b_at, n) the longest (equals: first in a, then in b), then the longest of what lies wholly before it and after it, and so on.

    A run that a chosen one cuts goes on with what is left of it on either side.
    """
    runs = np.array(list(rows), np.int64).reshape(-1, 3)
    far = np.iinfo(np.int64).max // 4
    open_ = [(0, far, 0, far, runs)]
    while open_:
        a0, a1, b0, b1, own = open_.pop()
        skip = np.maximum(0, np.maximum(a0 - own[:, 0], b0 - own[:, 1]))
        n = np.minimum(own[:, 2], np.minimum(a1 - own[:, 0], b1 - own[:, 1])) - skip
        good = n >= least
        if not good.any():
            continue
        own = np.c_[own[good, 0] + skip[good], own[good, 1] + skip[good], n[good]]
        a, b, size = own[np.lexsort((own[:, 1], own[:, 0], -own[:, 2]))[0]].tolist()
        yield a, b, size
        open_ += [(a0, a, b0, b, own), (a + size, a1, b + size, b1, own)]


def ordered_blocks(pairs: DataFrame, key: str, a_words: str, b_words: str, least: int = 3) -> DataFrame:
    """(key, a_at, b_at, n): the matching blocks of two word lists of a row, in order and without crossing, of ``least`` words or more.

    The longest common run is a block, equals by their place in a, then in b; then the same before it and after it. Common runs are found
    by joins and windows over all places; a task then holds one row's runs, not its words. ``key`` names a row; rows whose key or list
    is null have no blocks, and words that are null match nothing.
    """
    runs = common_runs(pairs, key, a_words, b_words, least)
    return fold(runs, [key], ["a_at", "b_at"], ["a_at", "b_at", "n"], lambda rows: _chosen(rows, least), "a_at long, b_at long, n long")


def anchored_times(blocks: DataFrame, key: str, cues: DataFrame, words: DataFrame, cue: str, at: str, start: str, end: str) -> DataFrame:
    """(key, cue, t0, t1): the times of a cue's first and last word, where a block of ``ordered_blocks`` holds that word.

    ``cues`` has (key, at, cue, is_first, is_last) a word, ``words`` (key, at, start, end).
    """
    spread = blocks.select(key, F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("k"), "a_at", "b_at").select(key, (F.col("a_at") + F.col("k")).alias(at), (F.col("b_at") + F.col("k")).alias("__b"))
    timed = spread.join(words.select(key, F.col(at).alias("__b"), start, end), [key, "__b"])
    return cues.join(timed, [key, at]).groupBy(key, cue).agg(F.min(F.when(F.col("is_first"), F.col(start))).alias("t0"), F.max(F.when(F.col("is_last"), F.col(end))).alias("t1")).filter("t0 is not null or t1 is not null")
