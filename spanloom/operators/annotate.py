"""Operators on tracks, words and boards: relabelled tracks, wide scores, word times, cuts, time maps, review queues."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def relabel_by_presence(track: DataFrame, keys: Sequence[str], frame: str, voice: str, every: int) -> DataFrame:
    """(keys, frame, voice): every ``every``-th frame from half of it; the two commonest voices are 0 and 1, others 2, none (below 0) -1."""
    keys = list(keys)
    counts = track.filter(F.col(voice) >= 0).groupBy(*keys, voice).agg(F.count("*").alias("__n"))
    placed = counts.withColumn("__p", F.least(F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("__n"), voice)) - 1, F.lit(2)))
    kept = track.filter(F.col(frame) % every == every // 2).join(placed.select(*keys, voice, "__p"), [*keys, voice], "left")
    return kept.select(*keys, frame, F.coalesce("__p", F.lit(-1)).cast("long").alias(voice))


def best_wide_column(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, best, mean, entropy): the wide score column with the highest mean in a group (equals: the first by name), and the entropy of the means' shares."""
    means = df.groupBy(*keys).agg(*(F.avg(c).alias(c) for c in columns))
    long = means.unpivot(list(keys), list(columns), "best", "mean")
    share = F.col("mean") / F.nullif(F.sum("mean").over(Window.partitionBy(*keys)), F.lit(0.0))
    shared = long.withColumn("share", share)
    packed = shared.groupBy(*keys).agg(F.min(F.struct((-F.col("mean")).alias("minus"), F.col("best"))).alias("b"), (-F.sum(F.when(F.col("share") > 0, F.col("share") * F.ln("share")).otherwise(0.0))).alias("entropy"))
    return packed.select(*keys, F.col("b.best").alias("best"), (-F.col("b.minus")).alias("mean"), "entropy")


def nested_counts(df: DataFrame, key: str, other: str) -> DataFrame:
    """(key, n, per_other map<string, long>): counts per key, and per other value below it; values are counted before they are packed."""
    counts = df.groupBy(key, other).agg(F.count("*").alias("__n"))
    return counts.groupBy(key).agg(F.sum("__n").alias("n"), F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(other).cast("string").alias("o"), "__n")))).alias("per_other"))


def words_to_lines(words: DataFrame, lines: DataFrame, keys: Sequence[str], word_order: str, line_order: str, n_words: str) -> DataFrame:
    """``words`` with the line each belongs to by the lines' word counts; words left over go to the last line that has any."""
    keys = list(keys)
    at = Window.partitionBy(*keys).orderBy(line_order)
    ends = lines.filter(F.col(n_words) > 0).withColumns({"__to": F.sum(n_words).over(at), "__last": F.lead(line_order).over(at).isNull()}).withColumn("__from", F.col("__to") - F.col(n_words))
    placed = words.withColumn("__p", F.row_number().over(Window.partitionBy(*keys).orderBy(word_order)) - 1)
    spread = ends.select(*keys, F.col(line_order).alias("line"), "__from", F.when(F.col("__last"), F.lit(1 << 60)).otherwise(F.col("__to")).alias("__to"))
    return placed.join(spread, keys).filter((F.col("__p") >= F.col("__from")) & (F.col("__p") < F.col("__to"))).drop("__p", "__from", "__to")


def candidate_cuts(words: DataFrame, keys: Sequence[str], order: str, start: str, end: str, item_start: Column, item_end: Column, side: float) -> DataFrame:
    """(keys, cut, after): midpoints between consecutive words that leave at least ``side`` on both sides."""
    at = Window.partitionBy(*keys).orderBy(order)
    cuts = words.withColumns({"cut": (F.lag(end).over(at) + F.col(start)) / 2, "after": F.row_number().over(at) - 1}).filter("cut is not null")
    return cuts.filter((F.col("cut") - item_start >= side) & (item_end - F.col("cut") >= side)).select(*keys, "cut", "after")


def nearest_cut(cuts: DataFrame, wanted: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """(keys, cut, after): each wanted time's closest candidate cut, the earlier of equals."""
    best = F.min(F.struct(F.round(F.abs(F.col("cut") - F.col(at)), 9).alias("d"), "cut", "after")).alias("b")
    return cuts.join(wanted, list(keys)).groupBy(*keys).agg(best).select(*keys, "b.cut", "b.after")


def fill_missing_times(words: DataFrame, keys: Sequence[str], order: str, start: str, end: str, length: Column) -> DataFrame:
    """``words`` with missing starts and ends from the previous known end and the next known start, shared out by length where several miss in a row."""
    at = Window.partitionBy(*keys).orderBy(order)
    before, after = at.rowsBetween(Window.unboundedPreceding, -1), at.rowsBetween(1, Window.unboundedFollowing)
    known = F.col(start).isNotNull()
    grouped = words.withColumns({"__lo": F.last(F.when(known, F.col(end)), ignorenulls=True).over(before), "__hi": F.first(F.when(known, F.col(start)), ignorenulls=True).over(after), "__g": F.sum(known.cast("int")).over(at.rowsBetween(Window.unboundedPreceding, 0)), "__w": length + 1})
    span = Window.partitionBy(*keys, "__g", known).orderBy(order)
    low, high = F.coalesce("__lo", "__hi"), F.coalesce("__hi", "__lo")
    upto = F.sum("__w").over(span.rowsBetween(Window.unboundedPreceding, 0)) / F.sum("__w").over(Window.partitionBy(*keys, "__g", known))
    own = F.col("__w") / F.sum("__w").over(Window.partitionBy(*keys, "__g", known))
    filled = grouped.withColumns({"__s": low + (high - low) * (upto - own), "__e": low + (high - low) * upto})
    return filled.select(*(F.when(known, F.col(c)).otherwise(F.col(f)).alias(c) if (f := {start: "__s", end: "__e"}.get(c)) else F.col(c) for c in words.columns))


def rewrite_roots(paths: DataFrame, path: str, roots: DataFrame, root: str, new_root: str) -> DataFrame:
    """``paths`` with the longest root that starts a path replaced by its new one; other paths stay.

    Roots are configuration, a few rows: their number is checked, and they are sent to the tasks.
    """
    rows = [(r[0], r[1]) for r in roots.select(root, new_root).limit(1001).collect()]
    if len(rows) > 1000:
        raise ValueError("more than 1000 roots")
    out = F.col(path)
    for old, new in sorted(rows, key=lambda r: len(r[0])):
        out = F.when(F.col(path).startswith(old), F.concat(F.lit(new), F.substring(F.col(path), len(old) + 1, 1 << 30))).otherwise(out)
    return paths.withColumn(path, out)


def queue_order(queue: DataFrame, key: str, reason: str, duration: str, order: Sequence[str]) -> DataFrame:
    """(key, reason, priority, duration) by the item's most urgent reason, then longest first; unknown reasons come last."""
    place = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), F.col(reason)), F.lit(0)), F.lit(len(order) + 1))
    best = queue.withColumn("__p", place).groupBy(key).agg(F.min(F.struct("__p", F.col(reason))).alias("b"), F.max(duration).alias(duration))
    return best.select(key, F.col(f"b.{reason}").alias(reason), F.col("b.__p").cast("long").alias("priority"), duration).orderBy("priority", F.desc(duration), key)


def one_per_group_first(df: DataFrame, group: str, order: Sequence[Column], n: int) -> DataFrame:
    """``n`` rows: the best of each group first, then the rest, both by ``order``."""
    placed = df.withColumn("__g", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return placed.orderBy((F.col("__g") > 1), *order).limit(n).drop("__g")


def flags_of_interval(df: DataFrame, actual: str, wanted: str, slack: float = 5.0, share: float = 0.02) -> DataFrame:
    """``df`` with truncated: shorter than wanted by more than the larger of ``slack`` and a share of it; null where either is unknown."""
    return df.withColumn("truncated", F.col(actual) < F.col(wanted) - F.greatest(F.lit(slack), F.col(wanted) * share))


def coverage(items: DataFrame, key: str, duration: str, open_flag: Column, candidates: DataFrame, least_items: int = 5, least_duration: float = 15.0, quiet: float = 5.0) -> DataFrame:
    """(key, n, secs, n_open, status) for every candidate: banked with enough items and time, quiet with little time, else thin."""
    own = items.groupBy(key).agg(F.count("*").alias("n"), F.sum(duration).alias("secs"), F.count_if(open_flag).alias("n_open"))
    all_of = candidates.select(key).distinct().join(own, key, "left").na.fill(0, ["n", "secs", "n_open"])
    return all_of.withColumn("status", F.when((F.col("n") >= least_items) & (F.col("secs") >= least_duration), "banked").when(F.col("secs") < quiet, "quiet").otherwise("thin"))


def lag_of_signals(pairs: DataFrame, key: str, a: str, b: str, most: int) -> DataFrame:
    """(key, lag, score): the shift of up to ``most`` frames at which two equally spaced signals (array<double>) agree most, and its z-score among shifts more than 5 away.

    One row is one pair; the correlation is a product of Fourier transforms on Arrow batches.
    """

    def best(x: np.ndarray, y: np.ndarray) -> tuple[int, float]:
        x, y = x - x.mean(), y - y.mean()
        size = 1 << int(np.ceil(np.log2(len(x) + len(y))))
        both = np.fft.irfft(np.fft.rfft(x, size) * np.conj(np.fft.rfft(y, size)), size)
        lags = np.arange(-most, most + 1)
        score = both[lags % size] / (np.linalg.norm(x) * np.linalg.norm(y) + 1e-9)
        at = int(np.round(score, 9).argmax())
        far = score[np.abs(lags - lags[at]) > 5]
        return int(lags[at]), float((score[at] - far.mean()) / (far.std() + 1e-9)) if far.size else 0.0

    def made(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            found = [best(np.asarray(x, np.float64), np.asarray(y, np.float64)) for x, y in zip(pdf[a], pdf[b], strict=True)]
            yield pd.DataFrame({key: pdf[key], "lag": [f[0] for f in found], "score": [f[1] for f in found]})

    own = pairs.filter((F.size(a) > 0) & (F.size(b) > 0)).select(key, a, b)
    return own.mapInPandas(made, f"{key} {pairs.schema[key].dataType.simpleString()}, lag long, score double")


def sample_pairs(items: DataFrame, key: str, label: str, group: str, n: int, seed: str = "pairs") -> DataFrame:
    """(a, b, target): per label up to ``n`` pairs of its items (target 1), and per group up to ``n`` of items with different labels (0).

    No group is paired with itself whole: items stand in a seeded order, and each meets the next one of its label and, if that has
    another label, the next one of its group.
    """
    mix = F.sha1(F.concat(F.lit(seed), F.col(key).cast("string")))
    by_label, by_group = Window.partitionBy(label).orderBy(mix), Window.partitionBy(group).orderBy(mix)
    same = items.withColumns({"b": F.lead(key).over(by_label), "__r": F.row_number().over(by_label)}).filter((F.col("b").isNotNull()) & (F.col("__r") <= n)).select(F.col(key).alias("a"), "b", F.lit(1).alias("target"))
    other = items.withColumns({"b": F.lead(key).over(by_group), "__l": F.lead(label).over(by_group)}).filter(F.col("__l") != F.col(label)).withColumn("__r", F.row_number().over(by_group)).filter(F.col("__r") <= n).select(F.col(key).alias("a"), "b", F.lit(0).alias("target"))
    return same.unionByName(other)


def split_sets(items: DataFrame, season: str, episode: str, test: Sequence[str]) -> DataFrame:
    """``items`` with split: test for the named seasons, dev for a season's last episode if it has several, else train."""
    whole = Window.partitionBy(season)
    last = F.max(episode).over(whole)
    several = F.min(episode).over(whole) < last
    return items.withColumn("split", F.when(F.col(season).isin(*test), "test").when((F.col(episode) == last) & several, "dev").otherwise("train"))
