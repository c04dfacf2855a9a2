"""A quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting grows shallow trees on one feature at a time and adds them up to one lookup table per feature, then the same
on pairs of features; a score is the sigmoid of the sum of the tables' entries at a document's bins.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, id_text, stored, utf8

#: Labelled documents the model is fitted on, about, at most; chosen by a hash of doc_id.
SAMPLE_DOCS = 20_000
FEATURES = [
    "log_chars", "log_words", "mean_word", "sd_word", "long_words", "upper", "digits", "punctuation", "other_bytes", "spaces",
    "distinct_words", "commonest_word", "repeated_next", "distinct_pairs", "log_lines", "distinct_lines", "mean_line",
    "exclamations", "symbols", "pipes", "stops", "commas", "capital_words", "symbol_words",
]
_SPACE, _CAPITAL, _SYMBOL = (np.isin(np.arange(256), np.frombuffer(x, np.uint8)) for x in (b" \t\n\r\x0b\x0c", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"!%&$*#|=~^<>@"))


def features(text: bytes) -> list[float]:
    """Numbers that describe a text, in the order of FEATURES; an empty text has zeros."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    size, n = len(text), len(words)
    raw = np.frombuffer(text, np.uint8)
    count = np.bincount(raw, minlength=256)
    lengths = np.fromiter(map(len, words), np.float64, n)
    uses = Counter(words)
    gap = np.r_[True, _SPACE[raw], True]
    first, last = raw[gap[:-2] & ~gap[1:-1]], raw[~gap[1:-1] & gap[2:]]  # bytes of all words
    lines = [x for x in text.split(b"\n") if x.strip()]
    symbols = int(count[[33, 37, 38, 36, 42, 35, 124, 61, 126, 94, 60, 62, 64]].sum())
    again = sum(map(bytes.__eq__, words, words[1:]))
    return [
        float(np.log1p(size)), float(np.log1p(n)), float(lengths.mean()), float(lengths.std()), float((lengths > 14).mean()),
        count[65:91].sum() / size, count[48:58].sum() / size, (count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum()) / size,
        count[128:].sum() / size, (count[32] + count[9] + count[10]) / size,
        len(uses) / n, max(uses.values()) / n, again / n, len(set(zip(words, words[1:], strict=False))) / n,
        float(np.log1p(len(lines))), len(set(lines)) / max(1, len(lines)), float(np.log1p(size / max(1, len(lines)))),
        count[33] / n, symbols / n, count[124] / n, count[46] / n, count[44] / n,
        _CAPITAL[first].sum() / n, _SYMBOL[last].sum() / n,
    ]


def _best_cut(gain: np.ndarray, weight: np.ndarray, least: float, ridge: float) -> tuple[float, int]:
    """The cut (bins up to and with it go left) of a histogram that lowers the loss most, and by how much."""
    g, h = np.cumsum(gain), np.cumsum(weight)
    left, right = h[:-1], h[-1] - h[:-1]
    ok = (left >= least) & (right >= least)
    if not ok.any():
        return 0.0, -1
    score = np.where(ok, g[:-1] ** 2 / (left + ridge) + (g[-1] - g[:-1]) ** 2 / (right + ridge) - g[-1] ** 2 / (h[-1] + ridge), -1)
    at = int(score.argmax())
    return float(score[at]), at


@dataclass
class Additive:
    """Cut points and a table per feature, and a table per pair over coarser cut points."""

    intercept: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for rows of features."""
        total = np.full(len(x), self.intercept)
        for k, (cut, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += table[np.searchsorted(cut, x[:, k])]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[np.searchsorted(self.coarse[a], x[:, a]), np.searchsorted(self.coarse[b], x[:, b])]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 60, pairs: int = 8, rate: float = 0.1, bins: int = 64, coarse_bins: int = 10, least: float = 5.0, ridge: float = 1.0) -> Additive:
    """Fits the model to rows ``x`` with labels ``y`` (0 or 1). Without rows of both labels every score is the share of ones (0.5 without rows)."""
    n, width = x.shape
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if n else 0.5
    start = float(np.log(share / (1 - share)))
    edges = lambda k, m: np.unique(np.quantile(x[:, k], np.linspace(0, 1, m + 1)[1:-1])) if n else np.empty(0)
    cuts, coarse = [edges(k, bins) for k in range(width)], [edges(k, coarse_bins) for k in range(width)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    model = Additive(start, cuts, tables, coarse, [], [])
    if n < 20 or y.min() == y.max():
        return model
    at = [np.searchsorted(c, x[:, k]) for k, c in enumerate(cuts)]
    total = np.full(n, start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for k in range(width):
            g, h = slopes()
            gain, weight = np.bincount(at[k], g, len(tables[k])), np.bincount(at[k], h, len(tables[k]))
            step, ends = np.zeros(len(tables[k])), [0, len(tables[k])]
            for _ in range(2):  # a tree of up to three leaves
                found = [(*_best_cut(gain[a:b], weight[a:b], least * 0.05, ridge), a) for a, b in zip(ends, ends[1:], strict=False)]
                score, cut, a = max(found)
                if cut < 0 or score <= 1e-6:
                    break
                ends = sorted([*ends, a + cut + 1])
            if len(ends) == 2:
                continue
            for a, b in zip(ends, ends[1:], strict=False):
                step[a:b] = rate * gain[a:b].sum() / (weight[a:b].sum() + ridge)
            tables[k] += step
            total += step[at[k]]
    low = [np.searchsorted(c, x[:, k]) for k, c in enumerate(coarse)]

    def quadrants(a: int, b: int, g: np.ndarray, h: np.ndarray) -> tuple[float, int, int, np.ndarray, np.ndarray]:
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        flat = low[a] * shape[1] + low[b]
        gain, weight = (np.bincount(flat, v, shape[0] * shape[1]).reshape(shape) for v in (g, h))
        cg, ch = gain.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)
        if min(shape) < 2:
            return 0.0, -1, -1, gain, weight
        parts = [(c[:-1, :-1], c[:-1, -1:] - c[:-1, :-1], c[-1:, :-1] - c[:-1, :-1], c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + c[:-1, :-1]) for c in (cg, ch)]
        score = sum(pg**2 / (np.maximum(ph, 0) + ridge) for pg, ph in zip(*parts, strict=True))
        i, j = np.unravel_index(score.argmax(), score.shape)
        return float(score[i, j]), int(i), int(j), gain, weight

    g, h = slopes()
    ranked = sorted(((quadrants(a, b, g, h)[0], a, b) for a, b in combinations(range(width), 2)), reverse=True)
    model.pairs = [(a, b) for _, a, b in ranked[:pairs]]
    model.pair_tables = [np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for (a, b), table in zip(model.pairs, model.pair_tables, strict=True):
            _, i, j, gain, weight = quadrants(a, b, *slopes())
            if i < 0:
                continue
            step = np.zeros_like(table)
            for rows in (slice(0, i + 1), slice(i + 1, None)):
                for cols in (slice(0, j + 1), slice(j + 1, None)):
                    step[rows, cols] = rate * gain[rows, cols].sum() / (max(0.0, weight[rows, cols].sum()) + ridge)
            table += step
            total += step[low[a], low[b]]
    return model


def _held(c):
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, held_out: Callable = _held, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Additive:
    """The model fitted on a bounded sample of the labelled documents that are not held out."""
    marks = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)").filter(~held_out(F.col("doc_id"))).distinct()
    share = min(1.0, sample_docs / max(1, marks.count()))
    drawn = lambda n, of, *columns: F.pmod(F.xxhash64(F.lit(n), *columns), F.lit(1_000_000)) < int(of * 1_000_000)
    marks = F.broadcast(stored(marks.filter(drawn(1, share, F.col("doc_id"))), "marks"))  # two rows an id at most, and the sample's bound
    # rows that share an id are drawn from again, by their texts, so that no id can fill the sample
    joined = docs.select(F.col(id_col).cast("long").alias("doc_id")).join(marks, "doc_id").count()
    again = min(1.0, 2 * sample_docs / max(1, joined))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch({"y": batch.column("y"), "x": pa.array([features(t) for t in utf8(batch)], pa.list_(pa.float64()))})

    own = id_text(docs, id_col, text_col).join(marks, "doc_id").filter(drawn(2, again, F.col("doc_id"), F.col("text")))
    rows = own.mapInArrow(measured, "y int, x array<double>").toArrow()
    x = rows.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)) if rows.num_rows else np.empty((0, len(FEATURES)))
    y = rows.column("y").to_numpy().astype(np.float64)
    order = np.lexsort([*x.T, y])  # the fit doesn't depend on the order in which tasks ended
    return fit(x[order], y[order])


def score_quality(docs: DataFrame, labels: DataFrame, held_out: Callable = _held, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(doc_id, score, predicted, held_out) per row of ``docs``: score in 0 to 1, higher where label 1 is likelier.

    Only numbers drawn from the whole text are inputs. The model is fitted on about ``sample_docs`` labelled rows at most for which
    ``held_out`` (a function of the id column; by default crc32(doc_id as text) mod 3 = 1) is not true; labels other than 0 and
    1 and null ids are left out, and a document with both labels counts once for each. predicted is 1 if score >= 0.5. A null text counts as
    empty and is scored too. Without usable labels every score is the same. Repeated rows are returned as often as they come;
    an empty table gives an empty result; other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, held_out, sample_docs, id_col, text_col, label_col))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t) for t in utf8(batch)], np.float64).reshape(-1, len(FEATURES))
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": model.value.score(x)})

    found = id_text(docs, id_col, text_col).mapInArrow(scored, "doc_id long, score double")
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).withColumn("held_out", held_out(F.col("doc_id")))


def keep_good(docs: DataFrame, labels: DataFrame, held_out: Callable = _held, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """The rows of ``docs`` whose score is at least 0.5, in one pass over them."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, held_out, sample_docs, id_col, text_col, label_col))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t) for t in utf8(batch, text_col)], np.float64).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(model.value.score(x) >= 0.5))

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(kept, docs.schema)
