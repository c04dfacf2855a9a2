"""One-permutation MinHash fingerprints: bins filled by optimal densification, low-order bits packed, likeness corrected for bias."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CHARS, id_text, utf8

#: Bins of a fingerprint, and the low-order bits kept of each bin's least hash.
BINS, BITS = 512, 4
WIDTH = 5
#: Documents in a range of ids, on average; a range is one unit of work.
RANGE_DOCS = 2000
#: Ranges at most; beyond that a range only gets longer (its task sorts on disk and streams).
MOST_RANGES = 20_000
#: Probes of the densification; a bin that no probe fills (next to impossible with many filled bins) takes the next filled one.
PROBES = 256

_MULTIPLY = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Where an empty bin looks for a filled one, attempt by attempt: a hash of bin and attempt, the same for all texts.
_PROBE = (_mixed(np.arange(PROBES * BINS, dtype=np.uint64) + np.uint64(0x51ED)) % np.uint64(BINS)).astype(np.int64).reshape(PROBES, BINS)

_STEPS = [(0, 4), (4, 12), (12, 64), (64, PROBES)]


class WordHashes:
    """XXH64 of words, kept for words seen before."""

    def __init__(self, most: int = 400_000):
        self.kept: dict[bytes, int] = {}
        self.most = most

    def of(self, words: list[bytes]) -> np.ndarray:
        kept = self.kept
        if len(kept) > self.most:
            kept.clear()
        for word in [w for w in set(words) if w not in kept]:
            kept[word] = xxhash.xxh64_intdigest(word)
        return np.fromiter(map(kept.__getitem__, words), np.uint64, len(words))


def shingles(word_hashes: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """A hash per run of ``width`` words (five at most); of all words if they are fewer."""
    n = word_hashes.size
    if not n:
        return word_hashes
    if n < width:
        return _mixed((word_hashes * _MULTIPLY[:n]).sum(keepdims=True))
    total = word_hashes[: n - width + 1] * _MULTIPLY[0]
    for k in range(1, width):
        total += word_hashes[k : n - width + 1 + k] * _MULTIPLY[k]
    return _mixed(total)


def sketch(hashes: np.ndarray) -> np.ndarray | None:
    """The low bits of the least hash in each bin, empty bins filled; None without hashes. A hash's top bits name its bin."""
    if not hashes.size:
        return None
    ordered = np.sort(hashes)
    bins = (ordered >> np.uint64(55)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
    least = np.zeros(BINS, np.uint64)
    least[bins[first]] = ordered[first]
    if first.size < BINS:
        filled = np.zeros(BINS, bool)
        filled[bins[first]] = True
        empty = np.flatnonzero(~filled)
        source = np.full(empty.size, -1, np.int64)
        open_ = np.arange(empty.size)
        for a, b in _STEPS:
            probe = _PROBE[a:b, empty[open_]]
            hit = filled[probe]
            source[open_] = np.where(hit.any(axis=0), probe[hit.argmax(axis=0), np.arange(open_.size)], -1)
            open_ = open_[source[open_] < 0]
            if not open_.size:
                break
        else:
            source[open_] = bins[first][np.searchsorted(bins[first], empty[open_]) % first.size]
        least[empty] = least[source]
    return (least & np.uint64((1 << BITS) - 1)).astype(np.uint8)


def packed(low: np.ndarray | None) -> str:
    """Two bins a byte, in base64; the empty string for a text without words."""
    return "" if low is None else base64.b64encode((low[0::2] << 4 | low[1::2]).tobytes()).decode()


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """The Jaccard likeness two sketches show: the share of equal bins less the share that chance gives. Two empty texts: 1."""
    if a is None or b is None:
        return float(a is b)
    chance = 2.0**-BITS
    return min(1.0, max(0.0, (float((a == b).mean()) - chance) / (1 - chance)))


def _ranges(docs: DataFrame) -> tuple[list[tuple[int, int]], bool]:
    """Bounds (id, text hash) that cut the rows into ranges of about RANGE_DOCS, and whether some id is cut within.

    An id with more rows than a range is cut by the hashes of its texts; there are fewer such ids than ranges.
    """
    ids = docs.select("doc_id")
    n = ids.count()
    parts = max(1, min(MOST_RANGES, round(n / RANGE_DOCS)))
    size = max(RANGE_DOCS, -(-n // parts))
    bounds = {(int(x), 0) for x in ids.select(F.col("doc_id").cast("double")).approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.2 / parts)} if parts > 1 else set()
    heavy = ids.groupBy("doc_id").count().filter(F.col("count") > size).collect() if parts > 1 else []
    for row in heavy:
        pieces = -(-row["count"] // size)
        bounds |= {(row["doc_id"], k * ((1 << 64) // pieces)) for k in range(pieces)} | {(row["doc_id"] + 1, 0)}
    return sorted(bounds), bool(heavy)


def fingerprint_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last floor(n_chars / 4) code points replaced by as many of the start of the next document's text
    (or all of it), in ascending order of doc_id; after the last comes the first. Equal ids are ordered by the XXH64 of their UTF-8,
    then by text; null ids come first. A null text counts as empty; an empty or blank text has an empty fingerprint, whose
    likeness is 1 to another such and 0 to any other. With one row only, the next document is the row itself. An empty table gives
    an empty result; other columns are ignored.

    The texts are shuffled once, by ranges of ids and, where an id has very many rows, of their hashes; the first row of a range
    also goes to the range before it. Only rows that are equal in both stay together.
    """
    spark = docs.sparkSession
    own = id_text(docs, id_col, text_col).withColumn("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))))
    bounds, cut_within = _ranges(own)
    cut = spark.sparkContext.broadcast((np.array([d for d, _ in bounds], np.int64), np.array([h for _, h in bounds], np.uint64)))

    def hashes_of(batch: pa.RecordBatch) -> np.ndarray:
        return np.fromiter((xxhash.xxh64_intdigest(t) for t in utf8(batch)), np.uint64, batch.num_rows)

    def parts_of(seen: np.ndarray, hashes: np.ndarray | None) -> np.ndarray:
        """The number of bounds at or below each (id, hash)."""
        ids, at_hash = cut.value
        low, high = np.searchsorted(ids, seen), np.searchsorted(ids, seen, side="right")
        if hashes is None:
            return high
        for k in np.flatnonzero(high - low > 1).tolist():
            high[k] = low[k] + np.searchsorted(at_hash[low[k] : high[k]], hashes[k], side="right")
        return high

    # the least id and hash of each range that has rows: a few numbers a range
    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            seen = batch.column("doc_id").to_numpy()
            hashes = hashes_of(batch) if cut_within else np.zeros(seen.size, np.uint64)
            at = parts_of(seen, hashes if cut_within else None)
            order = np.lexsort((hashes, seen, at))
            first = order[np.flatnonzero(np.r_[True, at[order][1:] != at[order][:-1]])]
            # as a signed number in the hashes' order
            yield pa.record_batch({"part": at[first].astype(np.int32), "least": seen[first], "h": (hashes[first] ^ np.uint64(1 << 63)).view(np.int64)})

    read = own if cut_within else own.select("doc_id")
    found = read.mapInArrow(edges, "part int, least long, h long").groupBy("part").agg(F.min(F.struct("least", "h")).alias("m")).collect()
    firsts = {r["part"]: (r["m"]["least"], (r["m"]["h"] + (1 << 63)) if cut_within else None) for r in found}
    order = sorted(firsts)
    # the first row of a range is also the last row's next document in the range before (the first range's: in the last range)
    before = {firsts[p]: order[k - 1] for k, p in enumerate(order)}
    leads = spark.sparkContext.broadcast((before, {d for d, _ in before}))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back, ids = leads.value
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            seen, hashes = batch.column("doc_id").to_numpy(), hashes_of(batch)
            part, signed = parts_of(seen, hashes if cut_within else None).astype(np.int32), (hashes ^ np.uint64(1 << 63)).view(np.int64)
            yield pa.record_batch({"part": part, "after": np.zeros(n, np.int32), "doc_id": seen, "h": signed, "text": batch.column("text")})
            names = {k: (x, int(hashes[k]) if cut_within else None) for k, x in enumerate(seen.tolist()) if x in ids}
            at = [k for k, name in names.items() if name in back]
            if at:
                some = batch.take(pa.array(at))
                yield pa.record_batch({"part": pa.array([back[names[k]] for k in at], pa.int32()), "after": np.ones(len(at), np.int32), "doc_id": some.column("doc_id"), "h": signed[at], "text": some.column("text")})

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        out: list[tuple] = []
        # (part, doc_id, after, text) of the row whose next document is still to come
        waiting: tuple | None = None
        told: set[int] = set()

        def parsed(text: str) -> tuple:
            raw = text.encode().lower()
            split = raw.split()
            hashes = words.of(split)
            return text, hashes, sketch(shingles(hashes))

        def closed(row: tuple, following: tuple) -> tuple:
            doc_id, (text, hashes, low) = row
            n = len(text)
            quarter = n // 4
            kept = text[: n - quarter]
            edited = kept + following[0][:quarter]
            # words that end before the cut are the same as in the text, and so are their hashes
            same = len(kept.encode().split()) - bool(quarter and kept[-1] not in SPACE_CHARS)
            rest = edited.encode().lower().split()[same:]
            after = sketch(shingles(np.concatenate([hashes[:same], words.of(rest)])))
            return doc_id, n, hashlib.sha256(edited.encode()).hexdigest(), packed(low), packed(after), likeness(low, after), likeness(low, following[2])

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

        for batch in batches:
            for part, after, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("part", "after", "doc_id", "text")), strict=True):
                if after and part in told:
                    continue
                now = parsed(text)
                if waiting is not None and waiting[0] == part:
                    out.append(closed(waiting[1:], now))
                    waiting = None
                if after:
                    told.add(part)
                else:
                    waiting = (part, doc_id, now)
                if len(out) >= 500:
                    yield batch_of(out)
                    out = []
        if out:
            yield batch_of(out)

    rows = own.mapInArrow(dealt, "part int, after int, doc_id long, h long, text string")
    found = rows.repartition("part").sortWithinPartitions("part", "after", "doc_id", "h", "text").mapInArrow(
        printed, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
    return found.withColumn("doc_id", F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")))
