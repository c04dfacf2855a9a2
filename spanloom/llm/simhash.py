"""SimHash near-duplicate groups; candidate pairs are pruned by pigeonring chains before the full Hamming check.

A fingerprint's 64 bits are cut into m = 2 * radius segments on a ring. If two fingerprints differ in at most ``radius``
bits, some segment starts a chain in which the first l segments hold at most floor(l / 2) differing bits, for every l
(the proportional budget l * radius / m). So among the first 2j + 1 segments at least j + 1 are equal; every way to place
them gives a key, and fingerprints that share none of a level's keys can't be linked. Buckets of a key that are too full are
keyed again with one more equal segment of the same chain, which loses no link.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, join_hot, join_spread, runs, small_side, stored, utf8
from .graph import connected_components
from .nearcopies import LEAST, Scheme, components, prints

SEED = 42
#: A bucket with more fingerprints than this is keyed again with a longer chain.
FULL = 256
#: Pairs looked at together, so that a task's memory doesn't follow a group's pairs.
HELD = 100_000
#: Bits in which the fingerprints of near-duplicate candidates may differ.
NEAR = 6
#: Stars drawn in a bucket before its remaining pairs are compared.
STARS = 4


def shingle_hashes(words: list[bytes], width: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each run of ``width`` words joined by spaces, repeats included; of all words if they are fewer."""
    if not words:
        return np.empty(0, np.uint64)
    hashed = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([hashed(b" ".join(words), seed)], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return np.array([hashed(joined[a:b], seed) for a, b in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that over half of the hashes set, as an unsigned integer; 0 without hashes."""
    n = hashes.size
    if not n:
        return 0
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    if n > 255:
        padded = np.zeros((-(-n // 255) * 255, 64), np.uint8)
        padded[:n] = bits
        bits = padded.reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8)
    counts = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _remixed(hashes: np.ndarray, table: int) -> np.ndarray:
    """The hashes of another fingerprint of the same shingles; table 0 has them as they are."""
    if not table:
        return hashes
    x = (hashes ^ np.uint64(0x9E3779B97F4A7C15 * table % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, tables: int = 1) -> DataFrame:
    """(doc_id, fps array<long>): ``tables`` SimHashes of each whole text, bits as signed longs. A null or wordless text has 0."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in utf8(batch):
                hashes = shingle_hashes(text.lower().split(), width)
                found += [majority(_remixed(hashes, t)) for t in range(tables)]
            flat = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "fps": pa.FixedSizeListArray.from_arrays(flat, tables).cast(pa.list_(pa.int64()))})

    return id_text(docs, id_col, text_col).mapInArrow(made, "doc_id long, fps array<long>")


class Ring:
    """The segments, budgets and keys for one radius."""

    def __init__(self, radius: int):
        if not 3 <= radius <= 16:
            raise ValueError("radius must be between 3 and 16")
        self.radius, self.m = radius, 2 * radius
        edges = [round(64 * k / self.m) for k in range(self.m + 1)]
        self.shift = np.array(edges[:-1], np.uint64)
        self.width = [b - a for a, b in zip(edges, edges[1:], strict=False)]
        self.mask = np.array([(1 << w) - 1 for w in self.width], np.uint64)
        self.budget = np.array([(k + 1) // 2 for k in range(self.m)], np.int64)
        self.budget[-1] = radius

    def patterns(self, equal: int) -> list[tuple[int, ...]]:
        """Offsets from the start of ``equal`` equal segments that the budgets allow."""
        return [s for s in combinations(range(2 * equal - 1), equal) if all(sum(x <= 2 * j for x in s) > j for j in range(equal))]

    def keys(self, fps: np.ndarray, table: np.ndarray, start: int, equal: int) -> Iterator[np.ndarray]:
        """A key per pattern: an id of table, start and pattern, then the equal segments' bits (44 at most)."""
        parts = (fps[:, None] >> self.shift) & self.mask
        for number, pattern in enumerate(self.patterns(equal)):
            key = table.astype(np.uint64) << np.uint64(11) | np.uint64(start << 6 | number)
            tail = np.zeros(fps.size, np.uint64)
            for offset in pattern:
                at = (start + offset) % self.m
                tail = (tail << np.uint64(self.width[at])) | parts[:, at]
            yield (key << np.uint64(44) | tail).view(np.int64)

    def near(self, a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Which pairs keep the chain's budgets from their start on, and then differ in at most ``radius`` bits."""
        x = a ^ b
        held = np.zeros(x.size, np.int64)
        alive = np.arange(x.size)
        for step in range(self.m - 1):
            at = (start[alive] + step) % self.m
            held[alive] += np.bitwise_count((x[alive] >> self.shift[at]) & self.mask[at])
            alive = alive[held[alive] <= self.budget[step]]
            if not alive.size:
                break
        good = np.zeros(x.size, bool)
        good[alive] = np.bitwise_count(x[alive]) <= self.radius
        return good


    def first(self, u: np.ndarray, v: np.ndarray, start: np.ndarray, number: np.ndarray, equal: int) -> np.ndarray:
        """Which pairs are at the first start whose chain they keep and there at the first pattern they share: each is told once.

        What a pair's other buckets leave out is told, or joined by stars, at an earlier one; chains keep this true where full
        buckets are keyed again, as a kept chain shares a pattern of any length.
        """
        if u.size > HELD:
            return np.concatenate([self.first(*(c[a : a + HELD] for c in (u, v, start, number)), equal) for a in range(0, u.size, HELD)])
        x = u ^ v
        diff = np.stack([np.bitwise_count((x >> s) & m) for s, m in zip(self.shift, self.mask, strict=True)], axis=1).astype(np.int64)
        ring = np.concatenate([diff, diff], axis=1)
        kept = np.ones(x.size, bool)
        for s in range(self.m - 1):
            kept &= (start <= s) | (np.cumsum(ring[:, s : s + self.m], axis=1) > self.budget).any(axis=1)
        for k, pattern in enumerate(self.patterns(equal)):
            shared = (ring[np.arange(x.size)[:, None], start[:, None] + np.array(pattern)] == 0).all(axis=1)
            kept &= ~shared | (number <= k)
        return kept


def _middle(fps: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """For each group of rows, which begin at ``begin``, the place of the member closest to the group's majority bits.

    Near copies lie around their original, so a star from there reaches most of a group of copies.
    """
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sizes = np.diff(np.r_[begin, fps.size])
    most = np.packbits(2 * np.add.reduceat(bits, begin, axis=0, dtype=np.int64) > sizes[:, None], axis=1, bitorder="little").view("<u8").reshape(-1)
    group = np.repeat(np.arange(begin.size), sizes)
    order = np.lexsort((np.bitwise_count(fps ^ most[group]), group))
    return order[begin]


def _star_links(fps: np.ndarray, start: int, ring: Ring) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected inside one bucket; each member is compared until it is reached."""
    middle = int(_middle(fps, np.array([0]))[0])
    left, right, rest = [], [], np.r_[fps[middle], fps[:middle], fps[middle + 1 :]]
    while rest.size > 1:
        reached, rest = [rest[0]], rest[1:]
        while reached and rest.size:
            centre = np.full(rest.size, reached.pop(), np.uint64)
            hit = ring.near(centre, rest, np.full(rest.size, start))
            left.append(centre[hit])
            right.append(rest[hit])
            reached.extend(rest[hit])
            rest = rest[~hit]
    return (np.concatenate(left), np.concatenate(right)) if left else (fps[:0], fps[:0])


def _bucket_links(key: np.ndarray, fps: np.ndarray, start: np.ndarray, ring: Ring) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (u, v, the place of u) inside many small buckets at once: a few stars first, then a link per pair of stars (or single
    members) that have one."""
    left, right = [], []  # places
    star = np.full(key.size, -1, np.int64)
    for turn in range(STARS):
        free = np.flatnonzero(star < 0)
        if free.size < 2:
            break
        _, first, back = np.unique(key[free], return_index=True, return_inverse=True)
        centre = (free[first] if turn else _middle(fps, first))[back]
        hit = ring.near(fps[centre], fps[free], start[free])
        star[free[hit]] = centre[hit]
        other = hit & (centre != free)
        left.append(centre[other])
        right.append(free[other])
    group = np.where(star < 0, np.arange(key.size), star)
    one, other_one, held, most = [], [], 0, HELD

    def told_once() -> tuple[np.ndarray, np.ndarray]:
        x, y = np.concatenate(one), np.concatenate(other_one)
        pair = np.minimum(group[x], group[y]) * key.size + np.maximum(group[x], group[y])
        _, kept = np.unique(pair, return_index=True)
        return x[kept], y[kept]

    for step in range(1, key.size):
        same = np.flatnonzero(key[step:] == key[:-step])
        if not same.size:
            break
        same = same[group[same] != group[same + step]]
        hit = same[ring.near(fps[same], fps[same + step], start[same])]
        one.append(hit)
        other_one.append(hit + step)
        held += hit.size
        if held > most:
            x, y = told_once()
            one, other_one, held = [x], [y], x.size
            most = max(HELD, 2 * held)
    if one:
        x, y = told_once()
        left.append(x)
        right.append(y)
    at, to = np.concatenate(left), np.concatenate(right)
    return fps[at], fps[to], at


def links(reps: DataFrame, radius: int = 4) -> DataFrame:
    """Links (table, u, v) among distinct fingerprints ``reps`` (table, fp) whose components are those of all pairs of a table
    within ``radius`` bits."""
    ring = Ring(radius)
    first, last = 2, 4

    def keyed(equal: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            table = batch.column("table").to_numpy(zero_copy_only=False)
            at = batch.column("start").to_numpy(zero_copy_only=False) if equal > first else None
            for start in range(ring.m):
                own = np.arange(fps.size) if at is None else np.flatnonzero(at == start)
                for key in ring.keys(fps[own], table[own], start, equal) if own.size else ():
                    yield pa.record_batch({"key": key, "fp": fps[own].view(np.int64)})

    def linked(equal: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(head: np.ndarray, u: np.ndarray, v: np.ndarray, again: bool = False) -> pa.RecordBatch:
            if not again:
                told = ring.first(u, v, head >> 6 & 31, head & 63, equal)
                head, u, v = head[told], u[told], v[told]
            return pa.record_batch({"table": (head >> 11).astype(np.int32), "u": u.view(np.int64), "v": v.view(np.int64), "start": np.where(again, head >> 6 & 31, -1).astype(np.int32)})

        for rows in runs(batches, "key"):
            key, fps = rows.column("key").to_numpy(), rows.column("fp").to_numpy().view(np.uint64)
            begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[begin, key.size])
            if not (sizes > 1).any():
                continue
            head = (key[begin].view(np.uint64) >> np.uint64(44)).astype(np.int64)
            for a, n, h in zip(begin[sizes > FULL].tolist(), sizes[sizes > FULL].tolist(), head[sizes > FULL].tolist(), strict=True):
                own = fps[a : a + n]
                if equal < last:
                    yield row(np.full(n, h), own, own, True)
                else:
                    u, v = _star_links(own, h >> 6 & 31, ring)
                    yield row(np.full(u.size, h), u, v)
            small = np.repeat((sizes > 1) & (sizes <= FULL), sizes)
            if small.any():
                heads = np.repeat(head, sizes)[small]
                u, v, at = _bucket_links(key[small], fps[small], heads >> 6 & 31, ring)
                yield row(heads[at], u, v)

    found, todo = None, reps.select("table", "fp")
    for equal in range(first, last + 1):
        keys = todo.mapInArrow(lambda batches, e=equal: keyed(e, batches), "key long, fp long")
        step = keys.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(lambda batches, e=equal: linked(e, batches), "table int, u long, v long, start int")
        step = stored(step, "links")
        own = step.filter("start < 0").select("table", "u", "v")
        found = own if found is None else found.unionByName(own)
        full = step.filter("start >= 0").select("table", F.col("u").alias("fp"), "start")
        if equal == last or full.isEmpty():
            break
        todo = full.distinct()
    return found


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, radius: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``.

    Fingerprints link at ``radius`` or fewer differing bits; component_id is the smallest doc_id reachable over links, the
    row's own included. Null and wordless texts have fingerprint zero and link like any other. Repeated rows and equal ids are
    returned as often as they come; a null id is never a component_id, so a component of null ids only has null. An empty table
    gives an empty result. Other columns are ignored.
    """
    fps = stored(fingerprints(docs, id_col, text_col, width).select("doc_id", F.col("fps")[0].alias("fp")), "simhash")
    total = fps.count()
    reps = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n")), "reps")
    roots = connected_components(links(reps.select(F.lit(0).alias("table"), "fp"), radius).select("u", "v"))
    rooted = stored(reps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count("*").alias("n_fps"))
    by_fp = join_hot(rooted, least, "root", total, "n_fps").select("fp", "component_id", "n")
    return join_hot(fps, by_fp, "fp", total).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def near_pairs(sets: DataFrame, radius: int = NEAR) -> DataFrame:
    """Pairs (u, v) of ``sets`` (fp, bits) that join all whose SimHashes ``bits`` differ in at most ``radius`` bits, found by pigeonring chains.

    Sets that share a SimHash are paired with the least of them, which stands for all where SimHashes differ.
    """
    first = stored(sets.groupBy("bits").agg(F.min("fp").alias("first"), F.count("*").alias("n")), "bits")
    apart = links(first.select(F.lit(0).alias("table"), F.col("bits").alias("fp")), radius).select("u", "v").distinct()
    for x in ("u", "v"):
        apart = join_spread(apart, first.select(F.col("bits").alias(x), F.col("first").alias(f"of_{x}")), x)
    alike = join_hot(sets, first, "bits", sets.count()).filter("fp <> first").select(F.col("first").alias("of_u"), F.col("fp").alias("of_v"))
    return apart.select("of_u", "of_v").unionByName(alike).select(F.least("of_u", "of_v").alias("u"), F.greatest("of_u", "of_v").alias("v"))


def near_duplicate_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """(doc_id): the documents that a smaller doc_id is linked to, directly or over others.

    Two documents link if the Jaccard likeness of their five-word shingles is at least ``least``. Candidates are first the pairs whose
    SimHashes of these shingles differ in at most NEAR bits, by pigeonring chains; each is verified on all its shingles. At a
    likeness of 0.8 SimHashes mostly differ in more bits, so documents not joined yet meet by MinHash bands, too, and are verified alike: with
    the default a pair at 0.8 isn't found with a chance of 0.0003, one at 0.85 with 0.00001.
    Null ids take no part; empty and wordless texts are copies of one another.
    """
    scheme = Scheme(least=least)
    rows = stored(prints(docs, scheme, id_col, text_col, majority).filter("doc_id is not null"), "prints")
    return components(docs, rows, scheme, id_col, text_col, near_pairs).filter("doc_id <> component_id").select("doc_id").distinct()


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, that with the smallest id.

    Rows with equal ids are one document: it goes if any of them is a near copy of a smaller id's; of one that stays, the row stays
    whose columns come first as JSON, so a rerun keeps the same. Rows with a null id all stay.
    """
    gone = stored(near_duplicate_ids(docs, id_col, text_col, least), "gone")
    kept = docs.join(small_side(gone.withColumnRenamed("doc_id", id_col), gone.count()), id_col, "left_anti").select(docs.columns)
    again = stored(docs.groupBy(id_col).count().filter(f"`{id_col}` is not null and count > 1").select(id_col), "again")
    n = again.count()
    if not n:
        return kept
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    once = kept.join(small_side(again, n), id_col, "left_semi").groupBy(id_col).agg(F.min_by(whole, F.to_json(whole)).alias("__row")).select("__row.*")
    return kept.join(small_side(again, n), id_col, "left_anti").select(docs.columns).unionByName(once.select(docs.columns))
