"""Pairs of near copies among sets of word shingles: candidates by keys of MinHash signatures, each verified on the shingles of both whole texts.

A text is the set of its shingles, and its signature PLACES MinHashes of that set, the low-order BITS of each. A ``Scheme`` says which keys a
signature has; texts that share one meet in that key's bucket, where only hashes travel. A pair is a candidate if its signatures differ
in at most ``radius`` places, and a link is only what an exact count of common shingles confirms.

Buckets of up to FULL sets tell all their pairs. The members of a fuller one are first compared with a few centres, by signatures. Once
those pairs are verified, what is left are members not joined with the most of their bucket. These meet by prefixes, which misses no pair,
as sets of which one is at least ``least`` of their union share one of their rarest shingles, each set giving 1 - ``least`` of its own and
one more. Sets whose rarest shingles are common too, copies of one text with edits here and there, are counted in blocks, whole, as what
they differ in from their crowd's centre. So a bucket's work follows its members and what they share that is rare, not its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, join_hot, join_spread, small_side, stored, utf8
from .graph import connected_components
from .minhash import WordHashes, _mixed, shingles

#: Likeness from which two texts are near copies.
LEAST = 0.8
#: MinHashes of a signature, and the low-order bits kept of each.
PLACES, BITS = 64, 16
#: Places in which the signatures of a pair may differ. At a likeness of 0.8 more than these differ with a chance of 0.000014.
RADIUS = 27
#: A bucket with more members than this is compared from centres first.
FULL = 32
CENTRES = 4
#: Members of a full bucket held together.
PIECE = 2048
#: Hashes and pairs worked on together.
HELD = 8192
#: Slots in which shingles are counted to tell rare ones from common ones; shingles that share a slot only count as less rare.
SLOTS = 1 << 18
_XOR, _TIMES = _mixed(np.arange(1, PLACES + 1, dtype=np.uint64))[:, None], _mixed(np.arange(1001, PLACES + 1001, dtype=np.uint64))[:, None] | np.uint64(1)


#: The places of each key of the plainest scheme: bands of four.
BANDS = tuple(tuple(range(a, a + 4)) for a in range(0, PLACES, 4))
#: A key's lowest bits are its number; there may be as many keys as they tell apart.
NUMBERED = 10


class Scheme(NamedTuple):
    """Words of a shingle, the places that each of a signature's keys holds, the likeness of a link, and the radius of candidates."""

    width: int = 5
    places: tuple[tuple[int, ...], ...] = BANDS
    least: float = LEAST
    radius: int = RADIUS

    def keys(self, signatures: np.ndarray) -> Iterator[np.ndarray]:
        """For each key a hash of its places' values, its number in the lowest bits."""
        for number, places in enumerate(self.places):
            key = np.full(signatures.shape[0], number + 1, np.uint64)
            for column in signatures[:, list(places)].T:
                key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
            yield (key << np.uint64(NUMBERED) | np.uint64(number)).view(np.int64)

    def first_shared(self, same: np.ndarray) -> np.ndarray:
        """The number of the first key that a pair shares, from an array (pairs, places) of equal ones; past the last if there is none."""
        held = np.zeros((PLACES, len(self.places)), np.float32)
        for number, places in enumerate(self.places):
            held[list(places), number] = 1
        shared = same.astype(np.float32) @ held == held.sum(axis=0)
        return np.where(shared.any(axis=1), shared.argmax(axis=1), len(self.places))


def _least_hashes(hashes: np.ndarray) -> np.ndarray:
    least = np.full(PLACES, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, hashes.size, HELD):
        np.minimum(least, ((hashes[a : a + HELD] ^ _XOR) * _TIMES).min(axis=1), out=least)
    return least


def _set_of(text: bytes, words: WordHashes, width: int) -> np.ndarray:
    return np.unique(shingles(words.of(text.lower().split()), width))


def _print(hashes: np.ndarray) -> int:
    """A hash of a set of shingles; equal sets have equal ones."""
    return xxhash.xxh64_intdigest(hashes.tobytes(), 7)


def prints(docs: DataFrame, scheme: Scheme, id_col: str = "doc_id", text_col: str = "text", mark: Callable[[np.ndarray], int] | None = None) -> DataFrame:
    """(doc_id, h long, fp long, n long, sketch binary): a hash of the text, its set as one hash, the set's size and signature (empty without words).

    With ``mark`` there is a column bits long too, the 64 bits that it gives for the set.
    """
    width = scheme.width

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            fps, sizes, sketches, bits = [], [], [], []
            for text in utf8(batch):
                hashes = _set_of(text, words, width)
                fps.append(_print(hashes))
                sizes.append(hashes.size)
                sketches.append(_mixed(_least_hashes(hashes)).astype(np.uint16).tobytes() if hashes.size else b"")
                if mark:
                    bits.append(mark(hashes))
            marked = {"bits": np.array(bits, np.uint64).view(np.int64)} if mark else {}
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "h": batch.column("h"), "fp": np.array(fps, np.uint64).view(np.int64), "n": np.array(sizes, np.int64), "sketch": pa.array(sketches, pa.binary())} | marked)

    schema = "doc_id long, h long, fp long, n long, sketch binary" + (", bits long" if mark else "")
    return id_text(docs, id_col, text_col).withColumn("h", F.xxhash64("text")).mapInArrow(made, schema)


def _sketches(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, PLACES)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, bool]]:
    """Tables of rows (sorted by key), none much longer than PIECE and a batch, and whether the last key goes on in the next table.

    Only a key with more than PIECE rows is cut.
    """
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        held = now if held is None else pa.concat_tables([held, now])
        keys = held.column("key").to_numpy()
        first = int(np.searchsorted(keys, keys[-1]))
        if first:
            yield held.slice(0, first), False
            held = held.slice(first)
        elif held.num_rows > PIECE:
            yield held, True
            held = None
    if held is not None:
        yield held, False


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs (u, v) of buckets of up to FULL members; the members of fuller ones as (u, null, key)."""
    going = None  # the key that was cut
    for rows, goes_on in _pieces(batches):
        key, fps = rows.column("key").to_numpy(), rows.column("fp").to_numpy()
        begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[begin, key.size])
        full = sizes > FULL
        if going is not None and key[0] == going:
            full[0] = True
        if goes_on:
            full[-1] = True
        going = key[-1] if goes_on else None
        tight = (sizes > 1) & ~full
        left = np.repeat(begin[tight], sizes[tight])
        left = left + np.arange(left.size) - np.repeat(np.cumsum(sizes[tight]) - sizes[tight], sizes[tight])
        for step in range(1, FULL):
            left = left[left + step < key.size]
            left = left[key[left] == key[left + step]]
            for a in range(0, left.size, HELD):
                u, v = fps[left[a : a + HELD]], fps[left[a : a + HELD] + step]
                yield pa.record_batch({"u": np.minimum(u, v), "v": np.maximum(u, v), "key": np.zeros(u.size, np.int64)})
        at = np.repeat(full, sizes)
        if at.any():
            yield pa.record_batch({"u": fps[at], "v": pa.nulls(int(at.sum()), pa.int64()), "key": key[at]})


def _centred(batches: Iterator[pa.RecordBatch], scheme: Scheme) -> Iterator[pa.RecordBatch]:
    """Candidates (u, v) of a few centres of each bucket (rows sorted by key), which stay the same in all pieces of a bucket.

    A pair is told in the first bucket that it shares: a centre of near copies is one in most of their buckets, and what is lost where it
    isn't is left over, and compared later. Where rows have a root, pairs of one root aren't told.
    """
    close = (1 - scheme.least) * PLACES / 2
    going, centres = None, []
    for rows, goes_on in _pieces(batches):
        key, fps, sketch = rows.column("key").to_numpy(), rows.column("fp").to_numpy(), _sketches(rows.column("sketch"))
        root = rows.column("root").to_numpy() if "root" in rows.column_names else fps
        begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        for a, b in zip(begin.tolist(), [*begin[1:].tolist(), key.size], strict=True):
            own, members, roots = sketch[a:b], fps[a:b], root[a:b]
            free = np.ones(b - a, bool)
            known = centres if key[a] == going else []
            fresh = []
            for number in range(len(known) + CENTRES):
                at = np.flatnonzero(free)
                if number < len(known):
                    name, centre, of_centre = known[number]
                elif at.size and len(known) + len(fresh) < CENTRES:
                    some = own[at[:: max(1, at.size // 64)]]
                    where = at[np.argmin(sum((own[at] != s).sum(axis=1) for s in some))]
                    name, centre, of_centre = int(members[where]), own[where].copy(), int(roots[where])
                    fresh.append((name, centre, of_centre))
                else:
                    break
                same = own == centre
                apart = PLACES - same.sum(axis=1)
                free &= (apart > close) & (members != name)
                hit = np.flatnonzero((apart <= scheme.radius) & (members != name) & (roots != of_centre))
                hit = members[hit[scheme.first_shared(same[hit]) == (key[a] & ((1 << NUMBERED) - 1))]]
                yield pa.record_batch({"u": np.minimum(hit, name), "v": np.maximum(hit, name)})
            last = b == key.size and goes_on
            going, centres = (key[a], [*known, *fresh]) if last else (None, [])


def _buckets(keyed: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """The pairs (u, v) of the buckets of ``keyed`` (key, fp), and the members (fp, key) of full ones, for which it tells none."""
    met = stored(keyed.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_met, "u long, v long, key long"), label)
    return met.filter("v is not null").select("u", "v").distinct(), met.filter("v is null").select(F.col("u").alias("fp"), "key")


def _near(pairs: DataFrame, facts: DataFrame, radius: int) -> DataFrame:
    """The pairs (u, v) whose signatures differ in at most ``radius`` places; ``facts`` has (fp, sketch), and root where pairs of one root are to go."""
    more = ["root"] if "root" in facts.columns else []
    for x in ("u", "v"):
        pairs = join_spread(pairs, facts.select(F.col("fp").alias(x), F.col("sketch").alias(f"of_{x}"), *(F.col(c).alias(f"{c}_{x}") for c in more)), x)
    if more:
        pairs = pairs.filter("root_u <> root_v")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                good = pa.array((_sketches(batch.column("of_u")) != _sketches(batch.column("of_v"))).sum(axis=1) <= radius)
                yield pa.record_batch({c: batch.column(c).filter(good) for c in ("u", "v")})

    return pairs.select("u", "v", "of_u", "of_v").mapInArrow(kept, "u long, v long")


def _sets(docs: DataFrame, reps: DataFrame, wanted: DataFrame, scheme: Scheme, id_col: str, text_col: str) -> DataFrame:
    """(fp, shingles) of the sets ``wanted`` (fp), each from the text of its first row, which its id and its text's hash tell; one text of
    rows that are equal in both."""
    first = stored(wanted.join(reps.select("fp", "least_id", "h"), "fp").select("least_id", "h").distinct(), "wanted")
    width = scheme.width

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            found = [_set_of(text, words, width) for text in utf8(batch)]
            yield pa.record_batch({"fp": np.array([_print(x) for x in found], np.uint64).view(np.int64), "shingles": pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))})

    texts = id_text(docs, id_col, text_col).withColumn("text_h", F.xxhash64("text"))
    near = small_side(first, first.count())
    texts = texts.join(near, (texts["text_h"] == near["h"]) & texts["doc_id"].eqNullSafe(near["least_id"]), "left_semi")
    return stored(texts.groupBy("text_h").agg(F.first("text").alias("text")).select("text").mapInArrow(made, "fp long, shingles array<long>"), "shingles")


def _verified(docs: DataFrame, reps: DataFrame, pairs: DataFrame, scheme: Scheme, id_col: str, text_col: str) -> DataFrame:
    """The pairs (u, v) whose sets have a Jaccard likeness of at least ``least``, counted on the whole sets."""
    pairs = stored(pairs.distinct(), "pairs")
    sets = _sets(docs, reps, pairs.select(F.explode(F.array("u", "v")).alias("fp")).distinct(), scheme, id_col, text_col)
    both = pairs
    for x in ("u", "v"):
        both = join_spread(both, sets.select(F.col("fp").alias(x), F.col("shingles").alias(f"of_{x}")), x)
    counted = both.select("u", "v", F.size(F.array_intersect("of_u", "of_v")).alias("n"), (F.size("of_u") + F.size("of_v")).alias("sizes"))
    return stored(counted.filter(F.col("n") + 1e-9 >= (F.col("sizes") - F.col("n")) * scheme.least).select("u", "v"), "links")


def _rare_first(sets: DataFrame, least: float) -> DataFrame:
    """(key, fp): of each set its rarest shingles, as many as a set at ``least`` can't lack all of.

    What is rare is counted in SLOTS slots, which the driver holds whatever there is to count. Any order that all sets share gives right
    results; this one gives few pairs.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("shingles").flatten().to_numpy() & (SLOTS - 1), minlength=SLOTS)
        at = np.flatnonzero(total)
        yield pa.record_batch({"slot": at, "n": total[at]})

    counts = np.zeros(SLOTS, np.int64)
    for row in sets.select("shingles").mapInArrow(counted, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[row["slot"]] = row["n"]
    common = sets.sparkSession.sparkContext.broadcast(counts)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fp, own in zip(batch.column("fp").to_pylist(), batch.column("shingles"), strict=True):
                own = own.values.to_numpy(zero_copy_only=False)
                own = own[np.lexsort((own, common.value[own & (SLOTS - 1)]))]
                own = own[: own.size - int(np.ceil(least * own.size - 1e-9)) + 1]
                yield pa.record_batch({"key": own, "fp": np.full(own.size, fp)})

    return sets.mapInArrow(first, "key long, fp long")


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each set as what it lacks of its crowd's centre, a bit each, and what it has besides."""
    for batch in batches:
        lacks, besides = [], []
        for own, centre in zip(batch.column("shingles"), batch.column("centre"), strict=True):
            own, centre = own.values.to_numpy(zero_copy_only=False), centre.values.to_numpy(zero_copy_only=False)
            lacks.append(np.packbits(~np.isin(centre, own, assume_unique=True)).tobytes())
            besides.append(own[~np.isin(own, centre, assume_unique=True)])
        yield pa.record_batch({
            **{c: batch.column(c) for c in ("crowd", "pieces", "fp", "root", "apart")}, "n": pa.array([len(x) for x in batch.column("shingles")], pa.int64()), "n_centre": pa.array([len(x) for x in batch.column("centre")], pa.int64()),
            "lacks": pa.array(lacks, pa.binary()), "besides": pa.array(besides, pa.list_(pa.int64())),
        })


def _crossed(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Links (u, v): in each (crowd, piece) the rows of side 1 against those of side 0, which come first and are few, counted on whole sets.

    What two sets share is the centre less what either lacks, and what both have besides. Of a row's links to sets of one root, one is told.
    """
    now, head = None, []
    index: tuple | None = None

    def built() -> tuple:
        fps, roots, sizes = (np.array([h[k] for h in head], np.int64) for k in range(3))
        masks = np.stack([np.frombuffer(h[3], np.uint8) for h in head]) if head[0][3] else np.zeros((len(head), 0), np.uint8)
        flat, owner = np.concatenate([h[4] for h in head]), np.repeat(np.arange(len(head)), [h[4].size for h in head])
        order = np.argsort(flat, kind="stable")
        return fps, roots, sizes, masks, flat[order], owner[order]

    for batch in batches:
        u, v = [], []
        cols = [batch.column(c).to_pylist() for c in ("crowd", "piece", "side", "fp", "root", "n", "n_centre", "lacks")]
        for crowd, piece, side, fp, root, n, n_centre, lacks, besides in zip(*cols, batch.column("besides"), strict=True):
            besides = besides.values.to_numpy(zero_copy_only=False)
            if (crowd, piece) != now:
                now, head, index = (crowd, piece), [], None
            if side == 0:
                head.append((fp, root, n, lacks, besides))
                continue
            if not head:
                continue
            index = index or built()
            fps, roots, sizes, masks, flat, owner = index
            low, high = np.searchsorted(flat, besides), np.searchsorted(flat, besides, side="right")
            spread = high - low
            at = np.repeat(low - np.r_[0, np.cumsum(spread)[:-1]], spread) + np.arange(spread.sum())
            both = n_centre - np.bitwise_count(masks | np.frombuffer(lacks, np.uint8)).sum(axis=1, dtype=np.int64) + np.bincount(owner[at], minlength=fps.size)
            hit = np.flatnonzero((both + 1e-9 >= (sizes + n - both) * least) & (roots != root))
            hit = fps[hit[np.unique(roots[hit], return_index=True)[1]]]
            u.append(np.minimum(hit, fp))
            v.append(np.maximum(hit, fp))
        if u:
            yield pa.record_batch({"u": np.concatenate(u), "v": np.concatenate(v)})


def _crowd_links(rooted: DataFrame, links: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links (u, v) inside crowds, all buckets of which most members have one root: ``rooted`` has (most, fp, root). A crowd's sets are told by
    what they differ in from its centre, the set of that root with most links, so that copies of whole sets needn't meet."""
    degree = links.select(F.explode(F.array("u", "v")).alias("fp")).groupBy("fp").agg(F.count("*").alias("links"))
    known = rooted.groupBy("fp").agg(F.first("root").alias("root")).join(degree, "fp", "left")
    middle = known.groupBy("root").agg(F.max_by("fp", F.struct(F.coalesce("links", F.lit(0)), "fp")).alias("centre"))
    crowds = rooted.groupBy(F.col("most").alias("crowd")).agg(F.ceil(F.count_distinct("fp") / PIECE).cast("int").alias("pieces"), F.min_by("fp", F.struct(F.col("root") != F.col("most"), "fp")).alias("some"))
    crowds = crowds.join(middle, F.col("crowd") == F.col("root"), "left").select("crowd", "pieces", F.coalesce("centre", "some").alias("fp"))
    centres = stored(crowds.join(sets, "fp").select("crowd", "pieces", F.col("shingles").alias("centre")), "centres")
    rows = rooted.select(F.col("most").alias("crowd"), "fp", "root", (F.col("root") != F.col("most")).alias("apart")).distinct().join(sets, "fp")
    coded = join_spread(rows, centres, "crowd").select("crowd", "pieces", "fp", "root", "apart", "shingles", "centre").mapInArrow(_coded, "crowd long, pieces int, fp long, root long, apart boolean, n long, n_centre long, lacks binary, besides array<long>")
    coded = stored(coded, "coded")
    one = coded.withColumns({"piece": F.pmod(F.xxhash64("fp"), "pieces").cast("int"), "side": F.lit(0)})
    other = coded.filter("apart").withColumns({"piece": F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)), "side": F.lit(1)})
    dealt = one.unionByName(other).repartition("crowd", "piece").sortWithinPartitions("crowd", "piece", "side")
    found = dealt.select("crowd", "piece", "side", "fp", "root", "n", "n_centre", "lacks", "besides").mapInArrow(lambda b: _crossed(b, least), "u long, v long")
    return stored(found.distinct(), "links")


def _left_over(docs: DataFrame, reps: DataFrame, full: DataFrame, links: DataFrame, scheme: Scheme, id_col: str, text_col: str) -> DataFrame:
    """Links (u, v) between members of full buckets, ``full`` (fp, key), of which one isn't joined with the most of its bucket yet."""
    roots = connected_components(links).withColumnRenamed("node", "fp")
    rooted = stored(full.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    counts = rooted.groupBy("key", "root").agg(F.count("*").alias("of_root"))
    buckets = stored(counts.groupBy("key").agg(F.sum("of_root").alias("n"), F.max_by("root", F.struct("of_root", "root")).alias("most"), F.max("of_root").alias("of_most")).filter("n > of_most").drop("of_most"), "buckets")
    if buckets.isEmpty():
        return links.limit(0)
    crowds = stored(join_hot(rooted, buckets, "key", rooted.count()).select("most", "fp", "root").distinct(), "crowds")
    members = stored(crowds.groupBy("fp").agg(F.first("root").alias("root")).join(reps.select("fp", "sketch"), "fp"), "members")
    sets = _sets(docs, reps, members.select("fp"), scheme, id_col, text_col)
    pairs, crowded = _buckets(_rare_first(sets, scheme.least), "prefixes")
    found = _verified(docs, reps, _near(pairs, members, scheme.radius), scheme, id_col, text_col)
    if crowded.isEmpty():
        return found
    # rare shingles that many have: those sets are compared by crowds
    dense = crowds.join(stored(crowded.select("fp").distinct(), "dense"), "fp")
    return found.unionByName(_crowd_links(dense, links, sets, scheme.least))


def near_copy_links(docs: DataFrame, reps: DataFrame, scheme: Scheme, id_col: str = "doc_id", text_col: str = "text", known: DataFrame | None = None) -> DataFrame:
    """Links (u, v) among the sets ``reps`` (fp, least_id, h, sketch) whose components are those of all pairs that share a key, differ in at most
    ``radius`` places and have a likeness of at least ``least``. The stored links ``known`` (u, v) are among them; pairs that these join,
    directly or over others, are not compared."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, signatures = batch.column("fp").to_numpy(), _sketches(batch.column("sketch"))
            for key in scheme.keys(signatures):
                yield pa.record_batch({"key": key, "fp": fps})

    worded = reps.filter(F.octet_length("sketch") > 0).select("fp", "sketch")
    facts = worded
    if known is not None:
        roots = stored(connected_components(known).withColumnRenamed("node", "fp"), "roots")
        facts = worded.join(small_side(roots, roots.count()), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    pairs, full = _buckets(worded.mapInArrow(keyed, "key long, fp long"), "near")
    near, any_full = _near(pairs, facts, scheme.radius), not full.isEmpty()
    if any_full:
        told = full.join(facts, "fp").repartition("key").sortWithinPartitions("key", "fp").mapInArrow(lambda b: _centred(b, scheme), "u long, v long")
        near = near.unionByName(told)
    links = _verified(docs, reps, near, scheme, id_col, text_col)
    if known is not None:
        links = known.unionByName(links)
    return links.unionByName(_left_over(docs, reps, full, links, scheme, id_col, text_col)) if any_full else links


def components(docs: DataFrame, rows: DataFrame, scheme: Scheme, id_col: str = "doc_id", text_col: str = "text", pairs_of: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Stored ``rows`` of ``prints`` as (doc_id, fp, n, component_id): the least doc_id of the component of each row's set.

    ``pairs_of`` makes candidates (u, v) of another method from the sets with words (fp, bits). They are verified first, and the scheme
    goes on from their links.
    """
    marked = [F.first("bits").alias("bits")] if pairs_of else []
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("first")
    sets = rows.groupBy("fp").agg(first, F.first("sketch").alias("sketch"), F.count("*").alias("n_rows"), *marked)
    reps = stored(sets.select("fp", F.col("first.doc_id").alias("least_id"), F.col("first.h").alias("h"), "sketch", "n_rows", *(["bits"] if marked else [])), "reps")
    known = None
    if pairs_of:
        known = _verified(docs, reps, pairs_of(reps.filter(F.octet_length("sketch") > 0).select("fp", "bits")), scheme, id_col, text_col)
    # components of sets first: copies of one set need no edge of their own
    roots = connected_components(near_copy_links(docs, reps, scheme, id_col, text_col, known))
    rooted = stored(reps.select("fp", "least_id", "n_rows").join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    first = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count("*").alias("n_sets"))
    total = rows.count()
    by_set = join_hot(rooted, first, "root", total, "n_sets").select("fp", "component_id", "n_rows")
    return join_hot(rows.select("doc_id", "fp", "n"), by_set, "fp", total, "n_rows")
