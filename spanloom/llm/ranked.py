"""Ranked lexical search over a two-level quantised index.

The index holds documents in blocks, a row a block: its terms, and for each posting the document's place, its exact count (second level)
and a byte (first level), the posting's impact rounded up to a multiple of STEP. A query's sum of bytes is an upper bound of a document's
score, the same sum with each byte less one a lower bound. Each task keeps, per query, the k best rows so far; a block's documents whose upper
bound reaches the kth lower bound known are all scored again from the exact counts, in 64-bit integers. What a task hands on is its k best rows
a query, whatever it read. Nothing is sampled and no posting list is cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, id_text, stored, utf8

#: A block ends at so many documents or so many bytes of text.
BLOCK_DOCS, BLOCK_BYTES = 512, 2 << 20
#: Blocks in a row group of the stored index; tasks hold that many, however many a task makes.
GROUP_BLOCKS = 8
#: An impact is below SCALE; a byte counts steps of impact, rounded up.
SCALE = 1_000_000
STEP = -(-SCALE // 255)
#: Queries are looked for together as long as they have about so many terms; more queries take further passes over the index.
QUERY_TERMS = 200_000
TOP = 10

#: Letters and digits of ASCII and all bytes beyond make terms; A-Z are lower-cased, all else parts terms.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order, repeats included."""
    return text.translate(_TERMS).split()


class Index(NamedTuple):
    """Stored blocks (both levels), the number of documents with a term, and of all their terms."""

    blocks: DataFrame
    n_docs: int
    n_terms: int


def length_norm(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents with ``n`` terms."""
    return 100 - 75 + (75 * n.astype(np.int64) * n_docs) // n_terms


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a posting gives a query term of weight 1."""
    tf = tf.astype(np.int64)
    return (1_000 * SCALE * tf) // (1000 * tf + 8 * m)


_EXACT = "block long, doc_ids array<long>, lengths binary, terms binary, spread binary, places binary, counts binary"


def _postings(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The second level: a row a block, postings by term. A lost task makes the same blocks again from the same rows."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, 0
        ids: list[int | None] = []
        lengths: list[int] = []
        own: list[np.ndarray] = []
        times: list[np.ndarray] = []
        found: dict[bytes, int] = {}

        def block() -> pa.RecordBatch:
            term, tf = np.concatenate(own), np.concatenate(times)
            place = np.repeat(np.arange(len(own)), [x.size for x in own])
            order = np.argsort(term, kind="stable")
            cols = [np.array(lengths, np.int32), None, np.bincount(term, minlength=len(found)).astype(np.int32), place[order].astype(np.uint16), tf[order].astype(np.int32)]
            packed = [pa.array([b" ".join(found) if c is None else c.tobytes()], pa.binary()) for c in cols]
            return pa.record_batch([pa.array([(part << 32) + number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), *packed], names=[c.split()[0] for c in _EXACT.split(", ")])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), utf8(batch), strict=True):
                terms = terms_of(text)
                if not terms:
                    continue
                for term, k in zip([t for t in set(terms) if t not in found], count(len(found))):  # noqa: B905
                    found[term] = k
                mine, n = np.unique(np.fromiter(map(found.__getitem__, terms), np.int32, len(terms)), return_counts=True)
                ids.append(doc_id)
                lengths.append(len(terms))
                own.append(mine)
                times.append(n)
                held += len(text)
                if len(ids) == BLOCK_DOCS or held >= BLOCK_BYTES:
                    yield block()
                    number, held = number + 1, 0
                    for x in (ids, lengths, own, times, found):
                        x.clear()
        if ids:
            yield block()

    return stored(id_text(docs, id_col, text_col).mapInArrow(made, _EXACT), "postings", group=GROUP_BLOCKS)


def _array(batch: pa.RecordBatch, name: str, row: int, kind: type) -> np.ndarray:
    return np.frombuffer(batch.column(name)[row].as_py(), kind)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Indexes all terms of every whole text; texts without a term, null ones included, aren't in it."""
    exact = _postings(docs, id_col, text_col)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [_array(batch, "lengths", k, np.int32) for k in range(batch.num_rows)]
            yield pa.record_batch({"n": pa.array([x.size for x in n], pa.int64()), "t": pa.array([int(x.sum(dtype=np.int64)) for x in n], pa.int64())})

    total = exact.select("lengths").mapInArrow(summed, "n long, t long").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).first()
    n_docs, n_terms = total["n"] or 0, total["t"] or 0

    def quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                m = length_norm(_array(batch, "lengths", k, np.int32), n_docs, n_terms)
                exactly = impact(_array(batch, "counts", k, np.int32), m[_array(batch, "places", k, np.uint16)])
                level = (-(-exactly // STEP)).astype(np.uint8)
                yield pa.record_batch([*(batch.column(c).slice(k, 1) for c in batch.schema.names), pa.array([level.tobytes()], pa.binary())], names=[*batch.schema.names, "impacts"])

    return Index(stored(exact.mapInArrow(quantised, _EXACT + ", impacts binary"), "index", group=GROUP_BLOCKS), n_docs, n_terms)


class _Queries(NamedTuple):
    """Some queries: their distinct terms, and of each query the places of its terms there with how often it has them."""

    rows: list[int]
    terms: list[bytes]
    places: list[np.ndarray]
    times: list[np.ndarray]


def _packs(items: DataFrame) -> Iterator[_Queries]:
    """The stored queries (row, terms array<string>) in packs of about QUERY_TERMS terms, so that neither driver nor tasks hold more."""
    total = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    packs = -(-total // QUERY_TERMS)
    for k in range(packs):
        rows, found, places, times = [], {}, [], []
        for row, words in items.filter(F.pmod(F.xxhash64("row"), F.lit(packs)) == k).orderBy("row").collect():
            for word in words:
                found.setdefault(word.encode(), len(found))
            own, n = np.unique([found[w.encode()] for w in words], return_counts=True)
            rows.append(row)
            places.append(own.astype(np.int64))
            times.append(n.astype(np.int64))
        yield _Queries(rows, list(found), places, times)


def _doc_counts(blocks: DataFrame, terms) -> np.ndarray:
    """In how many documents each of the broadcast ``terms`` stands."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(terms.value, pa.binary())
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                at = pc.index_in(pa.array(batch.column("terms")[k].as_py().split(b" "), pa.binary()), value_set=wanted)
                hit = at.is_valid().to_numpy(zero_copy_only=False)
                total[at.drop_null().to_numpy()] += _array(batch, "spread", k, np.int32)[hit]
        at = np.flatnonzero(total)
        yield pa.record_batch({"term": at, "df": total[at]})

    found = blocks.select("terms", "spread").mapInArrow(counted, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    df = np.zeros(len(terms.value), np.int64)
    for row in found:
        df[row["term"]] = row["df"]
    return df


class _Block:
    """A block's postings of the wanted terms: bytes and counts, a line a term and a column a document."""

    def __init__(self, batch: pa.RecordBatch, row: int, wanted: pa.Array, n_docs: int, n_terms: int):
        ids = batch.column("doc_ids")[row].values
        self.known = ids.is_valid().to_numpy(zero_copy_only=False)
        self.ids = pc.fill_null(ids, 0).to_numpy()
        self.m = length_norm(_array(batch, "lengths", row, np.int32), n_docs, n_terms)
        spread = _array(batch, "spread", row, np.int32).astype(np.int64)
        at = pc.index_in(pa.array(batch.column("terms")[row].as_py().split(b" "), pa.binary()), value_set=wanted)
        here = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
        self.line = np.full(len(wanted), -1, np.int64)
        self.line[at.drop_null().to_numpy()] = np.arange(here.size)
        lengths, first = spread[here], (np.cumsum(spread) - spread)[here]
        own = np.repeat(first - np.r_[0, np.cumsum(lengths)[:-1]], lengths) + np.arange(lengths.sum())
        cell = np.repeat(np.arange(here.size), lengths), _array(batch, "places", row, np.uint16)[own]
        self.bytes = np.zeros((here.size, self.m.size), np.int64)
        self.bytes[cell] = _array(batch, "impacts", row, np.uint8)[own]
        self.counts = np.zeros((here.size, self.m.size), np.int32)
        self.counts[cell] = _array(batch, "counts", row, np.int32)[own]


class _Best:
    """The k best rows of a query so far; their kth score, or a block's kth lower bound where that is higher, is what a bound has to reach."""

    def __init__(self, k: int):
        self.k, self.score, self.ids, self.known = k, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def reach(self) -> int:
        return max(1, int(self.score[-1])) if self.score.size == self.k else 1

    def look(self, block: _Block, places: np.ndarray, weight: np.ndarray) -> None:
        line = block.line[places]
        line, weight = line[line >= 0], weight[line >= 0]
        if not line.size:
            return
        level = block.bytes[line]
        upper = weight @ level * STEP
        reach = self.reach()
        able = np.flatnonzero(upper >= reach)
        if able.size > self.k:
            lower = weight @ np.maximum(level[:, able] - 1, 0) * STEP
            reach = max(reach, int(np.partition(np.r_[lower, self.score], -self.k)[-self.k]))
            able = able[upper[able] >= reach]
        if not able.size:
            return
        score = weight @ impact(block.counts[line][:, able], block.m[able])
        good = score > 0
        self.score, self.ids, self.known = np.r_[self.score, score[good]], np.r_[self.ids, block.ids[able][good]], np.r_[self.known, block.known[able][good]]
        order = np.lexsort((self.ids, ~self.known, -self.score))[: self.k]
        self.score, self.ids, self.known = self.score[order], self.ids[order], self.known[order]


def search(index: Index, items: DataFrame, k: int = TOP, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): of each row of ``items`` the ``k`` documents of ``index`` that score highest.

    A term weighs floor(1000 * ln((2N + 2) / (2 df + 1))); a document's score sums weight * impact over the query's terms, repeats included,
    and is above 0. Equal scores are ranked by ascending doc_id, null ids last; rows that share an id are documents of their own, and items
    that share an id or have none are queries of their own. An item without a term, or whose terms stand in no document, has no rows; so
    has any item where no document has a term.
    """
    spark = items.sparkSession
    bounded_batches(spark)
    schema = "item_id {}, rank int, doc_id long, score long".format(items.schema[id_col].dataType.simpleString())
    texts = items.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("item_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = pa.array([terms_of(t) for t in utf8(batch)], pa.list_(pa.binary())).cast(pa.list_(pa.string()))
            yield pa.record_batch({"row": batch.column("row"), "item_id": batch.column("item_id"), "terms": terms})

    queries = stored(texts.mapInArrow(parted, f"row long, item_id {items.schema[id_col].dataType.simpleString()}, terms array<string>"), "queries")
    found, n_docs, n_terms = None, index.n_docs, index.n_terms
    for pack in _packs(queries.select("row", "terms").filter(F.size("terms") > 0)) if n_docs else ():
        terms = spark.sparkContext.broadcast(pack.terms)
        df = _doc_counts(index.blocks, terms)
        weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
        asked = spark.sparkContext.broadcast((pack.rows, pack.places, [weight[p] * n for p, n in zip(pack.places, pack.times, strict=True)]))

        def best(batches: Iterator[pa.RecordBatch], terms=terms, asked=asked) -> Iterator[pa.RecordBatch]:
            rows, places, weights = asked.value
            wanted, kept = pa.array(terms.value, pa.binary()), [_Best(k) for _ in rows]
            for batch in batches:
                for row in range(batch.num_rows):
                    block = _Block(batch, row, wanted, n_docs, n_terms)
                    for one, own, w in zip(kept, places, weights, strict=True):
                        one.look(block, own, w)
            sizes = [one.score.size for one in kept]
            if sum(sizes):
                ids = pa.array(np.concatenate([one.ids for one in kept]), mask=~np.concatenate([one.known for one in kept]))
                yield pa.record_batch({"row": np.repeat(np.array(rows, np.int64), sizes), "doc_id": ids, "score": np.concatenate([one.score for one in kept])})

        part = index.blocks.mapInArrow(best, "row long, doc_id long, score long")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], schema)
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(queries.select("row", "item_id"), "row").select("item_id", "rank", "doc_id", "score")


def search_documents(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """``search`` over an index of ``docs``. Null texts count as empty; other columns are ignored; an empty table gives an empty result."""
    return search(build_index(docs), items, k)
