"""Per-chunk values summed per document: each distinct chunk of text is valued once, then joined to the documents' frequencies.

Documents are dealt into blocks. A block's distinct chunks are dealt into buckets by a hash, and each (block, bucket) is one row
of packed arrays: the chunks, and their postings (a document's place in the block, and repeats). Only the chunks travel by
bucket, where each distinct one is valued once; the values come back in the same order and meet the postings by block. A
chunk is in a bucket once a block however often documents have it, so no common chunk makes a hot task.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, stored, utf8

#: A block ends at so many documents or so many bytes of text.
BLOCK_DOCS, BLOCK_BYTES = 8192, 16 << 20
#: Rows for each bucket, and buckets at most: a task keeps a bucket's distinct chunks with their values, and streams its rows.
BUCKET_ROWS, MOST_BUCKETS = 4096, 8192
MOST = 65535

_FIELDS = [("block", pa.int64()), ("bucket", pa.int32()), ("chunks", pa.binary()), ("lengths", pa.binary()), ("places", pa.binary()), ("repeats", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64()))]
_SCHEMA = "block long, bucket int, chunks binary, lengths binary, places binary, repeats binary, doc_ids array<long>, sizes array<long>"
_MARK = re.compile(rb"([a-z])([.,])(?=\s|$)")


def chunks_of(text: bytes) -> list[bytes]:
    """What stands between ASCII white space, ASCII letters lower-cased, a final full stop or comma after such a letter on its own.

    A text with ``<|`` is only split, as its special strings depend on case.
    """
    return text.split() if b"<|" in text else _MARK.sub(rb"\1 \2", text.lower()).split()


def chunk_postings(docs: DataFrame, label: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A stored table with a row per block and bucket, and for each block a row of bucket -1 that holds doc_ids and byte sizes.

    A lost task makes the same blocks again from the same rows.
    """
    arrow = pa.schema(_FIELDS)
    buckets = min(MOST_BUCKETS, max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.select(F.col(id_col)).count() // BUCKET_ROWS))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        pack = zstandard.ZstdCompressor(level=1).compress
        ids: list[int | None] = []
        sizes: list[int] = []
        numbers: list[np.ndarray] = []
        times: list[np.ndarray] = []
        found: dict[bytes, int] = {}

        def block() -> Iterator[pa.RecordBatch]:
            own = (part << 32) + number
            yield pa.record_batch([[own], pa.array([-1], pa.int32()), *(pa.array([None], t) for _, t in _FIELDS[2:6]), pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64()))], schema=arrow)
            chunks = list(found)
            if not chunks:
                return
            bucket = np.fromiter(map(crc32, chunks), np.int64, len(chunks)) % buckets
            order = np.argsort(bucket, kind="stable")
            rank = np.empty(order.size, np.int64)
            rank[order] = np.arange(order.size)
            place = np.repeat(np.arange(len(numbers)), [x.size for x in numbers])
            pairs = rank[np.concatenate(numbers)] << 16 | place
            sort = np.argsort(pairs)
            pairs, repeats = pairs[sort], np.concatenate(times)[sort]
            del place, sort
            lengths = np.bincount(pairs >> 16, minlength=order.size).astype(np.uint32)
            ends = np.r_[0, np.cumsum(lengths)]
            names, first = np.unique(bucket[order], return_index=True)
            edge = np.r_[first, order.size]
            for low in range(0, names.size, 64):
                some = range(low, min(low + 64, names.size))
                cols = [[pack(x) for x in xs] for xs in (
                    [b" ".join(chunks[j] for j in order[edge[k] : edge[k + 1]].tolist()) for k in some],
                    [lengths[edge[k] : edge[k + 1]].tobytes() for k in some],
                    [(pairs[ends[edge[k]] : ends[edge[k + 1]]] & MOST).astype(np.uint16).tobytes() for k in some],
                    [repeats[ends[edge[k]] : ends[edge[k + 1]]].tobytes() for k in some],
                )]
                n = len(some)
                yield pa.record_batch([np.full(n, own), names[some.start : some.stop].astype(np.int32), *(pa.array(c, pa.binary()) for c in cols), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))], schema=arrow)

        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), utf8(batch), strict=True):
                ids.append(doc_id)
                sizes.append(len(text))
                held += len(text)
                words = chunks_of(text)
                for word, k in zip([w for w in set(words) if w not in found], count(len(found))):  # noqa: B905
                    found[word] = k
                own, n = np.unique(np.fromiter(map(found.__getitem__, words), np.int32, len(words)), return_counts=True)
                while (n > MOST).any():  # a count that two bytes can't hold is split
                    over = n > MOST
                    own, n = np.r_[own, own[over]], np.r_[np.minimum(n, MOST), n[over] - MOST]
                numbers.append(own)
                times.append(n.astype(np.uint16))
                if len(ids) == BLOCK_DOCS or held >= BLOCK_BYTES:
                    yield from block()
                    number, held = number + 1, 0
                    for x in (ids, sizes, numbers, times, found):
                        x.clear()
        if ids:
            yield from block()

    return stored(id_text(docs, id_col, text_col).mapInArrow(made, _SCHEMA), label)


def chunk_sums(postings: DataFrame, value: Callable[[], Callable[[list[bytes]], np.ndarray]], width: int, kind: str = "<f4") -> DataFrame:
    """(doc_id, size, sums array<double> of ``width`` elements): over the document's chunks, repeats * value.

    ``value()`` is called once a task and returns a function from distinct chunks to an array (chunks, width), kept as ``kind``.
    """

    def valued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worth, pack, unpack = value(), zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress
        now, number, values = None, {}, np.empty((0, width), kind)
        for batch in batches:
            if not batch.num_rows:
                continue
            bucket = batch.column("bucket").to_numpy()
            begin = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            for a, b in zip(begin.tolist(), [*begin[1:].tolist(), bucket.size], strict=True):
                if bucket[a] != now:
                    now, number, values = bucket[a], {}, np.empty((0, width), kind)
                own = batch.slice(a, b - a)
                texts = [unpack(x).split(b" ") for x in own.column("chunks").to_pylist()]
                fresh = [c for c in set().union(*texts) if c not in number]
                number.update(zip(fresh, range(len(number), len(number) + len(fresh)), strict=True))
                for k in range(0, len(fresh), 50_000):
                    values = np.concatenate([values, worth(fresh[k : k + 50_000]).astype(kind)])
                found = [pack(values[np.fromiter(map(number.__getitem__, t), np.int64, len(t))].tobytes()) for t in texts]
                yield pa.record_batch({"block": own.column("block"), "bucket": own.column("bucket"), "worth": pa.array(found, pa.binary())})

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress

        def done(ids: pa.Array, sizes: pa.Array, total: np.ndarray) -> pa.RecordBatch:
            flat = np.ascontiguousarray(total[: len(ids)]).reshape(-1)
            return pa.record_batch({"doc_id": ids, "size": sizes, "sums": pa.FixedSizeListArray.from_arrays(flat, width).cast(pa.list_(pa.float64()))})

        now, head, total, waiting = None, None, np.empty(0), None
        for batch in batches:
            for row in range(batch.num_rows):
                block, bucket = batch.column("block")[row].as_py(), batch.column("bucket")[row].as_py()
                if bucket < 0:
                    if head:
                        yield done(*head, total)
                    now, head, total = block, (batch.column("doc_ids")[row].values, batch.column("sizes")[row].values), np.zeros((len(batch.column("doc_ids")[row]), width))
                    continue
                worth = batch.column("worth")[row].as_py()
                if worth is None:
                    waiting = block, bucket, *(np.frombuffer(unpack(batch.column(c)[row].as_py()), t) for c, t in (("lengths", np.uint32), ("places", np.uint16), ("repeats", np.uint16)))
                    continue
                assert waiting is not None and (now, bucket) == waiting[:2]
                _, _, lengths, places, repeats = waiting
                values = np.repeat(np.frombuffer(unpack(worth), kind).astype(np.float64).reshape(-1, width), lengths, axis=0)
                for k in range(width):
                    total[:, k] += np.bincount(places, repeats * values[:, k], len(total))
        if head:
            yield done(*head, total)

    chunks = postings.filter("bucket >= 0").select("block", "bucket", "chunks")
    values = chunks.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(valued, "block long, bucket int, worth binary")
    both = postings.drop("chunks").unionByName(values, allowMissingColumns=True)
    return both.repartition("block").sortWithinPartitions("block", "bucket", F.col("worth").isNotNull()).mapInArrow(whole, "doc_id long, size long, sums array<double>")
