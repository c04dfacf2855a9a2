"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the ASCII space and the control characters from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"

#: Rows and bytes of strings a broadcast side may have; beyond either the same join runs as a shuffle join.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
#: Keys that can each hold more than this part of a table's rows.
HOT_KEYS = 50_000


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one of our own where that is unset, which only a local master may leave so."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        return named.rstrip("/")
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spanloom-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


#: Folders that ``stored`` wrote and that are still there, in order.
_written: list[str] = []


def stored(df: DataFrame, label: str, compression: str = "zstd", group: int | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: cuts the lineage, survives lost executors.

    What is stored stays until ``discard``, the end of a ``scratch`` or that of the driver, as frames that are still to run may read it.
    ``group``: how many rows a row group has at most. The writer and each reader hold a row group, and the writer looks at its bytes only after a
    hundred rows, so rows of megabytes need it.
    """
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_removed, df.sparkSession, 0)
    _written.append(path)
    options = {"compression": compression} | ({"parquet.block.row.count.limit": str(group)} if group else {})
    df.write.options(**options).parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._stored_at = path
    return found


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _removed(spark: SparkSession, kept: int) -> None:
    """Removes all folders but the first ``kept``; a session that is gone can't."""
    while len(_written) > kept:
        path = _written.pop()
        try:
            _remove(spark, path)
        except Exception:  # the driver or its session ends
            return


def discard(*frames: DataFrame) -> None:
    """Removes what ``stored`` gave these very frames, which nothing reads any more."""
    for df in frames:
        path = getattr(df, "_stored_at", None)
        if path in _written:
            _written.remove(path)
            _remove(df.sparkSession, path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes at its end whatever operators stored inside it: write or collect their results within."""
    before = len(_written)
    try:
        yield
    finally:
        _removed(spark, before)


def small_side(df: DataFrame, rows: int, size: int = 0) -> DataFrame:
    """``df`` with a broadcast hint if it has at most BROADCAST_ROWS rows and ``size``, the bytes of its strings, at most BROADCAST_BYTES;
    else as it is, for a shuffle join."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else df


def join_hot(rows: DataFrame, facts: DataFrame, key: str, total: int, n: str = "n") -> DataFrame:
    """``rows`` (``total`` of them) joined with ``facts``, a row a key, whose column ``n`` counts the rows of its key.

    Keys with more than a fifty-thousandth of all rows are told to all tasks and meet their rows where those are; there are fewer
    than 50,000 of them, whatever the data. The others meet by a shuffle, which no key can fill. ``n`` is left out.
    """
    most = max(1000, total // HOT_KEYS)
    hot = stored(facts.filter(F.col(n) > most).drop(n), "hot")
    if hot.isEmpty():
        return rows.join(facts.drop(n), key)
    hot = F.broadcast(hot)
    rest = rows.join(hot.select(key), key, "left_anti").join(facts.filter(F.col(n) <= most).drop(n), key)
    return rows.join(hot, key).unionByName(rest)


def join_spread(rows: DataFrame, wide: DataFrame, key: str, most: int = 1000) -> DataFrame:
    """``rows`` joined with ``wide``, a long row a key: a key with more than ``most`` rows is dealt to several places, its long row to each.

    That makes no more copies of long rows than there are keys and a thousandth of the rows.
    """
    counts = rows.groupBy(key).agg(F.ceil(F.count("*") / most).cast("int").alias("__places"))
    heavy = stored(counts.filter("__places > 1"), "heavy")
    n = heavy.count()
    if not n:
        return rows.join(wide, key)
    heavy = small_side(heavy, n)
    place = F.pmod(F.xxhash64(*(c for c in rows.columns if c != key)), F.coalesce("__places", F.lit(1))).cast("int")
    dealt = rows.join(heavy, key, "left").withColumn("__place", place).drop("__places")
    copies = wide.join(heavy, key, "left").withColumn("__place", F.explode(F.sequence(F.lit(0), F.coalesce("__places", F.lit(1)) - 1))).drop("__places")
    return dealt.join(copies, [key, "__place"]).drop("__place")


def bounded_batches(spark: SparkSession, rows: int = 2000, size: int = 8 << 20) -> None:
    """Lets no Arrow batch of this session hold more rows or bytes than this: rows are whole texts, and a task holds a few batches."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = spark.conf.get(key).lower().rstrip("b")
        if now.lstrip("-").isdigit() and not 0 < int(now) <= most:  # a size with another unit was somebody's choice
            spark.conf.set(key, str(most))


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns the operators read, null texts as empty ones; other columns can't clash with ours."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def word_array(text: Column) -> Column:
    """The words of a text, in order; an empty array when there is none."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def utf8(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """The texts of a column as UTF-8 bytes, null as empty, a few hundred held at a time."""
    column = batch.column(name).cast(pa.binary())
    for a in range(0, len(column), 256):
        yield from (x or b"" for x in column.slice(a, 256).to_pylist())


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that together hold all rows of ``batches`` (sorted by ``key``), no key's rows in two of them."""
    pending: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        last = keys[batch.num_rows - 1].as_py()
        if pending and pending[0].column(key)[0].as_py() == last and keys[0].as_py() == last:
            pending.append(batch)
            continue
        low, high = 0, batch.num_rows - 1
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if keys[mid].as_py() == last else (mid + 1, high)
        if low or pending:
            yield pa.Table.from_batches([*pending, batch.slice(0, low)])
        pending = [batch.slice(low)]
    if pending:
        yield pa.Table.from_batches(pending)


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once a row, though ``use`` may name it inside a lambda."""
    return F.transform(F.array(value), use)[0]
