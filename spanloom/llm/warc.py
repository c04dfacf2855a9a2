"""WARC archives written and read by Spark, and an index of their captures merged from locally sorted runs by a loser tree."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_folder, small_side, stored

#: Payload bytes of an archive file at most, unless it is one record, and its records at most; a file is read by one task.
FILE_BYTES, RECORDS = 32 << 20, 20_000
#: Records are put into files by their size: up to so many payload bytes, and beyond the last, a record a file.
SIZES = [1 << 10, 8 << 10, 64 << 10, 512 << 10, 4 << 20]
#: Index rows of a range of the merged index, about.
RANGE_ROWS = 200_000
#: Fixed values of the format: the base32 alphabet, the revisit profile, the first capture time where the table has none.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = 1_704_067_200


def base32_sha1(payload: Column) -> Column:
    """The bare upper-case base32 SHA-1 of a text's UTF-8."""
    digits = F.sha1(payload)
    letters = []
    for k in range(8):
        five = F.conv(F.substring(digits, 5 * k + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(ALPHABET), F.shiftright(five, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", time_col: str | None = None) -> None:
    """Writes a WARC record per row under ``path``, as gzipped files whose records are sorted by host, URL, time and id.

    Of records with equal payloads of at least ``least_bytes`` bytes the one with the smallest id is a response with the
    payload, the others are revisits that refer to it; smaller ones are all responses. Rows that share that smallest id are
    all responses, as is a payload that only null ids have. A null payload counts as empty, a null URL as none. Control
    characters and spaces in URLs are percent-encoded. Without ``time_col`` (epoch seconds) the time is drawn from the id.

    Payloads don't move: each task writes its own rows, and what is known of repeated payloads comes to them, a row a digest that
    occurs more than once. A file is one gzip member, as Spark's text sink makes it.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col(url_col).cast("string"), "\r", "%0D"), "\n", "%0A"), r"[\x00-\x20]", "%20").alias("url"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"),
        (F.col(time_col).cast("long") if time_col else F.lit(EPOCH) + F.pmod(F.coalesce(F.col(id_col).cast("long"), F.lit(0)), F.lit(31_536_000))).alias("at"),
    ).withColumn("digest", base32_sha1(F.col("payload")))
    sized = rows.withColumn("bytes", F.octet_length("payload"))
    first = sized.filter(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    repeated = stored(first.filter("n > 1").drop("n"), "repeated")
    marked = sized.join(small_side(repeated, repeated.count()), "digest", "left").withColumn("revisit", F.coalesce((F.col("bytes") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("first_id").isNotNull(), F.lit(False)))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"), F.when(F.col("revisit"), F.lit("")).otherwise(F.col("payload")))
    made = marked.withColumn("block", http)
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn("page_id")),
        F.when(F.col("url").isNull(), F.lit("")).otherwise(line("WARC-Target-URI", F.col("url"))),
        line("WARC-Date", F.date_format(F.timestamp_seconds("at"), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(F.col("revisit"), F.concat(line("WARC-Refers-To", urn("first_id")), F.lit(f"WARC-Profile: {PROFILE}\r\n"))).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
        F.col("block"),
    )
    host = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    # a pass for each size that payloads have: however sizes lie, no file gets longer than FILE_BYTES
    level = F.lit(len(SIZES))
    for number, most in reversed(list(enumerate(SIZES))):
        level = F.when(F.col("bytes") <= most, number).otherwise(level)
    for number in sorted(r["level"] for r in sized.select(level.alias("level")).distinct().collect()) or [0]:  # a few
        share = max(1, min(RECORDS, FILE_BYTES // SIZES[number])) if number < len(SIZES) else 1
        (
            made.filter(level == number)
            .select(record.alias("value"), host.alias("host"), "url", "at", "page_id")
            .sortWithinPartitions("host", "url", "at", "page_id")
            .select("value")
            .write.mode("append")
            .option("lineSep", "\r\n\r\n")  # the end of a WARC record
            .option("compression", "gzip")
            .option("maxRecordsPerFile", share)
            .text(path)
        )


def url_key(url: str | None) -> str:
    """A sort key that groups a host's pages: the host's labels reversed, then port, path and query; the scheme is dropped."""
    if not url:
        return ""
    try:
        parts = urlsplit(url)
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return url
    if not host:
        return url
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + tail


def records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of each record of an uncompressed archive, by the lengths the records state."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(head["content-length"])
        yield at, head, data[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


_INDEX = "run string, url_key string, captured_at string, page_id long, url string, offset long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of the archives under ``path``: run (the file), the keys, where it starts, and what it says.

    A response's length and digest are those of the payload read; a revisit's are those its record states.
    """

    def number(urn: str | None) -> int | None:
        tail = (urn or "").rpartition(":")[2].rstrip(">")
        return int(tail) if tail not in ("", "none") else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = [x.split(" ")[0] for x in _INDEX.split(", ")]
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows = []
                for offset, head, block in records(gzip.decompress(content.as_buffer())):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    kind = head["warc-type"]
                    if kind == "response":
                        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    else:
                        size = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")).split(b":")[1])
                        digest = head["warc-payload-digest"].removeprefix("sha1:")
                    url = head.get("warc-target-uri")
                    rows.append((path, url_key(url), head["warc-date"], number(head["warc-record-id"]), url, offset, size, digest, kind, number(head.get("warc-refers-to"))))
                rows.sort(key=_order)  # a run: the file's captures in order
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    return files.mapInArrow(read, _INDEX)


def _order(row: tuple) -> tuple:
    return row[1], row[2], row[3] is not None, row[3] or 0, row[0], row[5]


def loser_tree_merge(sources: list[list[tuple]], key) -> Iterator[tuple]:
    """Merges sorted lists: a tree whose inner nodes keep the loser of their match, so that a step replays one path only."""
    k = len(sources)
    places = [0] * k
    done = (1,)

    def head(s: int) -> tuple:
        return (0, key(sources[s][places[s]]), s) if places[s] < len(sources[s]) else done

    heads = [head(s) for s in range(k)]
    losers = [-1] * k

    def play(s: int) -> int:
        node = (s + k) // 2
        while node:
            if losers[node] == -1:  # the first to come waits for its opponent
                losers[node] = s
                return -1
            if heads[losers[node]] < heads[s]:
                s, losers[node] = losers[node], s
            node //= 2
        return s

    winner = 0 if k == 1 else -1
    for s in range(k) if k > 1 else ():
        got = play(s)
        winner = got if got != -1 else winner
    while k and heads[winner] != done:
        yield sources[winner][places[winner]]
        places[winner] += 1
        heads[winner] = head(winner)
        winner = play(winner) if k > 1 else winner


def merge_runs(captures: DataFrame) -> DataFrame:
    """``captures`` in global order of URL key, time and id: each range of keys merges its slices of the sorted runs.

    What a task reads of a run goes to a range as one slice, in the run's order, so a slice is sorted as it comes; a range has about
    RANGE_ROWS index rows, without payloads.
    """
    ranges = max(int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-captures.count() // RANGE_ROWS))
    names = [x.split(" ")[0] for x in _INDEX.split(", ")]

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[tuple, list[tuple]] = {}
        schema = None
        for batch in batches:
            schema = pa.schema([batch.schema.field(c) for c in names])
            for part, row in zip(batch.column("part").to_pylist(), zip(*(batch.column(c).to_pylist() for c in names), strict=True), strict=True):
                slices.setdefault((row[0], part), []).append(row)
        for own in slices.values():
            if any(_order(a) > _order(b) for a, b in zip(own, own[1:], strict=False)):
                raise ValueError("a slice of a run came out of order")
        out: list[tuple] = []
        for row in loser_tree_merge([slices[r] for r in sorted(slices)], _order):
            out.append(row)
            if len(out) == 10_000:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], names=names)
                out = []
        if out:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], names=names)

    return captures.select(*names, F.spark_partition_id().alias("part")).repartitionByRange(ranges, "url_key", "captured_at", "page_id").mapInArrow(merged, _INDEX)


def capture_histories(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", time_col: str | None = None) -> DataFrame:
    """A row per row of ``pages``, from archives written to the shared folder and read back, in global order of URL key, time and id.

    Columns: those of ``read_captures``. For null payloads, URLs and ids and for repeated rows see ``write_archives``; a null
    id stays null. An empty table gives an empty result; other columns are ignored.
    """
    spark = pages.sparkSession
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, least_bytes, id_col, url_col, payload_col, time_col)
    return merge_runs(stored(read_captures(spark, path), "captures"))
