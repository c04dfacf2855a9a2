"""Timed text in and out: SRT files, speaker-turn lines, manifests, cached word lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.functions.text import clean_line, season_episode
from spanloom.functions.time import clock_seconds

TIMING = r"(\d+:\d{2}:\d{2}[,.]\d{1,3})\s*-->\s*(\d+:\d{2}:\d{2}[,.]\d{1,3})"


def find_files(spark: SparkSession, path: str, glob: str = "*.srt") -> DataFrame:
    """(path, size, modified) of files below ``path``, hidden ones left out."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return found.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")).filter(~F.col("path").rlike(r"/\.[^/]+$"))


#: The extensions of videos.
VIDEOS = ("mkv", "mp4", "m4v", "avi", "ts", "mov")


def find_videos(spark: SparkSession, path: str) -> DataFrame:
    """(path, size, modified, season, episode, second_episode) of the videos below ``path`` by their names; numbers are null where a name has none."""
    found = find_files(spark, path, "*").filter(F.lower(F.element_at(F.split("path", r"\."), -1)).isin(*VIDEOS))
    return found.withColumn("n", season_episode(F.element_at(F.split("path", "/"), -1))).select("path", "size", "modified", "n.*")


def write_report(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """CSV files with a header, of ``columns`` in that order; those that ``df`` lacks stay blank."""
    df.select(*(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns)).write.option("header", True).csv(path)


def stamp(at: Column) -> Column:
    """A time as ISO text in UTC, to the second."""
    return F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def read_texts(spark: SparkSession, path: str, glob: str = "*.srt") -> DataFrame:
    """(path, text): whole files, as UTF-8 without a byte-order mark, or as Windows-1252 where that is not valid UTF-8."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path).select("path", "content")
    # Windows-1252 is Latin-1 but for the control characters from 0x80 to 0x9F
    high = {chr(b): bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)}
    given = {a: b for a, b in high.items() if b}
    latin = F.translate(F.decode("content", "iso-8859-1"), "".join(given), "".join(given.values()))
    text = F.coalesce(F.try_validate_utf8(F.col("content").cast("string")), latin)
    return raw.select("path", F.regexp_replace(text, "^﻿", "").alias("text"))


def parse_cues(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, idx, start_s, end_s, raw_text): the cues of SRT texts.

    Blocks are parted by blank lines; the timing is looked for in a block's first three lines, the number before it is optional,
    blocks without timing or text are skipped, idx counts the kept ones from 0.
    """
    plain = F.regexp_replace(F.regexp_replace(F.col(text), "\r\n?", "\n"), "^﻿", "")
    blocks = texts.select(key, F.posexplode(F.split(plain, r"\n[ \t]*\n+")).alias("__n", "__block"))
    head = F.array_join(F.slice(F.split("__block", "\n"), 1, 3), "\n")
    body = F.btrim(F.regexp_replace(F.col("__block"), rf"^(?s:.*?){TIMING}[^\n]*\n?", ""), F.lit(" \t\n"))
    cues = blocks.withColumns({"__head": head, "raw_text": body}).filter(F.col("__head").rlike(TIMING) & (F.length("raw_text") > 0))
    timed = cues.select(key, "__n", clock_seconds(F.regexp_extract("__head", TIMING, 1)).alias("start_s"), clock_seconds(F.regexp_extract("__head", TIMING, 2)).alias("end_s"), "raw_text")
    kept = timed.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("__n", "start_s", "end_s", "raw_text"))).alias("__c"))
    return kept.select(key, F.posexplode("__c").alias("idx", "c")).select(key, "idx", "c.start_s", "c.end_s", "c.raw_text")


def cue_lines(cues: DataFrame, key: str) -> DataFrame:
    """(key, idx, line_no, text, name, is_turn, is_sound) for each line of the cues."""
    lines = cues.select(key, "idx", F.posexplode(F.split("raw_text", "\n")).alias("line_no", "line"))
    return lines.select(key, "idx", "line_no", clean_line(F.col("line")).alias("c")).select(key, "idx", "line_no", "c.*")


def file_facts(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n_cues, first_s, last_s, parse_error): cheap facts a file; a file without cues is a row with its error."""
    facts = parse_cues(texts, key, text).groupBy(key).agg(F.count("*").alias("n_cues"), F.min("start_s").alias("first_s"), F.max("end_s").alias("last_s"))
    return texts.select(key).join(facts, key, "left").select(key, F.coalesce("n_cues", F.lit(0)).alias("n_cues"), "first_s", "last_s", F.when(F.col("n_cues").isNull(), F.lit("no cues")).alias("parse_error"))


def render_cues(number: Column, start_s: Column, end_s: Column, text: Column) -> Column:
    """An SRT block."""
    pad = lambda x, n: F.lpad(x.cast("long").cast("string"), n, "0")

    def clock(s: Column) -> Column:
        ms = F.round(s * 1000).cast("long")
        return F.concat(pad(F.floor(ms / 3_600_000), 2), F.lit(":"), pad(F.floor(ms / 60_000) % 60, 2), F.lit(":"), pad(F.floor(ms / 1000) % 60, 2), F.lit(","), pad(ms % 1000, 3))

    return F.concat(number.cast("string"), F.lit("\n"), clock(start_s), F.lit(" --> "), clock(end_s), F.lit("\n"), text, F.lit("\n"))


def write_turns(turns: DataFrame, path: str) -> None:
    """Speaker-turn text files, one folder per uri, lines sorted by start: columns uri, start_s, dur_s, speaker."""
    line = F.format_string("SPEAKER %s 1 %.3f %.3f <NA> <NA> %s <NA> <NA>", "uri", "start_s", "dur_s", "speaker")
    turns.select("uri", "start_s", line.alias("value")).repartition("uri").sortWithinPartitions("uri", "start_s").select("uri", "value").write.partitionBy("uri").text(path)


def read_turns(spark: SparkSession, path: str) -> DataFrame:
    """The turns of such files."""
    part = F.split("value", " ")
    return spark.read.text(path).select(part[1].alias("uri"), part[3].cast("double").alias("start_s"), part[4].cast("double").alias("dur_s"), part[7].alias("speaker"))


def write_spans(spans: DataFrame, path: str, folders: bool = False) -> None:
    """Text files of annotated stretches: columns uri, start_s, end_s. Each line names its uri; a uri's lines stand together in one file, sorted by
    start, and a file holds many uris, so that their number doesn't make the number of files. ``folders``: one folder per uri, for readers that look
    for a uri by its path; each costs a file."""
    line = F.format_string("%s 1 %.3f %.3f", "uri", "start_s", "end_s")
    lines = spans.select("uri", "start_s", line.alias("value")).repartition("uri").sortWithinPartitions("uri", "start_s")
    if folders:
        lines.select("uri", "value").write.partitionBy("uri").text(path)
    else:
        lines.select("value").write.text(path)


def read_spans(spark: SparkSession, path: str) -> DataFrame:
    """The stretches of such files."""
    part = F.split("value", " ")
    return spark.read.text(path).select(part[0].alias("uri"), part[2].cast("double").alias("start_s"), part[3].cast("double").alias("end_s"))


def write_names(rows: DataFrame, uri: str, path: str, split: str = "split") -> None:
    """Lists of uris, a line each, one folder per split."""
    rows.select(split, F.col(uri).alias("value")).distinct().repartition(split).sortWithinPartitions(split, "value").write.partitionBy(split).text(path)


def read_manifest(spark: SparkSession, path: str, schema: str, split: str = "split") -> DataFrame:
    """The rows of ``write_manifest``; ``schema`` is that of the other columns."""
    return spark.read.schema(f"{schema}, {split} string").option("header", True).csv(path)


def write_trials(pairs: DataFrame, path: str) -> None:
    """Trial lists: target, a and b, separated by spaces, without header."""
    pairs.select("target", "a", "b").write.option("sep", " ").csv(path)


def write_manifest(rows: DataFrame, path: str, split: str = "split") -> None:
    """CSV files with a header, one folder per split."""
    rows.write.partitionBy(split).option("header", True).csv(path)


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    """(target, a, b) of space-separated trial lists without header."""
    return spark.read.schema("target int, a string, b string").option("sep", " ").csv(path)


def read_word_cache(spark: SparkSession, path: str) -> DataFrame:
    """(file, word, start_s, end_s) of JSON caches that hold either {"words": [[word, start, end], …]} or the bare list, one document a line."""
    parsed = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.try_parse_json("value").alias("v"))
    words = F.coalesce(F.try_variant_get("v", "$.words", "array<variant>"), F.try_variant_get("v", "$", "array<variant>"))
    one = parsed.select("file", F.posexplode(words).alias("n", "w"))
    return one.select("file", "n", F.try_variant_get("w", "$[0]", "string").alias("word"), F.try_variant_get("w", "$[1]", "double").alias("start_s"), F.try_variant_get("w", "$[2]", "double").alias("end_s"))


def without_fields(df: DataFrame, drop: frozenset[str] = frozenset({"text", "sdh_name", "lines", "ocr_text"})) -> DataFrame:
    """``df`` without the named columns and fields at any depth of structs and arrays of structs."""

    def pick(column: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.StructType):
            return F.struct(*(pick(column[f.name], f.dataType).alias(f.name) for f in kind.fields if f.name not in drop))
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            return F.transform(column, lambda x: pick(x, kind.elementType))
        return column

    return df.select(*(pick(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields if f.name not in drop))
