"""Streams: sessions by inactivity, anchored dedupe and change filters with state."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def sessions(stream: DataFrame, key: str, at: str, gap: str, late: str | None = None) -> DataFrame:
    """(key, session_start, session_end, n): rows of a key less than ``gap`` apart; rows later than ``late`` are dropped on a stream with that watermark."""
    own = stream.withWatermark(at, late) if late else stream
    found = own.groupBy(F.session_window(at, gap).alias("w"), key).agg(F.count("*").alias("n"))
    return found.select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def _sorted_rows(frames: Iterator[pd.DataFrame], at: str) -> pd.DataFrame:
    rows = list(frames)
    return pd.concat(rows).sort_values(at, kind="stable") if rows else pd.DataFrame()


def dedupe_stream(stream: DataFrame, key: str, at: str, horizon: float, key_type: str = "long") -> DataFrame:
    """(key, at): rows more than ``horizon`` after the last kept row of their key; the anchor is the kept row and doesn't move."""

    def step(name: Any, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        anchor = state.get[0] if state.exists else None
        kept = []
        for t in _sorted_rows(frames, at)[at].tolist():
            if anchor is None or t - anchor > horizon:
                anchor = t
                kept.append(t)
        state.update((anchor,))
        yield pd.DataFrame({key: [name[0]] * len(kept), at: kept})

    return stream.select(key, F.col(at).cast("double").alias(at)).groupBy(key).applyInPandasWithState(step, f"{key} {key_type}, {at} double", "anchor double", "append", GroupStateTimeout.NoTimeout)


def changes_stream(stream: DataFrame, key: str, at: str, value: str, least: float, key_type: str = "long") -> DataFrame:
    """(key, at, value): rows at least ``least`` away from the last kept row of their key."""

    def step(name: Any, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = _sorted_rows(frames, at)
        kept = []
        for t, v in zip(rows[at].tolist(), rows[value].tolist(), strict=True):
            if last is None or abs(v - last) >= least:
                last = v
                kept.append((t, v))
        state.update((last,))
        yield pd.DataFrame({key: [name[0]] * len(kept), at: [t for t, _ in kept], value: [v for _, v in kept]})

    own = stream.select(key, F.col(at).cast("double").alias(at), F.col(value).cast("double").alias(value))
    return own.groupBy(key).applyInPandasWithState(step, f"{key} {key_type}, {at} double, {value} double", "last double", "append", GroupStateTimeout.NoTimeout)


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """What a stream gives for all input that is there now, written to Parquet at ``path`` and read back."""
    if mode == "append":
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    else:
        stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(path)).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
