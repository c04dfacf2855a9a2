"""Time columns as numbers, independent of the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(column: str) -> Column:
    """Microseconds since 1970 of a timestamp without time zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{column}`)")


def seconds(column: str) -> Column:
    """Seconds since 1970 of a timestamp without time zone, as double."""
    return micros(column) / F.lit(1e6)


def mmss(seconds_column: Column) -> Column:
    """Minutes and seconds as mm:ss; minutes go past 59."""
    whole = F.floor(seconds_column).cast("long")
    return F.concat(F.when(whole < 6000, F.lpad(F.floor(whole / 60).cast("string"), 2, "0")).otherwise(F.floor(whole / 60).cast("string")), F.lit(":"), F.lpad((whole % 60).cast("string"), 2, "0"))


def clock_seconds(text: Column) -> Column:
    """Seconds of hh:mm:ss,mmm; milliseconds with fewer digits are filled up on the right."""
    part = lambda k: F.regexp_extract(text, r"(\d+):(\d{2}):(\d{2})[,.](\d{1,3})", k)
    return part(1).cast("double") * 3600 + part(2).cast("double") * 60 + part(3).cast("double") + F.rpad(part(4), 3, "0").cast("double") / 1000
