"""Operators over ordered rows: islands, carried values, sequential folds, interval unions, samples in turn."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .chained import Anchored, Capped, Changed, long_keys, units
from .running import running


def ordered(keys: Sequence[str], order: Sequence[str]):
    """The window of a key's rows in order."""
    return Window.partitionBy(*keys).orderBy(*order)


def islands(df: DataFrame, keys: Sequence[str], order: Sequence[str], breaks: Column, out: str = "island") -> DataFrame:
    """``df`` with the number, from 1, of the maximal stretch of rows a row is in; ``breaks`` says where one starts (the first row always does)."""
    at = ordered(keys, order)
    start = F.when(F.row_number().over(at) == 1, 1).otherwise(F.coalesce(breaks, F.lit(False)).cast("int"))
    return df.withColumn("__start", start).withColumn(out, F.sum("__start").over(at.rowsBetween(Window.unboundedPreceding, 0))).drop("__start")


def gap_before(keys: Sequence[str], order: Sequence[str], start: str, end: str) -> Column:
    """A row's start less the previous row's end; null for the first."""
    return F.col(start) - F.lag(end).over(ordered(keys, order))


def runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], start: str, end: str, gap: float, marker: Column, name: str | None = None, segment: str | None = None) -> DataFrame:
    """``df`` with run_id: a run ends at a marker, a gap of ``gap`` or more, another segment, or another known name than the previous row's known one."""
    at = ordered(keys, order)
    breaks = marker | (gap_before(keys, order, start, end) >= gap)
    if segment:
        breaks = breaks | ~F.col(segment).eqNullSafe(F.lag(segment).over(at))
    if name:
        breaks = breaks | F.coalesce(F.col(name) != F.lag(name).over(at), F.lit(False))
    return islands(df, keys, order, breaks, "run_id")


def run_facts(df: DataFrame, keys: Sequence[str], start: str, end: str, long_run: float, name: str | None = None) -> DataFrame:
    """Runs as rows: n, run_start, run_dur (last end less first start), domain (long or short), and the only name if there is just one."""
    aggs = [F.count("*").alias("n"), F.min(start).alias("run_start"), (F.max(end) - F.min(start)).alias("run_dur")]
    if name:
        aggs.append(F.when(F.min(name) == F.max(name), F.min(name)).alias("sole_name"))
    facts = df.groupBy(*keys, "run_id").agg(*aggs)
    return facts.withColumn("domain", F.when(F.col("run_dur") >= long_run, F.lit("long")).otherwise(F.lit("short")))


def carry(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, reset: Column, out: str, inherited: str = "inherited") -> DataFrame:
    """``df`` with the last known value, forgotten where ``reset`` holds (a row's own value still counts), and whether it was inherited."""
    zoned = islands(df, keys, order, reset, "__zone")
    span = Window.partitionBy(*keys, "__zone").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return zoned.withColumn(out, F.last(value, ignorenulls=True).over(span)).withColumn(inherited, F.col(out).isNotNull() & F.col(value).isNull()).drop("__zone")


#: Arrow types of the columns a rule makes.
ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string()}


def fold(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], step: Callable[[Iterator[tuple]], Iterable[tuple]], out: str) -> DataFrame:
    """(keys, ``out``): what ``step`` makes of the stream of each key's ``values`` in order, for rules whose state depends on all before.

    Rows are sorted by Spark and pass through ``step`` one by one, so a task holds a batch and the rule's state, however long a
    key is; a key is still one task's work.
    """
    keys, values = list(keys), list(values)
    width = len(keys)
    fresh = [x.strip().split(" ") for x in out.split(",")]
    schema = ", ".join([*(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys), *(f"`{c}` {kind}" for c, kind in fresh)])
    names = [*keys, *(c for c, _ in fresh)]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: dict[str, pa.DataType] = {}
        found: list[tuple] = []

        def rows() -> Iterator[tuple]:
            for batch in batches:
                given.update(zip(batch.schema.names, batch.schema.types, strict=True))
                yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)

        def batch_of(some: list[tuple]) -> pa.RecordBatch:
            kinds = [*(given[k] for k in keys), *(ARROW.get(kind) or given[c] for c, kind in fresh)]
            return pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*some, strict=True), kinds, strict=True)], names=names)

        for key, group in groupby(rows(), key=lambda r: r[:width]):
            found += [(*key, *row) for row in step(r[width:] for r in group)]
            if len(found) >= 10_000:
                yield batch_of(found)
                found = []
        if found:
            yield batch_of(found)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).select(*keys, *values).mapInArrow(made, schema)


def _units(rows: Iterator[tuple], joins: Callable[[int, int, int, int], bool]) -> Iterator[tuple]:
    """(start, end, n) of units of rows (start, end); ``joins(unit start, unit end, row start, row end)`` says whether a row goes on the open unit."""
    start = end = n = None
    for a, b in rows:
        if n and joins(start, end, a, b):
            end, n = max(end, b), n + 1
            continue
        if n:
            yield start, end, n
        start, end, n = a, b, 1
    if n:
        yield start, end, n


def merge_capped(df: DataFrame, keys: Sequence[str], order: Sequence[str], start: str, end: str, low: int, high: int, cap: int) -> DataFrame:
    """Units (keys, unit_start, unit_end, n): a row joins the open unit if its gap to the unit's end is in [low, high] and the unit would not get longer than cap.

    Rows without a start or end are left out. A key of very many rows is worked on by many tasks.
    """
    timed = df.filter(F.col(start).isNotNull() & F.col(end).isNotNull())
    if long_keys(timed, keys):
        marked = units(timed.select(*keys, *dict.fromkeys([*order, start, end])), keys, order, [start, end], Capped(low, high, cap))
        return marked.groupBy(*keys, "__unit").agg(F.max(F.when(F.col("__first"), F.col(start))).cast("long").alias("unit_start"), F.max(end).cast("long").alias("unit_end"), F.count("*").alias("n")).drop("__unit")
    return fold(timed, keys, order, [start, end], lambda rows: _units(rows, lambda s, e, a, b: low <= a - e <= high and b - s <= cap), "unit_start long, unit_end long, n long")


def dedupe_anchored(df: DataFrame, keys: Sequence[str], order: Sequence[str], at: str, score: str, horizon: int) -> DataFrame:
    """Kept rows (keys, at, last, best, n): a row within ``horizon`` of the first of the kept one's rows folds into it; the anchor doesn't move.

    Rows without a time are left out; a missing score counts as none. A key of very many rows is worked on by many tasks.
    """
    timed = df.filter(F.col(at).isNotNull())
    if long_keys(timed, keys):
        marked = units(timed.select(*keys, *dict.fromkeys([*order, at, score])), keys, order, [at], Anchored(horizon))
        anchor = F.max(F.when(F.col("__first"), F.col(at))).cast("long").alias("at")
        return marked.groupBy(*keys, "__unit").agg(anchor, F.max_by(at, "__at").cast("long").alias("last"), F.max(score).cast("double").alias("best"), F.count("*").alias("n")).drop("__unit")

    def step(rows: Iterator[tuple]) -> Iterator[tuple]:
        kept: list | None = None
        for t, s in rows:
            if kept and t - kept[0] <= horizon:
                kept[1], kept[2], kept[3] = t, max((x for x in (kept[2], s) if x is not None), default=None), kept[3] + 1
                continue
            if kept:
                yield tuple(kept)
            kept = [t, t, s, 1]
        if kept:
            yield tuple(kept)

    return fold(timed, keys, order, [at, score], step, "at long, last long, best double, n long")


def changes_only(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, least: float) -> DataFrame:
    """The rows whose value is at least ``least`` away from the last kept row's; rows without a value are left out.

    A key of very many rows is worked on by many tasks.
    """
    valued = df.filter(F.col(value).isNotNull())
    if long_keys(valued, keys):
        return units(valued, keys, order, [value], Changed(least)).filter("__first").select(df.columns)
    others = [c for c in df.columns if c not in keys]
    place = others.index(value)

    def step(rows: Iterator[tuple]) -> Iterator[tuple]:
        last = None
        for row in rows:
            if last is None or abs(row[place] - last) >= least:
                last = row[place]
                yield row

    out = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in others)
    return fold(valued, keys, order, others, step, out).select(df.columns)


def scenes(df: DataFrame, keys: Sequence[str], order: Sequence[str], start: str, end: str, gap: int, span: int) -> DataFrame:
    """Units (keys, unit_start, unit_end, n): a new one begins after a gap of more than ``gap`` or if the unit would span more than ``span``.

    A gap before a row always ends a unit, so a key's rows are first cut there, by a window, and each stretch is folded by itself: a
    long key is as many tasks' work as it has stretches. Rows without a start or end are left out.
    """
    timed = df.filter(F.col(start).isNotNull() & F.col(end).isNotNull())
    at = ordered(keys, order)
    reach = F.max(end).over(at.rowsBetween(Window.unboundedPreceding, -1))
    cut = islands(timed.withColumn("__reach", reach), keys, order, F.col(start) - F.col("__reach") > gap, "__stretch")
    found = fold(cut, [*keys, "__stretch"], order, [start, end], lambda rows: _units(rows, lambda s, e, a, b: a - e <= gap and b - s <= span), "unit_start long, unit_end long, n long")
    return found.drop("__stretch")


def bursts(df: DataFrame, at: str, who: str, window: int, least: int) -> DataFrame:
    """``df`` with in_burst: whether some row's forward window of ``window`` that holds ``least`` or more distinct ``who`` covers it.

    The distinct ``who`` in [t, t + window] are those with a row there, so each ``who``'s stretches [row - window, row] are united and the
    starts up to t less the ends before t are counted: running sums over distinct times, no set of any window is built. A row
    without a time or ``who`` is in no burst.
    """
    known = df.filter(F.col(at).isNotNull() & F.col(who).isNotNull()).select(F.col(who).alias("__w"), F.col(at).alias("__b"), (F.col(at) - window).alias("__a")).distinct()
    united = interval_union(known, ["__w"], "__a", "__b")
    one = lambda t, n, anchor: F.struct(t.alias("t"), F.lit(n).cast("long").alias("n"), F.lit(anchor).alias("anchor"))
    turns = united.select(F.explode(F.array(one(F.col("__a"), 1, False), one(F.col("__b") + 1, -1, False))).alias("s"))
    steps = turns.unionByName(known.select(one(F.col("__b"), 0, True).alias("s"))).groupBy(F.col("s.t").alias("__t")).agg(F.sum("s.n").alias("n"), F.max("s.anchor").alias("__anchor"))
    counted = running(steps, "__t", {"__there": "n"}, like=df.select(at))
    # a bin as wide as the window: an anchor up to ``window`` before a time is in its bin, not after it, or in the bin before, late enough
    of = lambda t: F.floor(t / window)
    opened = counted.filter(F.col("__anchor") & (F.col("__there") >= least)).groupBy(of(F.col("__t")).alias("__bin")).agg(F.min("__t").alias("__lo"), F.max("__t").alias("__hi"))
    nothing = F.lit(None).cast("long")
    both = F.array(F.struct(F.col("__bin").alias("bin"), F.col("__lo").alias("lo"), nothing.alias("late")), F.struct((F.col("__bin") + 1).alias("bin"), nothing.alias("lo"), F.col("__hi").alias("late")))
    bins = opened.select(F.explode(both).alias("s")).groupBy(F.col("s.bin").alias("__bin")).agg(F.min("s.lo").alias("__lo"), F.max("s.late").alias("__late"))
    joined = df.withColumn("__bin", of(F.col(at))).join(bins, "__bin", "left")
    hit = (F.col("__lo") <= F.col(at)) | (F.col("__late") >= F.col(at) - window)
    return joined.select(*df.columns, (F.coalesce(hit, F.lit(False)) & F.col(who).isNotNull()).alias("in_burst"))


def interval_union(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """(keys, start, end, n): overlapping or touching intervals of a key as one."""
    at = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(at.rowsBetween(Window.unboundedPreceding, -1))
    marked = islands(df.withColumn("__reach", reach), keys, [start, end], F.col(start) > F.col("__reach"), "__island")
    return marked.groupBy(*keys, "__island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n")).drop("__island")


def bridge_gaps(df: DataFrame, keys: Sequence[str], start: str, end: str, gap: int) -> DataFrame:
    """(keys, start, end, n): disjoint intervals joined over gaps of at most ``gap``."""
    marked = islands(df, keys, [start], gap_before(keys, [start], start, end) > gap, "__island")
    return marked.groupBy(*keys, "__island").agg(F.min(start).alias(start), F.max(end).alias(end), F.sum("n").alias("n")).drop("__island")


def rolling_median(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, reach: int, out: str) -> DataFrame:
    """``df`` with the median of the rows up to ``reach`` before and after."""
    span = ordered(keys, order).rowsBetween(-reach, reach)
    return df.withColumn(out, F.percentile(value, F.lit(0.5)).over(span))


def neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, reach: int) -> DataFrame:
    """``df`` with arrays before and after of up to ``reach`` neighbours' values, in order."""
    at = ordered(keys, order)
    return df.withColumns({"before": F.collect_list(value).over(at.rowsBetween(-reach, -1)), "after": F.collect_list(value).over(at.rowsBetween(1, reach))})


def adjacent_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Column, out: str = "group_no") -> DataFrame:
    """The rows where ``keep`` holds, with one number per stretch without other rows between (place among all less place among kept)."""
    at = ordered(keys, order)
    placed = df.withColumn("__place", F.row_number().over(at)).filter(keep)
    return placed.withColumn(out, F.col("__place") - F.row_number().over(at)).drop("__place")


def split_on_votes(df: DataFrame, keys: Sequence[str], order: Sequence[str], vote: str, out: str = "part") -> DataFrame:
    """``df`` with a part number that rises where a vote differs from the last one before it; rows without a vote stay in their part."""
    at = ordered(keys, order)
    last = F.last(vote, ignorenulls=True).over(at.rowsBetween(Window.unboundedPreceding, -1))
    cut = F.coalesce(F.col(vote) != last, F.lit(False)).cast("int")
    return df.withColumn("__cut", cut).withColumn(out, F.sum("__cut").over(at.rowsBetween(Window.unboundedPreceding, 0))).drop("__cut")


def split_on_flags(df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: str, out: str = "part") -> DataFrame:
    """``df`` with islands of equal flags; a null flag follows the one before, nulls at the start are a part of their own."""
    at = ordered(keys, order)
    filled = df.withColumn("__flag", F.last(flag, ignorenulls=True).over(at.rowsBetween(Window.unboundedPreceding, 0)))
    return islands(filled, keys, order, ~F.col("__flag").eqNullSafe(F.lag("__flag").over(at)), out).drop("__flag")


def in_turn(df: DataFrame, stratum: str, key: str, n: int) -> DataFrame:
    """``n`` rows, one per stratum in turn: rows of a stratum and the strata themselves in order of their SHA-1."""
    ranked = df.withColumn("turn", F.row_number().over(Window.partitionBy(stratum).orderBy(F.sha1(F.col(key).cast("string")), key)))
    return ranked.orderBy("turn", F.sha1(F.col(stratum).cast("string"))).limit(n)


def interleave(df: DataFrame, key: str, rankings: Sequence[Sequence[Column]], n: int) -> DataFrame:
    """``n`` rows (key, place, ranking): item i of each ranking in turn, a row where it comes first. Each ranking needs its first n only."""
    found = None
    for number, order in enumerate(rankings):
        top = df.orderBy(*order).limit(n).select(key, *(c.alias(f"__o{k}") for k, c in enumerate(order)))
        placed = df.join(F.broadcast(top.select(key)), key, "left_semi").withColumn("at", F.row_number().over(Window.orderBy(*order)))  # at most n rows
        own = placed.select(key, ((F.col("at") - 1) * len(rankings) + number).alias("place"))
        found = own if found is None else found.unionByName(own)
    first = found.groupBy(key).agg(F.min("place").alias("place"))
    return first.orderBy("place").limit(n)


def change_point(df: DataFrame, keys: Sequence[str], order: Sequence[str], voice: str) -> DataFrame:
    """(keys, first_voice, second_voice, cut, errors): among rows of a key's two commonest voices, after how many rows to cut so that
    the fewest are on the wrong side, whichever voice comes first; equals: the earliest."""
    counts = df.groupBy(*keys, voice).agg(F.count("*").alias("n"))
    top = counts.withColumn("r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), voice))).filter("r <= 2")
    two = top.groupBy(*keys).agg(F.max(F.when(F.col("r") == 1, F.col(voice))).alias("first_voice"), F.max(F.when(F.col("r") == 2, F.col(voice))).alias("second_voice")).filter("second_voice is not null")
    own = df.join(two, list(keys)).filter((F.col(voice) == F.col("first_voice")) | (F.col(voice) == F.col("second_voice")))
    is_first = (F.col(voice) == F.col("first_voice")).cast("int")
    at = ordered(keys, order)
    upto, whole = at.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*keys)
    sums = own.withColumns({"j": F.row_number().over(at), "c1": F.sum(is_first).over(upto), "n1": F.sum(is_first).over(whole), "n": F.count("*").over(whole)}).withColumn("c2", F.col("j") - F.col("c1"))
    wrong = sums.withColumn("errors", F.least(F.col("c2") + F.col("n1") - F.col("c1"), F.col("c1") + (F.col("n") - F.col("n1")) - F.col("c2"))).filter("j < n")
    return wrong.groupBy(*keys, "first_voice", "second_voice").agg(F.min(F.struct("errors", "j")).alias("b")).select(*keys, "first_voice", "second_voice", F.col("b.j").alias("cut"), F.col("b.errors").alias("errors"))


def share_of_span(df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: str) -> DataFrame:
    """``df`` with share_start and share_end: where each row lies in a span of length 1 dealt out by weight."""
    at = ordered(keys, order)
    total = F.sum(weight).over(Window.partitionBy(*keys))
    end = F.sum(weight).over(at.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumns({"share_start": (end - F.col(weight)) / F.nullif(total, F.lit(0)), "share_end": end / F.nullif(total, F.lit(0))})


def last_after_first(df: DataFrame, keys: Sequence[str], at: str, first: Column, then: Column, reach: int) -> DataFrame:
    """(keys, first_at, then_at): the first row that meets ``first``, and the last at most ``reach`` later that meets ``then``."""
    opened = df.groupBy(*keys).agg(F.min(F.when(first, F.col(at))).alias("first_at")).filter("first_at is not null")
    return df.join(opened, list(keys)).groupBy(*keys, "first_at").agg(F.max(F.when(then & (F.col(at) > F.col("first_at")) & (F.col(at) <= F.col("first_at") + reach), F.col(at))).alias("then_at"))


def split_on_mentions(df: DataFrame, keys: Sequence[str], order: Sequence[str], hit: str, out: str = "part", confident: Column | None = None) -> DataFrame:
    """``df`` with islands of rows that mention the key's predicted name and of rows that don't; a key where all or none do stays one part.

    With ``confident``, so does a key one of whose rows lacks it: only a group whose prediction is sure is cut by what it says.
    """
    whole = Window.partitionBy(*keys)
    flagged = F.coalesce(F.col(hit), F.lit(False)).cast("int")
    plain = F.min(flagged).over(whole) == F.max(flagged).over(whole)
    if confident is not None:
        plain = plain | ~F.bool_and(F.coalesce(confident, F.lit(False))).over(whole)
    cut = split_on_flags(df.withColumn("__plain", plain).withColumn("__hit", flagged), keys, order, "__hit", out)
    return cut.withColumn(out, F.when(F.col("__plain"), F.lit(1).cast("long")).otherwise(F.col(out))).drop("__plain", "__hit")


def last_near_end(df: DataFrame, keys: Sequence[str], at: str, then: Column, share: float, out: str) -> DataFrame:
    """(keys, ``out``): a key's last row that meets ``then`` at or after ``share`` of its last time; none: no row."""
    ends = df.groupBy(*keys).agg(F.max(at).alias("__z"))
    return df.join(ends, list(keys)).filter(then & (F.col(at) >= F.col("__z") * share)).groupBy(*keys).agg(F.max(at).alias(out))
