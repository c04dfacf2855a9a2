"""Rules whose state starts afresh at some rows, over keys that are too long for one task.

The rows of a key, in order, are cut into stretches. Where a rule starts afresh, what follows depends on that row alone; so a stretch is told
by the rows at which a state from before could first break, each with the state that it leaves at the stretch's end. Only these summaries
are gone through in order, a key at a time; then every stretch knows the state it begins with, and all of them are worked on at once.
"""

from __future__ import annotations

import pickle
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.sources.files import private_folder

#: Rows of a stretch, which a task holds together.
STRETCH = 20_000
#: A key with more rows than this is cut.
LONG_KEY = 500_000


class Rule:
    """A state begins with a row, takes in rows, and ends before a row that breaks it; a row is the tuple of its values."""

    def fresh(self, row: tuple) -> tuple:
        """The state that begins with a row."""
        raise NotImplementedError

    def step(self, state: tuple, row: tuple) -> tuple | None:
        """The state after a row that it takes in; None if the row breaks it."""
        raise NotImplementedError

    def breakers(self, rows: list[tuple]) -> list[int]:
        """The rows of a stretch that can be the first to break a state from before, and all that change such a state until then."""
        return list(range(len(rows)))

    def next(self, rows: list[tuple], at: int) -> tuple[int | None, tuple]:
        """The row that breaks the state which begins with row ``at``, if any, and that state at the last row it takes in."""
        state = self.fresh(rows[at])
        for k in range(at + 1, len(rows)):
            after = self.step(state, rows[k])
            if after is None:
                return k, state
            state = after
        return None, state


class Anchored(Rule):
    """Rows (time, ...) within a horizon of the first one; the anchor doesn't move."""

    def __init__(self, horizon: float):
        self.horizon = horizon

    def fresh(self, row: tuple) -> tuple:
        return (row[0],)

    def step(self, state: tuple, row: tuple) -> tuple | None:
        return state if row[0] - state[0] <= self.horizon else None

    def breakers(self, rows: list[tuple]) -> list[int]:
        times = [r[0] for r in rows]
        if any(a > b for a, b in zip(times, times[1:], strict=False)):
            return list(range(len(rows)))
        return list(range(min(len(rows), bisect_right(times, times[0] + self.horizon) + 1)))

    def next(self, rows: list[tuple], at: int) -> tuple[int | None, tuple]:
        end = bisect_right(rows, rows[at][0] + self.horizon, lo=at, key=lambda r: r[0]) if self.ascending(rows) else None
        if end is None:
            return super().next(rows, at)
        return (end if end < len(rows) else None), self.fresh(rows[at])

    def ascending(self, rows: list[tuple]) -> bool:
        if getattr(self, "_of", None) is not rows:
            self._of, self._ascending = rows, all(a[0] <= b[0] for a, b in zip(rows, rows[1:], strict=False))
        return self._ascending


class Capped(Rule):
    """Rows (start, end, ...) whose gap to the unit's end lies in [low, high] while the unit gets no longer than a cap."""

    def __init__(self, low: float, high: float, cap: float):
        self.low, self.high, self.cap = low, high, cap

    def fresh(self, row: tuple) -> tuple:
        return row[0], row[1]

    def step(self, state: tuple, row: tuple) -> tuple | None:
        start, end = state
        joins = self.low <= row[0] - end <= self.high and row[1] - start <= self.cap
        return (start, max(end, row[1])) if joins else None

    def breakers(self, rows: list[tuple]) -> list[int]:
        if any(r[1] < r[0] for r in rows) or any(a[0] > b[0] for a, b in zip(rows, rows[1:], strict=False)):
            return list(range(len(rows)))
        return list(range(min(len(rows), bisect_right(rows, rows[0][0] + self.cap, key=lambda r: r[0]) + 1)))


class Changed(Rule):
    """Rows (value, ...) less than ``least`` away from the value the state began with."""

    def __init__(self, least: float):
        self.least = least

    def fresh(self, row: tuple) -> tuple:
        return (row[0],)

    def step(self, state: tuple, row: tuple) -> tuple | None:
        return None if abs(row[0] - state[0]) >= self.least else state

    def breakers(self, rows: list[tuple]) -> list[int]:
        """Whatever the value before, the first row far enough from it is the greatest or the least so far."""
        found, low, high = [], None, None
        for k, row in enumerate(rows):
            if low is None or row[0] < low or row[0] > high:
                found.append(k)
                low, high = (row[0], row[0]) if low is None else (min(low, row[0]), max(high, row[0]))
        return found


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one stretch after the other, from rows sorted by ``__c``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        at, begin = batch.column("__c").to_pylist(), 0
        while begin < len(at):
            end = bisect_right(at, at[begin], lo=begin)
            if held and held[0].column("__c")[0].as_py() != at[begin]:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(begin, end - begin))
            begin = end
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _tuples(table: pa.Table | pa.RecordBatch, columns: Sequence[str]) -> list[tuple]:
    return list(zip(*(table.column(c).to_pylist() for c in columns), strict=True))


def long_keys(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a key has more rows than one task should go through."""
    return not df.groupBy(*keys).count().filter(F.col("count") > LONG_KEY).isEmpty()


def units(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], rule: Rule) -> DataFrame:
    """``df`` with ``__at``, a row's place in its key's order, ``__unit``, the place at which its state began, and ``__first``, whether that is here.

    ``values`` may not be null. Rows equal in keys and order stay in an arbitrary but settled order.
    """
    spark, keys, values, columns = df.sparkSession, list(keys), list(values), df.columns
    kinds = lambda names: ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stretch, number, last = TaskContext.get().partitionId(), -1, 0, None
        for batch in batches:
            own, at = [], []
            for key in _tuples(batch, keys):
                if key != last or number == STRETCH:
                    stretch, number, last = stretch + 1, 0, key
                own.append((part << 24) + stretch)
                at.append((((part << 24) + stretch) << 20) + number)
                number += 1
            yield pa.record_batch([pa.array(own, pa.int64()), pa.array(at, pa.int64()), *batch.columns], names=["__c", "__at", *columns])

    path = private_folder(spark, "stretches")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *keys, *order).sortWithinPartitions(*keys, *order)
    ranged.mapInArrow(cut, f"__c long, __at long, {kinds(columns)}").write.parquet(path)  # stored, so that both passes see the same stretches
    rows = spark.read.parquet(path)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _stretches(batches):
            own, places = _tuples(table, values), table.column("__at").to_pylist()
            at, left = rule.breakers(own), {}
            for k in reversed(at):
                chain, now, end = [], k, None
                while now is not None and now not in left:
                    chain.append(now)
                    begun = now
                    now, state = rule.next(own, now)
                    end = places[begun], state
                left.update(dict.fromkeys(chain, left[now] if now is not None else end))
            told = pa.array([pickle.dumps((own[k], left[k])) for k in at], pa.binary())
            yield table.select(["__c", "__at", *keys]).take(pa.array(at)).append_column("__told", told).combine_chunks().to_batches()[0]

    told = rows.select("__c", "__at", *keys, *values).repartition("__c").sortWithinPartitions("__c", "__at").mapInArrow(summed, f"__c long, __at long, {kinds(keys)}, __told binary")

    def entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The state that each stretch begins with, and where that began; none for a key's first."""
        key = stretch = done = state = None
        for batch in batches:
            at, states = [], []
            for *now, c, packed in _tuples(batch, [*keys, "__c", "__told"]):
                if now != key:
                    key, stretch, done, state = now, None, None, None
                if c == done:
                    continue
                if c != stretch:
                    stretch = c
                    at.append(c)
                    states.append(pickle.dumps(state))
                row, left = pickle.loads(packed)
                after = rule.step(state[1], row) if state else None
                state, done = (left, c) if after is None else ((state[0], after), None)
            yield pa.record_batch({"__c": pa.array(at, pa.int64()), "__state": pa.array(states, pa.binary())})

    states = told.repartition(*keys).sortWithinPartitions(*keys, "__at").mapInArrow(entered, "__c long, __state binary")

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _stretches(batches):
            unit, state = pickle.loads(table.column("__state")[0].as_py()) or (None, None)
            own = table.slice(1)
            begun, first = [], []
            for place, row in zip(own.column("__at").to_pylist(), _tuples(own, values), strict=True):
                after = rule.step(state, row) if state is not None else None
                first.append(after is None)
                unit, state = (place, rule.fresh(row)) if after is None else (unit, after)
                begun.append(unit)
            done = own.drop_columns(["__c", "__state"]).append_column("__unit", pa.array(begun, pa.int64())).append_column("__first", pa.array(first, pa.bool_()))
            yield from done.combine_chunks().to_batches()

    # a stretch's state goes before its rows
    both = rows.unionByName(states.withColumn("__at", F.lit(-1).cast("long")), allowMissingColumns=True)
    return both.repartition("__c").sortWithinPartitions("__c", "__at").mapInArrow(marked, f"__at long, {kinds(columns)}, __unit long, __first boolean")
