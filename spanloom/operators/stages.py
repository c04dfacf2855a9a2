"""Named stages in order, each stored: runs that begin and end where they are told to, skip what is there and make again what is forced."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence

from pyspark.sql import DataFrame

Stage = tuple[str, Callable[[DataFrame], DataFrame]]


def is_stored(df: DataFrame, path: str) -> bool:
    """Whether a stage's rows were written to the end: Spark leaves a mark in a folder once all its files are in place."""
    spark = df.sparkSession
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def run_stages(stages: Sequence[Stage], start: DataFrame, folder: str, first: str | None = None, through: str | None = None, force: bool | Collection[str] = False) -> tuple[DataFrame, dict[str, str]]:
    """(rows of the last stage that was asked for, what became of each stage: ran, there, before or after).

    Stages run from ``first`` to ``through``, by default from the first to the last. Each reads what the one before it stored under ``folder``; a
    stage that is stored is taken as it is, unless it is forced (True: all that are asked for) or one before it ran in this run. What comes before ``first``
    must be there. A stage that fails leaves nothing that counts as stored, so the next run makes it again.
    """
    names = [name for name, _ in stages]
    if len(set(names)) < len(names):
        raise ValueError("stages must have names of their own")
    for name in (first, through, *(force if not isinstance(force, bool) else ())):
        if name is not None and name not in names:
            raise ValueError(f"no stage is called {name}")
    low, high = names.index(first) if first else 0, names.index(through) if through else len(names) - 1
    if low > high:
        raise ValueError(f"{first} comes after {through}")
    done: dict[str, str] = {}
    rows, fresh = start, False
    for number, (name, make) in enumerate(stages):
        path = f"{folder}/{number:02d}-{name}"
        if number > high:
            done[name] = "after"
            continue
        there = is_stored(start, path)
        if number < low and not there:
            raise FileNotFoundError(f"{name} comes before {first} and isn't stored")
        forced = number >= low and (force is True or (not isinstance(force, bool) and name in force))
        if number >= low and (fresh or forced or not there):
            make(rows).write.mode("overwrite").parquet(path)
            fresh = True
            done[name] = "ran"
        else:
            done[name] = "before" if number < low else "there"
        rows = start.sparkSession.read.parquet(path)
    return rows, done
