"""Runs of named stages, codes put in words, and running sums by either way."""

import pytest
from pyspark.sql import functions as F

from spanloom.functions import text as tx
from spanloom.operators import running as rn, sequence as seq
from spanloom.operators.stages import run_stages


def test_stages_run_where_they_are_told_to(spark, tmp_path):
    folder, ran = f"file://{tmp_path}/s", []

    def stage(name, fail=()):
        def make(df):
            ran.append(name)
            if name in fail:
                raise RuntimeError("broken")
            return df.withColumn(name, F.lit(len(ran)))

        return name, make

    start = spark.range(3)
    stages = [stage("a"), stage("b"), stage("c")]
    rows, done = run_stages(stages, start, folder, through="b")
    assert done == {"a": "ran", "b": "ran", "c": "after"} and rows.columns == ["id", "a", "b"]
    with pytest.raises(RuntimeError):
        run_stages([*stages[:2], stage("c", "c")], start, folder)
    rows, done = run_stages(stages, start, folder)
    assert done == {"a": "there", "b": "there", "c": "ran"} and rows.count() == 3
    assert run_stages(stages, start, folder, first="c")[1] == {"a": "before", "b": "before", "c": "there"}
    assert run_stages(stages, start, folder, force=["b"])[1] == {"a": "there", "b": "ran", "c": "ran"}
    assert run_stages(stages, start, folder, first="b", force=True)[1] == {"a": "before", "b": "ran", "c": "ran"}
    assert ran == ["a", "b", "c", "c", "b", "c", "b", "c"]
    with pytest.raises(FileNotFoundError):
        run_stages(stages, start, f"{folder}2", first="b")
    for wrong in ({"first": "x"}, {"through": "x"}, {"force": ["x"]}, {"first": "c", "through": "a"}):
        with pytest.raises(ValueError):
            run_stages(stages, start, folder, **wrong)


def test_an_unknown_code_is_an_error(spark):
    df = spark.createDataFrame([("a",), (None,)], "x string")
    assert [r[0] for r in df.select(tx.in_words(F.col("x"), {"a": "one", "b": "two"})).collect()] == ["one", None]
    with pytest.raises(Exception, match="unknown cue: c"):
        spark.createDataFrame([("c",)], "x string").select(tx.in_words(F.col("x"), {"a": "one"}, "cue")).collect()


def test_running_sums_by_ranges_and_by_one_window(spark, monkeypatch):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("t"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("n"))
    got = []
    for few in (0, 1 << 20):
        monkeypatch.setattr(rn, "FEW", few)
        got += [sorted(map(tuple, rn.running(df, "t", {"s": "n"}, descending=d).collect())) for d in (False, True)]
    assert got[0] == got[2] and got[1] == got[3] and got[0] != got[1]


def test_tables_side_by_side(spark):
    a, b = spark.createDataFrame([(k % 3, k) for k in range(20)], "x int, a long").repartition(4), spark.createDataFrame([(-k, k) for k in range(13)], "y long, b long").repartition(3)
    got = [tuple(r) for r in rn.zip_rows(a, ["x", "a"], b, ["y"], "at").orderBy("at").select("at", "a", "b").collect()]
    left, right = sorted(range(20), key=lambda k: (k % 3, k)), list(range(12, -1, -1))
    assert got == [(k, left[k], right[k] if k < 13 else None) for k in range(20)]


def test_only_sure_groups_are_cut(spark):
    df = spark.createDataFrame([(k, t, t % 2 == 1, k == 1) for k in (1, 2) for t in range(4)] + [(3, 0, True, None)], "k int, t int, hit boolean, sure boolean")
    got = {(r["k"], r["t"]): r["part"] for r in seq.split_on_mentions(df, ["k"], ["t"], "hit", confident=F.col("sure")).collect()}
    assert [got[1, t] for t in range(4)] == [1, 2, 3, 4] and {got[2, t] for t in range(4)} | {got[3, 0]} == {1}
