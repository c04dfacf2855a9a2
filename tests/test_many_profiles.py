"""Ranking by more profiles than go to every task: the same rows, in blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.operators import vector as vec


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def table(spark, rng, n, dims, name):
    return spark.createDataFrame([(k, f"l{k % max(1, n // 3):03d}", [float(round(x, 2)) for x in rng.normal(size=dims)], int(k % 5)) for k in range(n)], f"{name} long, label string, v array<double>, ep int")


@pytest.fixture
def data(spark):
    rng = np.random.default_rng(3)
    return table(spark, rng, 120, 6, "id"), table(spark, rng, 90, 6, "pid")


def in_blocks(monkeypatch, build):
    want = rows(build())
    monkeypatch.setattr(vec, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(vec, "SLICE_ITEMS", 40)
    monkeypatch.setattr(vec, "SCORES", 50)
    assert rows(build()) == want
    return want


def test_profiles(data, monkeypatch):
    items, table = data
    assert len(in_blocks(monkeypatch, lambda: vec.rank_profiles(items, "id", "v", table, "pid", "v", 4))) == 480


def test_exemplars_and_blends(data, monkeypatch):
    items, table = data
    whole = vec.profiles(table, ["label"], "v").select("label", "profile")
    assert in_blocks(monkeypatch, lambda: vec.rank_exemplars(items, "id", "v", table, "label", "v", whole, 5, "exemplar"))
    monkeypatch.undo()
    assert in_blocks(monkeypatch, lambda: vec.rank_exemplars(items, "id", "v", table, "label", "v", whole, 5, "blend"))


def test_profiles_of_periods(data, monkeypatch):
    items, table = data
    state = vec.rolling_profiles(table, ["label"], "ep", "v", F.lit(1.0))
    assert in_blocks(monkeypatch, lambda: vec.rolling_rank(items, "id", "ep", "v", state, "label", "profile", 2))


def test_leave_one_out(data, monkeypatch):
    items, _ = data
    alone = items.sparkSession.createDataFrame([(999, "alone", [1.0, 0.0, 0.0, 0.0, 0.0, 0.0], 1), (998, None, [1.0] * 6, 1)], items.schema)
    assert len(in_blocks(monkeypatch, lambda: vec.leave_one_out(items.unionByName(alone), "id", "label", "v"))) == 121


def test_ties_go_to_the_least_label(spark, monkeypatch):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None)], "id long, v array<double>")
    table = spark.createDataFrame([(k, [1.0, float(k % 2)]) for k in range(200)], "pid long, v array<double>")
    assert in_blocks(monkeypatch, lambda: vec.rank_profiles(items, "id", "v", table, "pid", "v", 3)) == sorted([(1, r, p, 1.0) for r, p in ((1, 0), (2, 1), (3, 2))] * 2)


def test_a_million_profiles(spark):
    items = spark.range(20).select("id", F.array(*(F.rand(k) for k in range(10))).alias("v"))
    items = spark.createDataFrame(items.collect(), items.schema)
    table = spark.range(1_000_000).select(F.col("id").alias("pid"), F.transform(F.sequence(F.lit(1), F.lit(10)), lambda i: F.pmod(F.xxhash64("id", i), F.lit(1000)) / 1000.0).alias("v"))
    assert vec._blocks_of(table, "v") > 1
    got = {(r["id"], r["rank_no"]): r["score"] for r in vec.rank_profiles(items, "id", "v", table, "pid", "v", 2).collect()}
    matrix = np.array([r["v"] for r in table.orderBy("pid").select("v").toLocalIterator()])
    for r in items.collect():
        best = np.sort(np.round(matrix @ np.array(r["v"]), 6))[::-1]
        assert [got[r["id"], 1], got[r["id"], 2]] == pytest.approx(best[:2].tolist())
