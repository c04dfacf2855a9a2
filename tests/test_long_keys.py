"""Folds over keys that many tasks work on: the same rows as one task's."""

import random

import pytest
from pyspark.sql import functions as F

from spanloom.operators import chained, sequence as seq


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def cut_small(monkeypatch):
    def cut(stretch):
        monkeypatch.setattr(chained, "LONG_KEY", 0)
        monkeypatch.setattr(chained, "STRETCH", stretch)

    return cut


def both(spark, monkeypatch, build, stretch):
    monkeypatch.setattr(chained, "LONG_KEY", 1 << 40)
    want = rows(build())
    monkeypatch.setattr(chained, "LONG_KEY", 0)
    monkeypatch.setattr(chained, "STRETCH", stretch)
    assert rows(build()) == want
    return want


@pytest.mark.parametrize(("stretch", "dense"), [(7, 60), (50, 3)])
def test_same_rows_as_the_fold(spark, monkeypatch, stretch, dense):
    rng = random.Random(stretch * dense)
    data = []
    for key in ("a", "b", None, "hot"):
        t = 0
        for k in range(400 if key == "hot" else rng.randrange(1, 40)):
            t += rng.choice([0, 0, 1, 2, 3, rng.randrange(40)]) * 10 // dense
            data.append((key, t, k, t + rng.randrange(0, 9), rng.choice([None, rng.random()]), rng.choice([None, round(rng.gauss(0, 3), 2)])))
    df = spark.createDataFrame(data, "k string, t long, i long, e long, s double, v double").repartition(5)
    assert both(spark, monkeypatch, lambda: seq.dedupe_anchored(df, ["k"], ["t", "i"], "t", "s", 11), stretch)
    assert both(spark, monkeypatch, lambda: seq.merge_capped(df, ["k"], ["t", "i"], "t", "e", -5, 4, 30), stretch)
    assert both(spark, monkeypatch, lambda: seq.changes_only(df, ["k"], ["t", "i"], "v", 2.5), stretch)
    # ends before starts, and an order that isn't the times'
    assert both(spark, monkeypatch, lambda: seq.merge_capped(df.withColumn("e", F.col("e") - 6), ["k"], ["i"], "t", "e", -9, 4, 30), stretch)
    assert both(spark, monkeypatch, lambda: seq.dedupe_anchored(df.withColumn("t", F.col("t") % 50), ["k"], ["i"], "t", "s", 11), stretch)


def test_one_key_of_a_million_rows_is_many_tasks_work(spark):
    n = 1_000_000
    df = spark.range(n).select(F.lit(1).alias("k"), (F.col("id") * 3 + F.pmod(F.xxhash64("id"), F.lit(3))).alias("t"), F.lit(0.5).alias("s"))
    assert chained.long_keys(df, ["k"])
    got = seq.dedupe_anchored(df, ["k"], ["t"], "t", "s", 500)
    marked = chained.units(df, ["k"], ["t"], ["t"], chained.Anchored(500))
    tasks = marked.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < 0.9 * n
    assert got.agg(F.sum("n")).first()[0] == n
    times = sorted(r["t"] for r in df.select("t").collect())
    anchors, last = [], None
    for t in times:
        if last is None or t - last > 500:
            anchors.append(t)
            last = t
    assert sorted(r["at"] for r in got.select("at").collect()) == anchors


def test_nothing_comes_of_nothing(spark, cut_small):
    cut_small(5)
    empty = spark.createDataFrame([], "k string, t long, s double")
    assert rows(seq.dedupe_anchored(empty, ["k"], ["t"], "t", "s", 5)) == []
    assert rows(chained.units(empty, ["k"], ["t"], ["t"], chained.Anchored(5))) == []
