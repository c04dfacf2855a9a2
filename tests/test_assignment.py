import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.operators import annotate, assign


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


@pytest.fixture(scope="module")
def season(spark):
    """Two voices, three runs: one clean, one with a change of voice in its middle, one too short."""
    rng = np.random.default_rng(0)
    centres = {"A": rng.normal(size=16), "B": rng.normal(size=16)}
    made = []
    for k, (run, voice, dur, named) in enumerate([(1, "A", 3.0, []), (1, "A", 3.0, []), (2, "A", 3.0, []), (2, "B", 3.0, ["B"]), (2, "B", 0.5, []), (3, "B", 1.5, [])]):
        v = centres[voice] + 0.05 * rng.normal(size=16)
        made.append((k, run, (v / np.linalg.norm(v)).tolist(), dur, named))
    items = spark.createDataFrame(made, "id long, run int, v array<double>, dur double, named array<string>")
    labelled = spark.createDataFrame([(n, 1, c.tolist(), 4.0) for n, c in centres.items()], "label string, episode int, v array<double>, dur double")
    return items, assign.build_profiles(labelled, ["label"], "v", 1)


def test_runs_are_cut_pooled_and_decided(season):
    items, profiles = season
    got = assign.assign(items, profiles, "id", "run", ["id"], "v", "dur", "label")
    assert rows(got.select("run", "part", "label", "decision", "n")) == [(1, 0, "A", "auto", 2), (2, 0, "A", "auto", 1), (2, 1, "B", "name_mentioned", 2), (3, 0, "B", "too_short", 1)]


def test_items_without_vectors(spark, season):
    items, profiles = season
    got = assign.assign(items.withColumn("v", F.when(F.col("run") != 3, F.col("v"))), profiles, "id", "run", ["id"], "v", "dur", "label")
    assert rows(got.filter("run = 3").select("label", "decision", "secs")) == [(None, "no_vector", 1.5)]


def test_recency(spark):
    df = spark.createDataFrame([(4, 2.0), (1, 2.0), (9, 2.0)], "e int, d double")
    got = [r[0] for r in df.select(F.round(assign.recency_weight(F.lit(4), F.col("e"), F.col("d")), 4)).collect()]
    assert got == [2.0, 1.0, 2.0]


def test_undo_takes_the_newest_entry(spark):
    now = spark.createDataFrame([(1, "z"), (2, "z"), (3, "z")], "k long, label string")
    log = spark.createDataFrame([(1, '{"k":1,"label":"a"}', 1), (1, '{"k":1,"label":"b"}', 2)], "k long, previous string, at int")
    assert rows(assign.undo(now, log, "k", "k long, label string")) == [(1, "b"), (2, "z"), (3, "z")]


def test_missing_times_are_shared_by_length(spark):
    words = spark.createDataFrame([(1, 0, "ab", 0.0, 1.0), (1, 1, "abc", None, None), (1, 2, "a", None, None), (1, 3, "x", 4.0, 5.0)], "g int, i int, w string, s double, e double")
    got = annotate.fill_missing_times(words, ["g"], "i", "s", "e", F.length("w"))
    assert [(r["s"], r["e"]) for r in got.orderBy("i").collect()] == [(0.0, 1.0), (1.0, 3.0), (3.0, 4.0), (4.0, 5.0)]


def test_cuts_and_the_nearest(spark):
    words = spark.createDataFrame([("u", k, k * 1.0, k + 0.8) for k in range(5)], "id string, i int, s double, e double")
    cuts = annotate.candidate_cuts(words, ["id"], "i", "s", "e", F.lit(0.0), F.lit(4.8), 1.0)
    assert [(round(r["cut"], 3), r["after"]) for r in cuts.orderBy("cut").collect()] == [(1.9, 2), (2.9, 3)]
    wanted = spark.createDataFrame([("u", 2.6)], "id string, at double")
    assert rows(annotate.nearest_cut(cuts, wanted, ["id"], "at").select("after")) == [(3,)]


def test_lag_is_found(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=200)
    df = spark.createDataFrame([(1, np.roll(x, 7).tolist(), x.tolist())], "k int, a array<double>, b array<double>")
    r = annotate.lag_of_signals(df, "k", "a", "b", 20).first()
    assert r["lag"] == 7 and r["score"] > 5


def test_pairs_have_the_right_labels(spark):
    items = spark.createDataFrame([(k, k % 3, k % 2) for k in range(40)], "id long, label int, season int")
    got = annotate.sample_pairs(items, "id", "label", "season", 5).collect()
    assert all((r["a"] % 3 == r["b"] % 3) == bool(r["target"]) for r in got) and {r["target"] for r in got} == {0, 1}
    assert all(r["a"] % 2 == r["b"] % 2 for r in got if not r["target"])
