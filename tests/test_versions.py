"""Snapshots that are checked, and streams of corrections that may be stopped anywhere."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from spanloom.sources import snapshots as sn
from spanloom.streaming import corrections as co


def test_damage_is_told(spark, tmp_path):
    folder = f"file://{tmp_path}/s"
    df = spark.range(100).select("id", F.create_map(F.lit("a"), F.col("id")).alias("m"), F.array("id").alias("l")).repartition(3)
    assert sn.versions(spark, folder) == [] and sn.current(spark, folder) is None
    with pytest.raises(FileNotFoundError):
        sn.read_snapshot(spark, folder)
    for v in ("a", "b", "c"):
        sn.write_snapshot(df.filter(F.col("id") < {"a": 40, "b": 70, "c": 100}[v]), folder, v)
    with pytest.raises(ValueError, match="there already"):
        sn.write_snapshot(df, folder, "b")
    assert sn.versions(spark, folder) == ["a", "b", "c"] and sn.current(spark, folder) == "c"
    assert sn.read_snapshot(spark, folder).count() == 100 and sn.read_snapshot(spark, folder, "a").count() == 40
    files = sorted(glob.glob(f"{tmp_path}/s/b/data/part-*.parquet"))
    os.unlink(files[0])
    spark.range(5).select("id", F.create_map(F.lit("a"), F.col("id")).alias("m"), F.array("id").alias("l")).coalesce(1).write.mode("append").parquet(f"{folder}/b/data")
    # rows of another version under the name of a file
    other = sorted(glob.glob(f"{tmp_path}/s/a/data/part-*.parquet"))[0]
    os.replace(other, files[1])
    states = sorted(r["state"] for r in sn.check_snapshot(spark, folder, "b").collect())
    assert states == ["changed", "missing", "ok", "unknown"]
    with pytest.raises(ValueError, match="version b is damaged"):
        sn.read_snapshot(spark, folder, "b")
    assert sn.rotate(spark, folder, 1) == ["a", "b"] and sn.versions(spark, folder) == ["c"] and sn.rotate(spark, folder, 0) == []
    assert sn.read_snapshot(spark, folder).count() == 100


def test_an_empty_table_is_a_version(spark, tmp_path):
    folder = f"file://{tmp_path}/e"
    sn.write_snapshot(spark.createDataFrame([], "a int"), folder, "v1")
    assert sn.read_snapshot(spark, folder).count() == 0


DERIVED = "k long, version int, x int, tries int"


def arrived(spark, folder, *files):
    for rows in files:
        spark.createDataFrame(rows, "k long, version int, x int").coalesce(1).write.mode("append").parquet(f"{folder}/arrived")
    return spark.readStream.schema("k long, version int, x int").option("maxFilesPerTrigger", 1).parquet(f"{folder}/arrived")


def make(inputs, before):
    had = before.select("k", F.col("tries").alias("had"))
    return inputs.join(had, "k", "left").select("k", "version", F.col("x") * 10, (F.coalesce("had", F.lit(0)) + 1).alias("tries")).toDF("k", "version", "x", "tries")


FILES = [[(1, 1, 5), (2, 1, 6), (None, 1, 0)], [(1, 3, 7), (3, 1, 8)], [(1, 2, 9), (2, 2, 1), (2, 2, 1)]]
WANT = [(1, 3, 70, 2), (2, 2, 10, 2), (3, 1, 80, 1)]


def derived(spark, folder):
    return sorted(tuple(r) for r in co.derived_rows(spark, folder, "k", "version", DERIVED).select("k", "version", "x", "tries").collect())


def test_newest_versions_count_in_any_order(spark, tmp_path):
    for number, order in enumerate([(0, 1, 2), (2, 1, 0), (1, 0, 2)]):
        folder = f"file://{tmp_path}/n{number}"
        co.follow(arrived(spark, folder, *(FILES[k] for k in order)), folder, "k", "version", make, DERIVED)
        assert [r[:3] for r in derived(spark, folder)] == [r[:3] for r in WANT]
        if order == (0, 1, 2):
            assert derived(spark, folder) == WANT
        assert co.late_rows(spark, folder, "k").count() == 0


@pytest.mark.parametrize("stops", [[(0, "inputs")], [(1, "derived")], [(1, "inputs"), (1, "derived"), (2, "derived")]])
def test_a_stopped_run_goes_on(spark, tmp_path, stops):
    folder, left = f"file://{tmp_path}/r", list(stops)

    def each(number, step):
        if left and (number, step) == left[0]:
            left.pop(0)
            raise InterruptedError("stopped")

    stream = arrived(spark, folder, *FILES)
    for _ in stops:
        with pytest.raises(Exception, match="stopped"):
            co.follow(stream, folder, "k", "version", make, DERIVED, each)
    co.follow(stream, folder, "k", "version", make, DERIVED, each)
    assert not left and derived(spark, folder) == WANT


def test_one_retry_then_a_row(spark, tmp_path):
    tried = []

    def unsure(inputs, before):
        """Forgets 1 the first time, makes 2 of an old version always."""
        tried.append(sorted(r["k"] for r in inputs.collect()))
        kept = inputs if len(tried) > 1 else inputs.filter("k <> 1")
        return kept.withColumn("version", F.when(F.col("k") == 2, F.col("version") - 1).otherwise(F.col("version")))

    todo = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 1, 0)], "k long, version int, x int")
    made, late = co.made_with_retry(todo, todo.limit(0), "k", "version", unsure, f"file://{tmp_path}/t")
    assert tried == [[1, 2, 3], [1, 2]]
    assert sorted(tuple(r) for r in made.collect()) == [(1, 1, 0), (2, 0, 0), (3, 1, 0)]
    assert [tuple(r) for r in late.collect()] == [(2, "changed")]
