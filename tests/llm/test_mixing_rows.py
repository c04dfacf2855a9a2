import random

import pytest
from pyspark.sql import functions as F


def _rows(kind):
    rng = random.Random(8)
    rows = [[k, "w " * int(rng.lognormvariate(4, 1)), "abc"[k % 3]] for k in range(900)]
    if kind == "doubled":  # every id twice, with 10 and with 510 words, in any source
        return [(k, "w " * n, "abc"[(k + n) % 3]) for k in range(450) for n in (10, 510)]
    if kind == "null ids":
        return [(None if k < 400 else k, t, "a" if k < 400 else s) for k, t, s in rows]
    return [(1, "w " * 7, "a")] * 500 + [(k, t, s) for k, t, s in rows if s != "a"]  # one row 500 times


@pytest.mark.parametrize("kind", ["doubled", "null ids", "repeated"])
def test_every_row_is_rounded_by_itself(spark, kind):
    from spanloom.llm.mixing import mix

    df = spark.createDataFrame(_rows(kind), "doc_id long, text string, source string")
    got = mix(df.repartition(3)).cache()
    assert got.count() == df.count()
    for r in got.groupBy("target").agg(F.sum("taken").alias("t")).collect():
        assert abs(r["t"] - r["target"]) <= 0.05 * r["target"]
    key = lambda rows: sorted(map(tuple, rows), key=str)
    assert key(got.collect()) == key(mix(df.orderBy(F.rand(1)).repartition(7)).collect())
