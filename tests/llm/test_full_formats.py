"""Formats with few values, the key's secrecy, rows alike in great numbers, and what stays in the shared folder."""

import hashlib
import os
import re

from pyspark.sql import functions as F

KEY = "a very secret key of some length"


def test_a_format_with_too_few_values_gets_longer(spark):
    from spanloom.llm.pii import replace_personal_data

    numbers = [f"+49 {k // 100:02d} {k % 100:02d}" for k in range(2000, 8000)]
    docs = spark.createDataFrame([(k, f"call {n} now") for k, n in enumerate(numbers)] + [(k + 10_000, f"or {n}.") for k, n in enumerate(numbers[::7])], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in replace_personal_data(docs, KEY).collect()}
    made = [re.fullmatch(r"call (\+49 [0-9]{2} [0-9]{2,8}) now", got[k])[1] for k in range(6000)]
    assert len(set(made)) == 6000 and not set(made) & set(numbers)
    assert sum(len(m) == 9 for m in made) > 1000
    assert all(got[k + 10_000] == f"or {made[7 * k]}." for k in range(len(numbers[::7])))


def test_the_key_is_in_no_plan(spark):
    from spanloom.llm.pii import _BLOCK, replace_personal_data

    docs = spark.createDataFrame([(1, "Mr. John Smith, j.smith@example.com, 212-555-0175"), (2, "Dr. Ann Smith")], "doc_id long, text string")
    found = replace_personal_data(docs, KEY)
    plan = found._jdf.queryExecution().toString() + found._jdf.queryExecution().logical().treeString()
    raw = KEY.encode().ljust(_BLOCK, b"\0")
    pads = [bytes(x ^ y for x in raw) for y in (0x36, 0x5C)]
    for secret in (KEY, KEY.encode().hex(), *(p.hex() for p in pads), *(p.hex().upper() for p in pads), pads[0].decode("latin-1")):
        assert secret not in plan
    assert found.collect() == replace_personal_data(docs, KEY).collect() != replace_personal_data(docs, KEY + "!").collect()


def test_seeds_are_hmacs(spark):
    import hmac

    from spanloom.llm.pii import _seed, key_table

    for key in (KEY, "k" * 100):
        got = spark.range(1).crossJoin(key_table(spark, key)).select(_seed(F.lit("email|a@b.c"), F.lit(3), F.col("__key"))).first()[0]
        assert got == hmac.new(key.encode(), b"email|a@b.c|3", hashlib.sha256).hexdigest()


def test_nothing_is_left_behind(spark):
    from spanloom.llm.common import scratch, shared_folder
    from spanloom.llm.pii import replace_personal_data

    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with scratch(spark):
        docs = spark.createDataFrame([(1, "Mr. John Smith, j.smith@example.com")], "doc_id long, text string")
        assert replace_personal_data(docs, KEY).count() == 1
        assert set(os.listdir(folder)) - before
    assert set(os.listdir(folder)) == before


def test_very_many_rows_alike_are_numbered_in_blocks(spark, monkeypatch):
    from spanloom.llm import mixing

    monkeypatch.setattr(mixing, "ALIKE", 1000)
    alike = spark.createDataFrame([(None, "a", 0, 25_500), (1, "a", 5, 3), (2, None, 4, 1000), (3, "b", 1, 1001)], "doc_id long, source string, size long, n long")
    got = mixing._numbered(alike)
    assert {(r["doc_id"], r["n"]) for r in got.groupBy("doc_id", "source", "size").agg(F.count_distinct("nth").alias("n"), F.max("nth").alias("m"), F.min("nth").alias("l")).filter("l = 1 and m = n").collect()} == {(None, 25_500), (1, 3), (2, 1000), (3, 1001)}
    assert got.count() == 25_500 + 3 + 1000 + 1001


def test_ten_million_rows_alike(spark):
    from spanloom.llm import mixing

    alike = spark.createDataFrame([(None, "a", 0, 10_000_000)], "doc_id long, source string, size long, n long")
    tasks = mixing._numbered(alike).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert sum(r["count"] for r in tasks) == 10_000_000 and len(tasks) > 1
