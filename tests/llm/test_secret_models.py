import random
import time

import pytest
from pyspark.sql import functions as F

WORDS = "journal jungle kitchen kernel ladder lantern machine mirror napkin number orange outline pencil picture quartz question ribbon river saddle silver table timber umbrella union velvet village window winter yellow yoghurt zebra zipper".split()


@pytest.fixture(scope="module")
def model(spark):
    from spanloom.llm.secrets import labelled_samples, train

    return train(labelled_samples(spark))


def test_precision_and_recall_on_held_out_samples(spark, model):
    from spanloom.llm.secrets import LEAST_RATIO, labelled_samples

    held = labelled_samples(spark, 4000, "held").filter("length(token) >= 20").withColumn("said", (model.score(F.col("token")) >= LEAST_RATIO).cast("int"))
    n = {(r["label"], r["said"]): r["count"] for r in held.groupBy("label", "said").count().collect()}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) >= 0.97
    assert n[1, 1] / (n[1, 1] + n.get((0, 1), 0)) >= 0.99


def test_identifiers_and_paths_of_other_words_are_left_alone(spark, model):
    from spanloom.llm.secrets import find_secrets

    rng, rows = random.Random(6), []
    for k in range(1200):
        w = [rng.choice(WORDS) for _ in range(rng.randrange(3, 6))]
        rows.append((k, ["_".join(w), "".join(map(str.title, w)), "/home/" + "/".join(w), "-".join(w), w[0] + "".join(map(str.title, w[1:]))][k % 5]))
    secret = [(2000 + k, "x " + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(32))) for k in range(300)]
    got = find_secrets(spark.createDataFrame(rows + secret, "doc_id long, text string"), model).filter("spans <> ''")
    assert got.filter("doc_id < 2000").count() <= 12 and got.filter("doc_id >= 2000").count() >= 297


def test_time_follows_a_text_s_matches(spark, model):
    from spanloom.llm.secrets import find_secrets

    words = " ".join(["deadbeef cafe added token=abcdefgh " + "0123456789abcdef01234567"] * 4000)  # 4,000 matches of two kinds, 20,000 words
    df = spark.createDataFrame([(1, words)], "doc_id long, text string")
    find_secrets(df.limit(0), model).collect()
    began = time.time()
    row = find_secrets(df, model).first()
    assert (row["n_assign"], row["n_hex"]) == (4000, 4000) and time.time() - began < 20
