"""Words without end: valued in windows, with the same sums as character by character."""

import random
import time

import numpy as np
from pyspark.sql import functions as F


def model(seed, languages=3):
    from spanloom.llm.langid import UNKNOWN, Lattice

    rng = np.random.default_rng(seed)
    draw = random.Random(seed)
    alphabet = "abcdefg漢字語文é▁"
    pieces = sorted({"".join(draw.choices(alphabet, k=draw.randint(1, 7))) for _ in range(300)})
    p = rng.dirichlet(np.ones(len(pieces) + 2), languages).T
    p[0], p[1] = 0, UNKNOWN
    return Lattice(pieces), p, alphabet + "xyz"


def test_windows_give_the_same_sums():
    from spanloom.llm.langid import WINDOW

    for seed, n in enumerate([1, 2, WINDOW - 1, WINDOW, WINDOW + 1, 3 * WINDOW, 777, 2 * 512 * WINDOW + 5]):
        lattice, p, alphabet = model(seed)
        word = "".join(random.Random(seed).choices(alphabet, k=n))
        assert np.allclose(lattice.forward([word], n, p)[0], lattice.forward_long(word, p), rtol=1e-9)


def test_all_runs_are_looked_up():
    lattice, _, alphabet = model(9)
    word = "".join(random.Random(9).choices(alphabet, k=500))
    found = lattice._pieces_in(word)
    for end in range(1, 501):
        for length in range(1, min(lattice.longest, end) + 1):
            assert found[length - 1, end - 1] == lattice.number.get(word[end - length : end], 1 if length == 1 else 0)


def test_a_megabyte_without_a_space(spark):
    from spanloom.llm.langid import identify

    rng = random.Random(4)
    text = "".join(rng.choices("的一是不了人我在有他这为之大来以个中上们", k=350_000))
    rows = [(k, "the cat sat on the mat and the dog", "en") for k in range(40)] + [(100 + k, "".join(rng.choices("的一是不了人我在有他这为", k=40)), "zh") for k in range(40)] + [(1000, text, None)]
    began = time.time()
    got = {r["doc_id"]: r for r in identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[1000]["lang_pred"] == "zh" and got[0]["lang_pred"] == "en"
    assert time.time() - began < 90


def test_rows_without_an_id_dont_fill_the_sample(spark):
    from spanloom.llm.langid import train, vocabulary

    rows = [(None, f"one two three {k}", "en") for k in range(3000)] + [(None, "one two", "en")] * 1000 + [(k, "uno dos tres", "es") for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    import spanloom.llm.langid as module

    kept = module.stored

    def spy(df, label):
        out = kept(df, label)
        if label == "langwords":
            seen.append(out.filter("word = 'one'").agg({"n": "sum"}).first()[0] or 0)
        return out

    module.stored = spy
    try:
        train(docs, lambda c: F.coalesce(c == -1, F.lit(False)), vocabulary(), sample_docs=200)
    finally:
        module.stored = kept
    assert 0 < seen[0] <= 800
