"""Matching blocks of differing texts, names in texts, profiles over very many periods."""

import random
import re
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from spanloom.operators import align, resolve as rs, vector as vec


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_blocks_are_those_of_a_slow_matcher(spark):
    rng = random.Random(3)
    pairs = []
    for k in range(80):
        a = [rng.choice("abcdefgh" if k % 2 else "ab") for _ in range(rng.randrange(0, 90))]
        b = list(a)
        for _ in range(rng.randrange(0, 12)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(0, 4)] = [rng.choice("abcxyz") for _ in range(rng.randrange(0, 4))]
        if k % 3 == 0:
            b = b[len(b) // 2 :] + b[: len(b) // 2]
        pairs.append((k, a, b))
    pairs += [(100, ["la"] * 60, ["la"] * 45), (101, [], ["a"] * 5), (102, None, ["a"] * 5), (103, ["a", "b", "c"], ["a", "b", "c"])]
    got = rows(rs.ordered_blocks(spark.createDataFrame(pairs, "k long, a array<string>, b array<string>"), "k", "a", "b"))
    want = sorted((k, x.a, x.b, x.size) for k, a, b in pairs if a is not None for x in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if x.size >= 3)
    assert got == want


def test_a_repeated_word_makes_as_many_rows_as_runs(spark):
    df = spark.createDataFrame([(1, ["la"] * 400, ["la"] * 400)], "k long, a array<string>, b array<string>")
    runs = align.common_runs(df, "k", "a", "b")
    assert runs.count() == 2 * 398 - 1 and runs.filter("n = 400").count() == 1
    assert "Python" not in runs._jdf.queryExecution().toString()


def test_names_in_any_script(spark):
    texts = ["Вчера Ольга пришла", "ОЛЬГА, ольга и Zoë", "zoë's Zoëy", "With Mary Ann and mary", "O'Mary or Mary-Ann; MARY ANN", "José-María y josé", None, "李小龍来了", "no one"]
    names = [("O", "Ольга"), ("Z", "Zoë"), ("M", "Mary"), ("M", "Mary Ann"), ("M", "Mary-Ann"), ("J", "José"), ("J", " "), ("J", None), ("L", "李小龍"), (None, "one"), ("N", "no one at all"), ("N", "no")]
    got = rows(rs.mentions(spark.createDataFrame(list(enumerate(texts)), "k long, t string"), "k", "t", spark.createDataFrame(names, "who string, name string"), "who", "name"))
    want = []
    for k, t in enumerate(texts):
        for who in sorted({w for w, _ in names if w}):
            own = sorted({n.strip().lower() for w, n in names if w == who and n and len(n.strip()) > 1}, key=len, reverse=True)
            n = len(re.findall(r"(?<![A-Za-z'])(?:" + "|".join(map(re.escape, own)) + r")(?![A-Za-z])", t or "", re.I))
            want += [(k, who, n)] * (n > 0)
    assert got == sorted(want)


@pytest.mark.parametrize("most", [100_000, 7])
def test_mentions_against_one_pattern_a_person(spark, monkeypatch, most):
    monkeypatch.setattr(rs, "PACK_NAMES", most)
    rng = random.Random(most)
    word = lambda: "".join(rng.choice("abé'") for _ in range(rng.randint(1, 3)))
    names = [(f"p{rng.randrange(12)}", " ".join(word() for _ in range(rng.randint(1, 2)))) for _ in range(40)]
    texts = [(k, "".join(rng.choice("abéA'. -") for _ in range(80))) for k in range(60)]
    got = rows(rs.mentions(spark.createDataFrame(texts, "k long, t string"), "k", "t", spark.createDataFrame(names, "who string, name string"), "who", "name"))
    want = []
    for who in {w for w, _ in names}:
        own = sorted({n.strip().lower() for w, n in names if w == who and len(n.strip()) > 1}, key=len, reverse=True)
        if own:
            p = re.compile(r"(?<![A-Za-z'])(?:" + "|".join(map(re.escape, own)) + r")(?![A-Za-z])", re.I)
            want += [(k, who, len(p.findall(t))) for k, t in texts if p.search(t)]
    assert got == sorted(want)


def test_profiles_stay_finite_over_ten_thousand_periods(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    periods = sorted({0, 10, 4000, 4001, 9999, *rng.integers(0, 10_000, 60).tolist()})
    items = [(("a", "b")[k % 2], int(p), [float(x) for x in rng.normal(size=3)], float(rng.integers(1, 5))) for k, p in enumerate(periods * 2)]
    df = spark.createDataFrame(items, "label string, ep int, v array<double>, w double")
    got = {(r["label"], r["ep"]): np.array(r["profile"]) for r in vec.rolling_profiles(df, ["label"], "ep", "v", F.col("w")).collect()}
    assert len(got) >= 2 * len(periods) - 2
    for (label, ep), profile in got.items():
        own = [(p, np.array(v), w) for one, p, v, w in items if one == label and p <= ep]
        last = max(p for p, _, _ in own)
        total = sum(w * 2.0 ** ((p - last) / 3.0) * v for p, v, w in own)
        assert np.isfinite(profile).all() and np.allclose(profile, total / np.linalg.norm(total), atol=1e-6)
