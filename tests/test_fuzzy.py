"""Candidates of fuzzy matches: none missing, and not many more than needed."""

import random

import numpy as np
import pytest

from spanloom.functions.text import _common_many
from spanloom.operators import resolve as rs


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_common_characters_of_many_pairs():
    rng = random.Random(1)
    text = lambda most: "".join(rng.choice("abcé漢") for _ in range(rng.randrange(most)))
    pairs = [(text(70), text(150)) for _ in range(300)] + [("a" * 64, "a" * 70), ("a" * 65, "ab" * 70), ("", ""), ("", "abc"), ("😀a", "a😀")]
    assert _common_many([a for a, _ in pairs], [b for _, b in pairs]).tolist() == [common(a, b) for a, b in pairs]


def spoilt(rng, name):
    own = list(name)
    for _ in range(rng.randrange(0, 4)):
        at = rng.randrange(len(own) + 1)
        own[at : at + rng.randrange(0, 2)] = [rng.choice("abcdeklmnorst")] * rng.randrange(0, 2)
    return "".join(own)


def names_of(rng, n):
    return sorted({"".join(rng.choice("abcdeklmnorst") for _ in range(rng.randint(2, 14))) for _ in range(n)})


@pytest.mark.parametrize("least", [70.0, 85.0, 92.0])
def test_no_pair_is_missed(spark, least):
    rng = random.Random(int(least))
    names = names_of(rng, 150) + ["", "aaaa", "aaaaaa", "abababab"]
    tokens = sorted({spoilt(rng, n) for n in names for _ in range(2)} | {"aaa", "aaaaaaa", "babababa"})
    frames = spark.createDataFrame([(t,) for t in tokens], "token string"), spark.createDataFrame([(n,) for n in names], "name string")
    got = {tuple(r) for r in rs.ratio_candidates(*frames, "token", "name", least).collect()}
    want = {(t, n) for t in tokens for n in names if (200 * common(t, n) / (len(t) + len(n)) if t or n else 100) >= least}
    assert want <= got
    best = {r["token"]: (r["name"], round(r["score"], 6)) for r in rs.fuzzy_best(*frames, "token", "name", least).collect()}
    for t in tokens:
        scored = [(-200 * common(t, n) / (len(t) + len(n)) if t or n else -100.0, n) for n in names if (t, n) in want]
        if scored:
            score, name = min(scored)
            assert best[t] == (name, round(-score, 6))


def test_candidates_grow_with_the_names(spark):
    rng = random.Random(7)
    tokens = spark.createDataFrame([(t,) for t in sorted({spoilt(rng, n) for n in names_of(rng, 300)})], "token string")
    counts = []
    for n in (400, 4000):
        names = spark.createDataFrame([(x,) for x in names_of(rng, n)], "name string")
        counts.append(rs.ratio_candidates(tokens, names, "token", "name", 85.0).count())
    assert counts[1] <= 15 * max(counts[0], 30)
    assert counts[1] <= 0.02 * tokens.count() * 4000


def test_ratio_takes_long_texts():
    from spanloom.functions.text import _ratio_many

    a, b = "x" * 500 + "y", "x" * 499
    assert np.allclose(_ratio_many([a], [b]), [200 * 499 / 1000])
