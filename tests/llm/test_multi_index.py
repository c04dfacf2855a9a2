import random
from itertools import combinations

import numpy as np
import pytest

from .test_operators import AWKWARD, SCHEMA, VOCABULARY, ascii_lower, words


def shingle_set(text):
    w = words(ascii_lower(text))
    return {" ".join(w[k : k + 2]) for k in range(max(1, len(w) - 1))} if w else set()


def slow(docs):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs of rows."""
    sets, root = [shingle_set(t) for _, t in docs], list(range(len(docs)))
    for a, b in combinations(range(len(docs)), 2):
        if sets[a] and sets[b] and root[a] != root[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            root = [root[a] if r == root[b] else r for r in root]
    least = {r: min((docs[k][0] for k in range(len(docs)) if root[k] == r and docs[k][0] is not None), default=None) for r in root}
    return sorted([(i, len(s), least[r], i == least[r]) for (i, _), s, r in zip(docs, sets, root, strict=True)], key=str)


def linked(spark, rows, schema="doc_id long, text string"):
    from spanloom.llm.multiindex import minhash_components

    return sorted([tuple(r) for r in minhash_components(spark.createDataFrame(rows, schema).repartition(3)).collect()], key=str)


@pytest.mark.parametrize(("radius", "errors"), [(27, 1), (25, 2), (31, 3), (15, 0)])
def test_signatures_within_the_radius_share_a_key(radius, errors):
    from spanloom.llm.multiindex import chunk_places, chunks
    from spanloom.llm.nearcopies import PLACES, Scheme

    scheme = Scheme(2, chunk_places(radius, errors))

    parts = chunks(radius, errors)
    assert [p for c in parts for p in c] == list(range(PLACES)) and len(parts) * (errors + 1) > radius
    rng = np.random.default_rng(radius)
    one = rng.integers(0, 1 << 16, (1, PLACES), dtype=np.uint16)
    for trial in range(60):
        other = one.copy()
        # the worst case spreads the errors evenly over the chunks
        places = rng.permutation(PLACES)[:radius] if trial % 2 else [c[(trial + k) % len(c)] for k in range(errors + 1) for c in parts][:radius]
        other[0, places] += 1
        shared = [(a == b).all() for a, b in zip(scheme.keys(one), scheme.keys(other), strict=True)]
        assert any(shared) and scheme.first_shared(one == other)[0] == shared.index(True)


def test_nulls_repeats_and_extra_columns(spark):
    docs = [(i, t) for i, t, *_ in AWKWARD]
    assert linked(spark, AWKWARD, SCHEMA) == slow(docs)
    assert linked(spark, [(1, None), (2, ""), (3, " ")]) == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]
    assert linked(spark, []) == []
    assert linked(spark, [(None, "a b c"), (None, "A b C"), (None, "x"), (5, "x"), (3, "X")]) == slow([(None, "a b c"), (None, "A b C"), (None, "x"), (5, "x"), (3, "X")])


def edited(rng, base, n):
    own = list(base)
    for _ in range(n):
        own[rng.randrange(len(own))] = f"w{rng.randrange(10**6)}"
    return " ".join(own)


@pytest.mark.parametrize("seed", [1, 2])
def test_clouds_of_edits_around_the_threshold(spark, monkeypatch, seed):
    """A large cloud whose members lie on both sides of 0.8 from the original, bridges over chains, and a passage that many share."""
    from spanloom.llm import nearcopies

    monkeypatch.setattr(nearcopies, "CENTRES", 1)
    rng = random.Random(seed)
    base = [rng.choice(VOCABULARY) + str(rng.randrange(9)) for _ in range(120)]
    docs = [(k + 10, edited(rng, base, rng.randint(4, 11))) for k in range(160)]
    far = edited(rng, base, 9).split()
    docs += [(300 + k, edited(rng, far, rng.randint(1, 6))) for k in range(40)]
    docs += [(400 + k, " ".join(base[:60] + [rng.choice(VOCABULARY) + str(rng.randrange(99)) for _ in range(60)])) for k in range(50)]
    docs += [(500 + k, t) for k, (_, t) in enumerate(docs[::7])]
    rng.shuffle(docs)
    assert linked(spark, docs) == slow(docs)
