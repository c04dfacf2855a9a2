"""The near-duplicate stage's own method: SimHash candidates by pigeonring chains, each verified, then what lies beyond their radius."""

import random

from .test_near_copies import VOCABULARY, jaccard


def _copies(rng, edits):
    words = [rng.choice(VOCABULARY) for _ in range(rng.randrange(250, 400))]
    other = list(words)
    for at in rng.sample(range(len(words)), edits):
        other[at] = "changed"
    return words, other


def test_simhash_finds_near_copies_without_bands(spark, monkeypatch):
    from spanloom.llm import nearcopies, simhash
    from spanloom.llm.minhash import WordHashes

    rng, docs, pairs = random.Random(3), [], []
    for k in range(40):
        pairs.append(_copies(rng, 1 + k % 2))
        docs += [(2 * k, " ".join(pairs[-1][0])), (2 * k + 1, " ".join(pairs[-1][1]))]
    assert all(jaccard(*pair) > 0.9 for pair in pairs)
    words = WordHashes()
    bits = [[simhash.majority(nearcopies._set_of(" ".join(x).encode(), words, 5)) for x in pair] for pair in pairs]
    want = {2 * k + 1 for k, (a, b) in enumerate(bits) if (a ^ b).bit_count() <= simhash.NEAR}
    assert len(want) > 25
    monkeypatch.setattr(simhash, "Scheme", lambda least: nearcopies.Scheme(places=(), least=least))
    gone = {r["doc_id"] for r in simhash.near_duplicate_ids(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert gone == want


def test_near_simhashes_alone_are_no_link(spark, monkeypatch):
    from spanloom.llm import simhash

    rng, docs, want = random.Random(4), [], set()
    for k in range(30):
        words, other = _copies(rng, rng.choice([1, 4, 40]))
        docs += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
        want |= {2 * k + 1} if jaccard(words, other) >= 0.8 else set()
    df = spark.createDataFrame([*docs, (60, None), (61, " "), (62, "one two"), (63, "two one")], "doc_id long, text string")
    monkeypatch.setattr(simhash, "majority", lambda hashes: 5)  # all fingerprints are equal
    assert {r["doc_id"] for r in simhash.near_duplicate_ids(df).collect()} == want | {61}


def test_pairs_join_all_within_the_radius(spark):
    from spanloom.llm.graph import connected_components
    from spanloom.llm.simhash import NEAR, near_pairs

    rng, rows = random.Random(6), []
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 7)):
            bits = base
            for at in rng.sample(range(64), rng.choice([0, 0, 2, 5, 9])):
                bits ^= 1 << at
            rows.append((rng.getrandbits(63), bits - (1 << 64) if bits >> 63 else bits))
    root = {fp: fp for fp, _ in rows}
    for a, x in rows:
        for b, y in rows:
            if ((x ^ y) & (1 << 64) - 1).bit_count() <= NEAR and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {k: low if r == high else r for k, r in root.items()}
    found = connected_components(near_pairs(spark.createDataFrame(rows, "fp long, bits long"))).collect()
    assert {fp: fp for fp, _ in rows} | {r["node"]: r["root"] for r in found} == root
    assert near_pairs(spark.createDataFrame([], "fp long, bits long")).count() == 0


def test_pairs_that_are_joined_are_not_told_again():
    import numpy as np
    import pyarrow as pa

    from spanloom.llm import nearcopies as n

    rng = np.random.default_rng(8)
    sketches = np.tile(rng.integers(0, 256, n.PLACES, dtype=np.uint16), (50, 1))
    roots = np.r_[np.zeros(30, np.int64), np.arange(30, 50)]
    table = pa.table({"key": np.zeros(50, np.int64), "fp": np.arange(50), "sketch": pa.array([s.tobytes() for s in sketches], pa.binary()), "root": roots})
    told = {(u, v) for b in n._centred(iter(table.to_batches()), n.Scheme()) for u, v in zip(b.column("u").to_pylist(), b.column("v").to_pylist(), strict=True)}
    assert {v for _, v in told} == set(range(30, 50)) and all(roots[u] != roots[v] for u, v in told)
