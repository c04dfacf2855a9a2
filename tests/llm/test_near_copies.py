import random

import pytest
from pyspark.sql import functions as F

VOCABULARY = [f"{a}{b}{c}" for a in "bcdfghklm" for b in "aeiou" for c in ("rt", "ls", "nd", "mp")]


def shingle_set(words):
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def jaccard(a, b):
    x, y = shingle_set(a), shingle_set(b)
    return len(x & y) / len(x | y)


@pytest.mark.parametrize("low", [0.80, 0.85, 0.90])
def test_near_copies_are_found_and_others_stay(spark, low):
    from spanloom.llm.simhash import drop_near_duplicates

    rng, docs, likeness = random.Random(int(low * 100)), [], []
    while len(likeness) < 120:
        words = [rng.choice(VOCABULARY) for _ in range(rng.randrange(120, 260))]
        other, stop = list(words), low + rng.random() * 0.05 if len(likeness) % 6 else low - 0.1
        while True:
            changed = list(other)
            changed[rng.randrange(len(other))] = "changed"
            if jaccard(words, changed) < stop:
                break
            other = changed
        k = len(likeness)
        docs += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
        likeness.append(jaccard(words, other))
    kept = {r["doc_id"] for r in drop_near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert {2 * k for k in range(len(likeness))} <= kept
    assert [2 * k + 1 in kept for k in range(len(likeness))] == [x < 0.8 for x in likeness]


def test_full_buckets_lose_no_near_copy(spark, monkeypatch):
    from spanloom.llm import nearcopies
    from spanloom.llm.simhash import near_duplicate_ids

    rng = random.Random(5)
    base = [rng.choice(VOCABULARY) for _ in range(200)]
    texts = []
    for _ in range(150):
        words = list(base)
        for _ in range(rng.randrange(1, 9)):
            words[rng.randrange(200)] = "changed" + str(rng.randrange(10**6))
        texts.append(words)
    root = list(range(150))
    for i in range(150):
        for j in range(i):
            if jaccard(texts[i], texts[j]) >= 0.8 and root[i] != root[j]:
                a, b = max(root[i], root[j]), min(root[i], root[j])
                root = [b if x == a else x for x in root]
    monkeypatch.setattr(nearcopies, "FULL", 8)
    monkeypatch.setattr(nearcopies, "CENTRES", 1)
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"] for r in near_duplicate_ids(df).collect()}
    assert got == {k for k, r in enumerate(root) if r != k}


def test_a_bucket_read_in_pieces_stays_connected(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from spanloom.llm import nearcopies as n

    monkeypatch.setattr(n, "PIECE", 16)
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 256, n.PLACES, dtype=np.uint16)
    keys = np.repeat(np.array([1, 2, 3, 4]) << n.NUMBERED, [5, 170, 1, 40])
    sketches = []
    for _ in keys:
        own = centre.copy()
        own[rng.integers(0, n.PLACES, 4)] = rng.integers(0, 256, 4)
        sketches.append(own.tobytes())
    table = pa.table({"key": keys, "fp": np.arange(keys.size), "sketch": pa.array(sketches, pa.binary())})

    class Everywhere(n.Scheme):
        def first_shared(self, same):
            return np.zeros(len(same), np.int64)  # every pair is told where it is seen

    root, full, pairs = list(range(keys.size)), set(), []
    for batch in n._met(iter(table.to_batches(max_chunksize=10))):
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            (full.add(u) if v is None else pairs.append((u, v)))
    assert full == set(np.flatnonzero(np.isin(keys >> n.NUMBERED, [2, 4])).tolist())
    for batch in n._centred(iter(table.filter(pa.array(np.isin(np.arange(keys.size), list(full)))).to_batches(max_chunksize=10)), Everywhere()):
        pairs += zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True)
    for u, v in pairs:
        if root[u] != root[v]:
            a, b = sorted((root[u], root[v]))
            root = [a if r == b else r for r in root]
    assert root == [0] * 5 + [5] * 170 + [175] + [176] * 40


def test_prefixes_meet_for_every_near_pair(spark):
    from spanloom.llm.nearcopies import _rare_first

    rng = random.Random(11)
    sets = [set(rng.sample(range(400), rng.randint(1, 60))) for _ in range(60)]
    for own in list(sets):
        other = set(own)
        for _ in range(rng.randint(0, 6)):
            other.discard(rng.choice(sorted(other)) if len(other) > 1 else None)
            other.add(rng.randrange(400, 500))
        sets.append(other)
    df = spark.createDataFrame([(k, sorted(s)) for k, s in enumerate(sets)], "fp long, shingles array<long>")
    met = {}
    for r in _rare_first(df, 0.8).collect():
        met.setdefault(r["key"], set()).add(r["fp"])
    for a in range(len(sets)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                assert any({a, b} <= m for m in met.values())


def test_of_equal_ids_the_same_row_stays(spark):
    from spanloom.llm.simhash import drop_near_duplicates

    rng = random.Random(9)
    text = lambda: " ".join(rng.choice(VOCABULARY) for _ in range(60))
    rows = [(k % 12, text(), k) for k in range(36)] + [(None, text(), 99), (None, None, 98)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int")
    kept = [sorted(map(tuple, drop_near_duplicates(some).collect()), key=str) for some in (df.repartition(5), df.orderBy(F.desc("n")).coalesce(2))]
    assert kept[0] == kept[1] and sorted(r[0] for r in kept[0] if r[0] is not None) == list(range(12)) and len(kept[0]) == 14
