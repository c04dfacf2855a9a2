import random

import pytest

VOCABULARY = [f"{a}{b}{c}" for a in "bcdfghklm" for b in "aeiou" for c in ("rt", "ls", "nd", "mp")]


def shingle_set(words):
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.8, 1.0])
def test_no_link_is_lost_at_any_threshold(spark, threshold):
    from spanloom.llm.decontaminate import find_leaks

    rng, items, docs = random.Random(4), [], []
    for k in range(120):
        item = [rng.choice(VOCABULARY) for _ in range(rng.randrange(3, 90))]
        part = min(len(item), 4 + round(max(1, len(item) - 4) * threshold) + rng.choice([-2, 0, 1, 3]))
        at = rng.randrange(max(1, len(item) - part + 1))
        items.append((k, item))
        docs.append((k, [rng.choice(VOCABULARY) for _ in range(rng.randrange(4, 300))] + item[at : at + part]))
    want = {}
    for d, doc in docs:
        own = shingle_set(doc)
        for i, item in items:
            both = len(own & shingle_set(item))
            if both and both >= threshold * len(shingle_set(item)):
                want[d, i] = both
    frame = lambda rows, key: spark.createDataFrame([(k, " ".join(w)) for k, w in rows], f"{key} long, text string").repartition(3)
    got = {(r["doc_id"], r["item_id"]): r["n_shared"] for r in find_leaks(frame(docs, "doc_id"), frame(items, "item_id"), threshold).collect()}
    assert got == want and len(want) > 30


def test_rows_of_one_id_count_together(spark):
    from spanloom.llm.decontaminate import find_leaks

    words = [f"w{k}" for k in range(20)]  # 16 shingles, no row holds more than six
    rows = [(1, " ".join(words[a:b])) for a, b in ((0, 10), (6, 15), (11, 20))] + [(2, " ".join(words[:10])), (None, " ".join(words))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    halves = [(5, " ".join(words[:12])), (5, " ".join(words[8:]))]
    got = find_leaks(docs, spark.createDataFrame(halves, "item_id long, text string"))
    assert [tuple(r)[:4] for r in got.collect()] == [(1, 5, 16, 16)]
