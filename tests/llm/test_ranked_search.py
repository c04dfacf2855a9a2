import math
import random
import re
from collections import Counter

from .test_operators import AWKWARD, BASE, SCHEMA, VOCABULARY, ascii_lower


def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", ascii_lower(text))


def slow(docs, items, k=10):
    """Every document scored for every item, by the definition."""
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    found = []
    for item, text in items:
        scored = []
        for doc, own, n in held:
            m = 25 + (75 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * own[t]) // (1000 * own[t] + 8 * m)) for t in terms(text) if t in own)
            if score > 0:
                scored.append((-score, doc is None, doc))
        for rank, (score, _, doc) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1):
            found.append((item, rank, doc, -score))
    return sorted(found, key=str)


def searched(spark, docs, items, k=10):
    from spanloom.llm.ranked import build_index, search

    d = spark.createDataFrame(docs, SCHEMA) if docs and len(docs[0]) > 2 else spark.createDataFrame(docs, "doc_id long, text string")
    rows = search(build_index(d), spark.createDataFrame(items, "item_id long, text string, terms int, row string") if items and len(items[0]) > 2 else spark.createDataFrame(items, "item_id long, text string"), k).collect()
    return sorted([tuple(r) for r in rows], key=str)


ITEMS = [(1, BASE), (2, "a b C 漢字 É"), (3, ""), (4, None), (5, "nowhere at all"), (None, BASE[:40]), (6, "x x x"), (6, "ß - ß!"), (7, "bart\x00celt.giND d")]


def test_nulls_ties_repeats_and_extra_columns(spark):
    docs = [(i, t) for i, t, *_ in AWKWARD]
    assert searched(spark, AWKWARD, [(*x, 1, "r") for x in ITEMS]) == slow(docs, ITEMS)


def test_random_corpus_in_many_blocks(spark, monkeypatch):
    from spanloom.llm import ranked

    monkeypatch.setattr(ranked, "BLOCK_DOCS", 7)
    monkeypatch.setattr(ranked, "QUERY_TERMS", 40)
    rng = random.Random(5)
    pick = lambda n: " ".join(rng.choices(VOCABULARY, [1 / (k + 1) for k in range(len(VOCABULARY))], k=n))
    docs = [(k, pick(rng.randint(0, 60))) for k in range(150)] + [(200 + k, "gund mols hart") for k in range(40)]
    items = [(k, pick(rng.randint(1, 12))) for k in range(25)] + [(99, "gund mols")]
    assert searched(spark, docs, items) == slow(docs, items)
    assert searched(spark, docs, items, 3) == slow(docs, items, 3)


def test_bounds_hold():
    import numpy as np

    from spanloom.llm.ranked import STEP, impact, length_norm

    rng = np.random.default_rng(1)
    tf = rng.integers(1, 20_000, 5000)
    m = length_norm(tf + rng.integers(0, 20_000, 5000), 1000, 300_000)
    exact = impact(tf, m)
    level = -(-exact // STEP)
    assert level.max() <= 255 and (level * STEP >= exact).all() and ((level - 1) * STEP < exact).all()


def test_empty_tables(spark):
    assert searched(spark, [], ITEMS) == []
    assert searched(spark, [(1, None), (2, " . ")], ITEMS) == []
    assert searched(spark, [(1, "a b")], []) == []


def test_many_copies_keep_the_smallest_ids(spark):
    docs = [(1000 - k, "one two three") for k in range(400)] + [(5000, "one two three four")]
    got = searched(spark, docs, [(1, "two"), (2, "four two")])
    assert got == slow(docs, [(1, "two"), (2, "four two")])
    assert [d for i, _, d, _ in got if i == 1] != [] and min(d for i, _, d, _ in got if i == 1) == 601


def test_row_groups_hold_few_blocks(spark, monkeypatch):
    """A task may make any number of blocks; those of a row group are in memory at once."""
    import pyarrow.parquet as pq

    from spanloom.llm import ranked

    monkeypatch.setattr(ranked, "BLOCK_DOCS", 1)
    docs = spark.range(90).selectExpr("id as doc_id", "concat('one ', id) as text").coalesce(1)
    index = ranked.build_index(docs)
    for blocks in (ranked._postings(docs, "doc_id", "text"), index.blocks):
        files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in blocks.inputFiles()]
        groups = [f.row_group(k).num_rows for f in files for k in range(f.num_row_groups)]
        assert sum(groups) == 90 and max(groups) <= 10
    found = ranked.search(index, spark.createDataFrame([(1, "89 one")], "item_id long, text string"), 2).orderBy("rank").collect()
    assert [r["doc_id"] for r in found] == [89, 0]
