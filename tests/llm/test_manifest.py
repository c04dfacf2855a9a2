import hashlib
import random
import zlib

import pytest

from .test_operators import AWKWARD, SCHEMA, ascii_lower


def h(x):
    return hashlib.sha256(x.encode()).hexdigest()


def slow(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) by the definition; rows are (doc_id, source, lang, n_chars, text)."""

    def leaf(row):
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def tree(nodes):
        """The root, and for each node its siblings (left, right) level by level."""
        paths, where = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for k, at in enumerate(where):
                a = at - at % 8
                paths[k].append(("".join(nodes[a:at]), "".join(nodes[at + 1 : a + 8])))
                where[k] = at // 8
            nodes = [h("".join(nodes[a : a + 8])) for a in range(0, len(nodes), 8)]
        return nodes[0], paths

    groups = {}
    for row in rows:
        other = row
        if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
            other = (*row[:4], ascii_lower(row[4]))
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row), leaf(other)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    made = {g: tree([x[2] for x in sorted(groups[g])]) for g in names}
    if not names:
        return []
    root, crown = tree([made[g][0] for g in names])
    found = []
    for g, above in zip(names, crown, strict=True):
        subroot, paths = made[g]
        for (known, doc_id, own, other), path in zip(sorted(groups[g]), paths, strict=True):
            back = other
            for a, b in path + above:
                back = h(a + back + b)
            found.append((doc_id if known else None, own, subroot, root, h("".join(a + b for a, b in path + above)), back, back == root))
    return sorted(found, key=str)


def proved(spark, rows, **more):
    from spanloom.llm.manifest import manifest_proofs

    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string, grp string, level int, hash string")
    return sorted([tuple(r) for r in manifest_proofs(docs.repartition(3), **more).collect()], key=str)


def with_extras(rows):
    return [(*r, "x", 7, "y") for r in rows]


def test_nulls_repeats_and_extra_columns(spark):
    rows = [(i, s, g, n, t) for i, t, g, s, n, _ in AWKWARD] + [(k, None, f"lang{k}", None, "One") for k in range(20, 31)]
    assert proved(spark, with_extras(rows)) == slow(rows)


@pytest.mark.parametrize("deep", [1, 4])
def test_levels_in_several_storeys(spark, deep):
    rng = random.Random(deep)
    rows = [(k, "s", "hot", k, f"Text {k}") for k in range(rng.sample(range(600), 1)[0] + 500)]
    rows += [(2000 + k, "s", f"g{k % n}", None, "ABC") for n in (3, 70) for k in range(80)] + [(5000, None, None, 1, "a")] * 9
    assert proved(spark, with_extras(rows), deep=deep) == slow(rows)


def test_edges_of_levels(spark):
    sizes = [1, 7, 8, 9, 64, 65, 4096, 4097]
    rows = [(10_000 * g + k, "s", f"g{g}", k, "Abc") for g, n in enumerate(sizes) for k in range(n)]
    assert proved(spark, with_extras(rows)) == slow(rows)
    assert proved(spark, with_extras(rows[:1])) == slow(rows[:1])
    assert proved(spark, []) == []


def test_tampered_rows_are_told(spark):
    rows = [(k, "s", "en", k, "Abc" if k % 2 else "abc") for k in range(200)]
    got = proved(spark, with_extras(rows))
    want = {k for k in range(1, 200, 2) if zlib.crc32(str(k).encode()) % 3 == 0}
    assert {r[0] for r in got if not r[-1]} == want and want


def test_nodes_are_stored_by_level(spark):
    from pyspark.sql import functions as F

    from spanloom.llm.common import stored
    from spanloom.llm.manifest import build, leaf, numbered

    rows = stored(numbered(spark.range(5000).select(F.lit("a").alias("grp"), "id", leaf([F.col("id")]).alias("hash")), "grp", ["id"], "t"), "t0")
    store = build(rows, "t-nodes")
    assert {r["level"]: r["count"] for r in spark.read.parquet(store.folder).groupBy("level").count().collect()} == {1: 625, 2: 79, 3: 10, 4: 2, 5: 1}
    assert spark.read.parquet(store.folder).where("level = 2").inputFiles()
