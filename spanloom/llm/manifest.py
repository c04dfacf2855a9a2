"""A Merkle manifest of a data set: an external-memory node store in level-partitioned Parquet, and proofs read from it by coordinate.

Leaves are hashed where their rows are, sorted in runs by (group, key), and numbered from the runs' counts, so no task orders a whole
group. Nodes have coordinates (group, level, idx). Levels are made a few at a time: FAN ** DEEP consecutive nodes are a cell, whose
tree of DEEP levels one task makes from its nodes in order; the cells' tops are the next level to read. Proofs go the other way: a cell's
stored nodes and what its top has above it are merged with its leaves, in order of coordinates. The groups' own roots are the leaves
of one more tree of the same kind.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_folder, small_side, stored

#: Nodes that make a parent, and the levels of a cell.
FAN, DEEP = 8, 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values: list[Column]) -> Column:
    """The hash of a row's values: each `-` if null, else its bytes' number, a colon and itself."""
    return F.sha2(F.concat(*(F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)) for v in (v.cast("string") for v in values))), 256)


def numbered(rows: DataFrame, group: str, keys: list[str], label: str) -> DataFrame:
    """``rows`` with ``idx``, their place in their group by ``keys`` (nulls first), and ``n``, its rows, both longs.

    Runs sorted by (group, keys) are stored with each row's place in its run; a run's rows of a group follow those of the runs before.
    Rows equal in all keys are told apart by where they came from, so that none of them fill a run.
    """
    order = [group, *keys, "__tie"]
    ranged = rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("__tie")
    runs = stored(ranged.withColumn("__at", F.monotonically_increasing_id()).withColumn("__run", F.shiftright("__at", 33)), label)
    spans = runs.groupBy("__run", group).agg(F.min("__at").alias("first"), F.count("*").alias("n_run"))
    of_group = Window.partitionBy(group)
    before = F.coalesce(F.sum("n_run").over(of_group.orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = stored(spans.select(F.col("__run").alias("run"), F.col(group).alias("of"), (before - F.col("first")).alias("shift"), F.sum("n_run").over(of_group).alias("n")), "spans")
    here = (runs["__run"] == spans["run"]) & runs[group].eqNullSafe(spans["of"])
    near = small_side(spans, spans.count(), spans.agg(F.sum(F.octet_length("of"))).first()[0] or 0)
    return runs.join(near, here).select(*(runs[c] for c in rows.columns), (F.col("__at") + F.col("shift")).alias("idx"), "n")


_NODE = "grp string, level int, idx long, hash string, n long"


def _at_level(n: Column, level: int) -> Column:
    """How many nodes a group of n leaves has at a level."""
    return F.ceil(n / F.lit(FAN**level)).cast("long")


class Store(NamedTuple):
    """The leaves (grp, idx, n, hash and more columns) and the folder of the nodes, `level=` by level from 1 on; ``heights`` counts the levels
    made, ``deep`` those of a cell."""

    leaves: DataFrame
    folder: str
    heights: int
    deep: int

    def nodes(self, low: int, high: int) -> DataFrame:
        """The nodes of the levels from low to high, leaves (level 0) with only their common columns."""
        own = self.leaves.select("grp", F.lit(0).alias("level"), "idx", "hash", "n").filter(F.lit(low == 0))
        if high < 1 or not self.heights:
            return own
        read = self.leaves.sparkSession.read.schema(_NODE).parquet(self.folder).select("grp", "level", "idx", "hash", "n")
        return own.unionByName(read.filter(F.col("level").between(max(low, 1), high)))


def _cells(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    """(group, cell, rows as tuples) from rows sorted by (grp, cell)."""
    now, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("grp", "cell", *names)), strict=True):
            if row[:2] != now:
                if held:
                    yield *now, held
                now, held = row[:2], []
            held.append(row[2:])
    if held:
        yield *now, held


def _parents(hashes: list[str]) -> list[str]:
    return [digest("".join(hashes[k : k + FAN])) for k in range(0, len(hashes), FAN)]


def build(leaves: DataFrame, label: str, deep: int = DEEP) -> Store:
    """The node store over stored ``leaves`` (grp, idx, n, hash, more): in each group, every FAN consecutive nodes of a level become one of the
    next (the last of a level: fewer, even one) while a level has several."""
    spark = leaves.sparkSession
    folder = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    most = leaves.agg(F.max("n")).first()[0] or 0
    store, low = Store(leaves, folder, 0, deep), 0
    while FAN**low < most:

        def made(batches: Iterator[pa.RecordBatch], low=low) -> Iterator[pa.RecordBatch]:
            for grp, cell, rows in _cells(batches, ["hash", "n"]):
                hashes, n = [h for h, _ in rows], rows[0][1]
                out = []
                for up in range(1, deep + 1):
                    if -(-n // FAN ** (low + up - 1)) == 1:
                        break
                    hashes = _parents(hashes)
                    first = cell * FAN ** (deep - up)
                    out += [(grp, low + up, first + k, h, n) for k, h in enumerate(hashes)]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64()), strict=True)], names=["grp", "level", "idx", "hash", "n"])

        read = store.nodes(low, low).filter(_at_level(F.col("n"), low) > 1).withColumn("cell", F.floor(F.col("idx") / FAN**deep).cast("long"))
        step = read.select("grp", "cell", "idx", "hash", "n").repartition("grp", "cell").sortWithinPartitions("grp", "cell", "idx").mapInArrow(made, _NODE)
        step.write.mode("append").partitionBy("level").parquet(folder)
        low += deep
        store = Store(leaves, folder, low, deep)
    return store


def roots(store: Store) -> DataFrame:
    """(grp, root): the last node of each group."""
    nodes, n, level = store.nodes(0, store.heights), F.col("n"), F.col("level")
    size = F.pow(F.lit(float(FAN)), level)
    return nodes.filter((n <= size) & ((level == 0) | (n > size / FAN))).select("grp", F.col("hash").alias("root"))


def folded(own: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings, those to its left and right level by level, give."""
    for left, right in path:
        own = digest(left + own + right)
    return own


def _level_path(hashes: list[str], k: int) -> tuple[str, str]:
    """The siblings to the left and right of node k."""
    a = k - k % FAN
    return "".join(hashes[a:k]), "".join(hashes[k + 1 : a + FAN])


def _text(path: list[tuple[str, str]]) -> str:
    return "/".join(f"{a}|{b}" for a, b in path)


def _path(text: str) -> list[tuple[str, str]]:
    return [tuple(x.split("|")) for x in text.split("/")] if text else []


def _walked(batches: Iterator[pa.RecordBatch], low: int, deep: int, more: list[str]) -> Iterator[tuple]:
    """(group, cell, what the cell's top has above it, rows with their siblings level by level) of each cell.

    A cell's rows come from the top down: its path above (tail), the nodes of its levels, then its leaves.
    """
    for grp, cell, rows in _cells(batches, ["level", "idx", "hash", "n", "tail", *more]):
        above = next((r[4] for r in rows if r[4] is not None), None)
        assert above is not None, "each cell has a path above it"
        levels: list[list[str]] = [[] for _ in range(deep)]
        own = []
        for row in rows:
            if row[4] is None:
                levels[row[0] - low].append(row[2])
                if row[0] == low:
                    own.append(row)
        n = own[0][3]
        tops = [k for k in range(deep) if -(-n // FAN ** (low + k)) > 1]  # levels at which a node has a parent
        top = _path(above)
        paths = [top]  # of the nodes of the level above, the cell's top first
        for k in reversed(tops):
            paths = [[_level_path(levels[k], j), *paths[j // FAN]] for j in range(len(levels[k]))]
        yield grp, cell, [(row, paths[j if tops else 0]) for j, row in enumerate(own)]


def _tails(store: Store, top: DataFrame) -> DataFrame:
    """(grp, cell, tail) for the leaves' cells, given ``top`` (grp, tail): what each group's root has above it."""
    n_of = store.leaves.filter("idx = 0").select("grp", "n")
    own = top.join(n_of.withColumnRenamed("grp", "of"), top["grp"].eqNullSafe(F.col("of"))).select(top["grp"], "n", "tail")
    own = stored(own, "tails")
    found, deep = None, store.deep
    for low in range((max(store.heights, deep) // deep - 1) * deep, -1, -deep):
        # a group whose root is in this storey starts here, in its only cell
        size = float(FAN**low)
        starts = (F.col("n") <= size * FAN**deep) & (F.col("n") > size) if low else F.col("n") <= FAN**deep
        tails = own.filter(starts).select("grp", F.lit(0).cast("long").alias("cell"), "tail")
        found = tails if found is None else found.unionByName(tails)
        if not low:
            return found

        def walked(batches: Iterator[pa.RecordBatch], low=low) -> Iterator[pa.RecordBatch]:
            for grp, _, rows in _walked(batches, low, deep, []):
                yield pa.record_batch({"grp": pa.array([grp] * len(rows), pa.string()), "cell": pa.array([r[1] for r, _ in rows], pa.int64()), "tail": pa.array([_text(p) for _, p in rows], pa.string())})

        found = stored(_feed(store, low, store.nodes(low, low + deep - 1), found).mapInArrow(walked, "grp string, cell long, tail string"), "tails")
    return found


def _feed(store: Store, low: int, nodes: DataFrame, tails: DataFrame) -> DataFrame:
    """A storey's nodes that have a parent, or are a group's only leaf, with the tails of their cells, from the top down in each cell."""
    # the root itself is no sibling, and a level that several cells share is the next storey's
    many = F.ceil(F.col("n") / F.pow(F.lit(float(FAN)), F.col("level"))) > 1
    nodes = nodes.filter(many if low else many | (F.col("level") == 0))
    width = F.pow(F.lit(float(FAN)), F.lit(low + store.deep) - F.col("level"))
    nodes = nodes.withColumn("cell", F.floor(F.col("idx") / width).cast("long"))
    first = tails.withColumns({"level": F.lit(low + store.deep), "idx": F.lit(0).cast("long")})
    return nodes.unionByName(first, allowMissingColumns=True).repartition("grp", "cell").sortWithinPartitions("grp", "cell", F.desc("level"), "idx")


def manifest_proofs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_col: str = "lang", more: tuple[str, ...] = ("source", "lang", "n_chars"), changed: Column | None = None, tamper: Column | None = None, deep: int = DEEP) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per row of ``docs``.

    A leaf is the hash of id, ``more`` and text. Leaves of a group (null is a group) ascend by id, null ids first, equal ids by leaf. Groups
    ascend by name in UTF-8, null first. proof_sha256 is the hash of all siblings up to the root, left to right and level by level, of the
    empty string if there are none. Where ``changed`` holds, the text is taken as ``tamper`` before it is checked against the stored
    siblings; verified says whether the root still comes out. Defaults: a third of the rows by the CRC-32 of their id, A-Z lower-cased; rows
    without an id, and null texts, stay as they are. Empty and very long texts are hashed like any other, repeated rows are leaves of their
    own, an empty table gives an empty result, and other columns are ignored.
    """
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    changed = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 0 if changed is None else changed
    tamper = F.translate(text, _UPPER, _LOWER) if tamper is None else tamper
    rest = [F.col(c) for c in more]
    hashed = docs.select(doc_id.alias("doc_id"), F.col(group_col).cast("string").alias("grp"), leaf([doc_id, *rest, text]).alias("hash"), F.when(changed, leaf([doc_id, *rest, tamper])).alias("other"))
    leaves = stored(numbered(stored(hashed, "leaves"), "grp", ["doc_id", "hash"], "runs"), "level0")
    store = build(leaves, "nodes", deep)
    # the groups' roots are the leaves of the tree on top, in one group
    subroots = stored(roots(store), "subroots")
    named = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("root").alias("hash"))
    crown = build(stored(numbered(named, "grp", ["name"], "crown"), "crown0"), "crown-nodes", deep)
    whole = (roots(crown).first() or [None, None])[1]
    above = _tails(crown, docs.sparkSession.createDataFrame([("", "")], "grp string, tail string"))
    named_tails = _final(crown, above, ["name"], _named, "grp string, tail string, subroot string")
    top = stored(named_tails, "tops")
    tails = _tails(store, top.select("grp", "tail"))
    subroot = top.select(F.col("grp").alias("of"), "subroot")
    found = _final(store, tails, ["doc_id", "other"], _proved, "grp string, doc_id long, leaf string, proof_sha256 string, folded_root string")
    near = small_side(subroot, subroot.count(), subroot.agg(F.sum(F.octet_length("of"))).first()[0] or 0)
    return found.join(near, found["grp"].eqNullSafe(F.col("of"))).select("doc_id", "leaf", "subroot", F.lit(whole).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == F.lit(whole)).alias("verified"))


def _final(store: Store, tails: DataFrame, more: list[str], told, schema: str) -> DataFrame:
    """The leaves of a store, with ``more`` columns, as ``told`` has them and their paths."""
    nodes, deep = store.nodes(1, store.deep - 1), store.deep
    rows = store.leaves.select("grp", F.lit(0).alias("level"), "idx", "hash", "n", *more).unionByName(nodes, allowMissingColumns=True)

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grp, _, own in _walked(batches, 0, deep, more):
            yield told(grp, own)

    return _feed(store, 0, rows, tails).mapInArrow(walked, schema)


def _named(_: str, rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch({"grp": pa.array([r[5] for r, _ in rows], pa.string()), "tail": pa.array([_text(p) for _, p in rows], pa.string()), "subroot": pa.array([r[2] for r, _ in rows], pa.string())})


def _proved(grp: str | None, rows: list[tuple]) -> pa.RecordBatch:
    proofs = [digest("".join(a + b for a, b in path)) for _, path in rows]
    back = [folded(r[6] or r[2], path) for r, path in rows]
    return pa.record_batch({
        "grp": pa.array([grp] * len(rows), pa.string()), "doc_id": pa.array([r[5] for r, _ in rows], pa.int64()), "leaf": pa.array([r[2] for r, _ in rows], pa.string()),
        "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(back, pa.string()),
    })
