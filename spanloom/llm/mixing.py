"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same fractional number of copies, its source's target over its source's size. The whole part
is taken; the fractions meet in pairs, and each pair moves words from one to the other until one of the two is 0 or 1. Which way
is drawn so that no document's expected copies change, and the pair's words (fraction times size) stay the same. The pairing is
a reduction tree: groups of documents of one source are folded from long to short, each passes on the one document that still
has a fraction, and the next level folds those, up to one per source. Long documents are rounded first, and the one they leave
is paired with all shorter documents of its source together.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, let, small_side, stored

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: Members of a group of the reduction tree, on average.
GROUP = 32
#: Least words of the longer bands of documents; each band is rounded before the shorter ones.
BANDS = (2048, 256)
EPS = 1e-9


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) for a table (source, source_size), in order of code point, null last, weights repeating.

    Targets share the sum of all sizes by weight; one that passes ``most`` times its source's size stops there, and the excess
    is shared again by weight among the rest. Solved at once: with the sources in order of ``most * size / weight``, the first
    ones stop, and the others share what is left; the number that stop is the least at which the next one holds its share.
    The table has a row a source, aggregated before it is ordered.
    """
    ordered = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    weighed = ordered.withColumn("weight", weight).withColumn("most", F.col("source_size") * float(most))
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    # a source stops if even alone with the ones after it its share would pass its most
    return weighed.withColumn("level", level).withColumn("stops", F.col("level") * F.col("weight") > F.col("most")).withColumn(
        "free", F.max(F.when(~F.col("stops"), F.col("level"))).over(whole)
    ).select("source", "source_size", F.when(F.col("stops"), F.col("most")).otherwise(F.coalesce("free", "level") * F.col("weight")).alias("target"))


def _chance(seed: str, a: Column, b: Column) -> Column:
    """A number in [0, 1) that depends only on the seed and the two ids."""
    return F.pmod(F.xxhash64(F.lit(seed), a, b), F.lit(1 << 52)).cast("double") / float(1 << 52)


def _fold(members: Column, seed: str, kind: str) -> Column:
    """One group: (open: the member that keeps a fraction, ups: the rows, of type ``kind``, rounded up)."""
    unit = f"struct<row:{kind},p:double,size:double>"
    start = F.struct(F.lit(None).cast(unit).alias("open"), F.array().cast(f"array<{kind}>").alias("ups"))

    def step(acc: Column, m: Column) -> Column:
        a, b = acc["open"], m
        up = F.least((1 - a["p"]) * a["size"], b["p"] * b["size"])  # words that can go from b to a, and back
        down = F.least(a["p"] * a["size"], (1 - b["p"]) * b["size"])
        moved = F.when(_chance(seed, a["row"], b["row"]) * (up + down) < down, up).otherwise(-down)
        pair = F.array(
            F.struct(a["row"].alias("row"), (a["p"] + moved / a["size"]).alias("p"), a["size"].alias("size")),
            F.struct(b["row"].alias("row"), (b["p"] - moved / b["size"]).alias("p"), b["size"].alias("size")),
        )
        return let(pair, lambda two: F.struct(
            F.get(F.filter(two, lambda x: (x["p"] > EPS) & (x["p"] < 1 - EPS)), F.lit(0)).alias("open"),
            F.concat(acc["ups"], F.transform(F.filter(two, lambda x: x["p"] >= 1 - EPS), lambda x: x["row"])).alias("ups"),
        ))

    alone = lambda acc, m: F.struct(F.struct(m["row"], m["p"], m["size"]).cast(unit).alias("open"), acc["ups"].alias("ups"))
    return F.aggregate(members, start, lambda acc, m: F.when(acc["open"].isNull(), alone(acc, m)).otherwise(step(acc, m)))


def _tree(units: DataFrame, seed: str) -> tuple[DataFrame, DataFrame]:
    """(row) of the units rounded up, and (lane, row, p, size) of the one unit a lane that may still have a fraction."""
    kind = units.schema["row"].dataType.simpleString()
    now = stored(units.select("row", "p", F.col("size").cast("double").alias("size"), "lane", "spread"), "units")
    depth = max(0, ceil(log2(max(1, now.count()) / GROUP)))
    levels = [*range(depth, 0, -int(log2(GROUP))), 0]
    ups = None
    for number, d in enumerate(levels):
        cell = F.shiftrightunsigned(F.col("spread"), 64 - d) if d else F.lit(0).cast("long")
        in_order = F.transform(F.sort_array(F.collect_list(F.struct((-F.col("size")).alias("last"), "spread", "row", "p", "size"))), lambda m: F.struct(m["row"].alias("row"), m["p"].alias("p"), m["size"].alias("size")))
        groups = now.groupBy("lane", cell.alias("cell")).agg(in_order.alias("members"), F.min("spread").alias("spread"))
        done = stored(groups.select("lane", "spread", _fold(F.col("members"), f"{seed}-{number}", kind).alias("f")), "folded")
        own = done.select(F.explode("f.ups").alias("row"))
        ups = own if ups is None else ups.unionByName(own)
        now = done.filter("f.open is not null").select("f.open.row", "f.open.p", "f.open.size", "lane", "spread")
    return ups, now.select("lane", "row", "p", "size")


def pivotal_round(units: DataFrame, seed: str = "mix") -> DataFrame:
    """(row): the units rounded up, of units (row, p in (0, 1), size > 0, lane string, spread long); no two have the same row.

    In every lane the sum of p * size is kept but for the last unit's rounding. Only units of one ``lane`` meet; the hash
    ``spread`` deals them into groups: cells of its prefix that hold GROUP units on average whatever a lane's share, then of
    ever shorter prefixes.
    """
    ups, left = _tree(units, seed)
    return ups.unionByName(left.filter(_chance(seed, F.col("row"), F.lit(-2).cast("long")) < F.col("p")).select("row"))


def banded_round(units: DataFrame, lanes: DataFrame, seed: str = "mix") -> DataFrame:
    """(row): as ``pivotal_round`` for units (row, size, lane, spread) whose fraction is their lane's, ``lanes`` (lane, p).

    Bands of sizes are rounded one after the other, the longest first. The unit a band leaves open is paired with the pool of
    all shorter units of its lane, which moves words until the unit is integral and changes the pool's common fraction; so
    long documents leave no error behind, and the last open unit is a short one.
    """
    spread = units.withColumn("band", F.lit(len(BANDS)))
    for number in reversed(range(len(BANDS))):
        spread = spread.withColumn("band", F.when(F.col("size") >= BANDS[number], number).otherwise(F.col("band")))
    spread = stored(spread, "banded")
    below = [F.sum(F.when(F.col("band") > number, F.col("size")).otherwise(0)).cast("double").alias(f"below_{number}") for number in range(len(BANDS) + 1)]
    state = stored(lanes.join(spread.groupBy("lane").agg(*below), "lane"), "lanes")
    n_lanes = state.count()
    ups = None
    for number in range(len(BANDS) + 1):
        own = spread.filter(F.col("band") == number).join(small_side(state.select("lane", "p"), n_lanes), "lane")
        rounded, left = _tree(own.filter((F.col("p") > EPS) & (F.col("p") < 1 - EPS)), f"{seed}-{number}")
        pool = F.col(f"below_{number}")
        up = F.least((1 - F.col("q")) * F.col("s"), F.col("p") * pool)
        down = F.least(F.col("q") * F.col("s"), (1 - F.col("p")) * pool)
        # a pool that can take nothing leaves the unit to chance
        chance = _chance(f"{seed}-pool-{number}", F.col("row"), F.lit(-2).cast("long"))
        stuck = (up + down) <= EPS
        rises = F.when(stuck, chance < F.col("q")).otherwise(chance * (up + down) < down)
        moved = F.when(stuck, F.lit(0.0)).when(rises, up).otherwise(-down)
        after = F.col("q") + moved / F.col("s")
        again = _chance(f"{seed}-last-{number}", F.col("row"), F.lit(-3).cast("long"))
        taken = F.when(stuck, rises).otherwise(again < F.when(after >= 1 - EPS, F.lit(2.0)).when(after <= EPS, F.lit(-1.0)).otherwise(after))
        joined = state.join(left.select("lane", "row", F.col("p").alias("q"), F.col("size").alias("s")), "lane", "left")
        fresh = F.when(F.col("q").isNull() | (pool <= 0), F.col("p")).otherwise(F.least(F.greatest(F.col("p") - moved / pool, F.lit(0.0)), F.lit(1.0)))
        kept = [f"below_{k}" for k in range(len(BANDS) + 1)]
        settled = stored(joined.select("lane", fresh.alias("p"), *kept, F.when(F.col("q").isNotNull() & taken, F.col("row")).alias("up")), "lanes")
        found = rounded.unionByName(own.filter(F.col("p") >= 1 - EPS).select("row")).unionByName(settled.filter("up is not null").select(F.col("up").alias("row")))
        ups = found if ups is None else ups.unionByName(found)
        state = settled.drop("up")
    return ups


#: Rows alike that one task numbers.
ALIKE = 100_000


def _numbered(alike: DataFrame) -> DataFrame:
    """A row for each of the ``n`` rows alike, with its number from 1 (``nth``); very many alike are dealt to tasks in blocks first."""
    every = lambda low, high: F.explode(F.sequence(low, high))
    few = alike.filter(F.col("n") <= ALIKE).withColumn("nth", every(F.lit(1).cast("long"), F.col("n")))
    blocks = alike.filter(F.col("n") > ALIKE).withColumn("block", every(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / ALIKE)))
    # a number of parts of one's own, so that few blocks aren't put together again
    dealt = blocks.repartition(int(alike.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id", "source", "size", "block")
    many = dealt.withColumn("nth", every(F.col("block") * ALIKE + 1, F.least((F.col("block") + 1) * ALIKE, F.col("n"))))
    return few.unionByName(many.drop("block"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST_COPIES, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix") -> DataFrame:
    """(doc_id, size, source_size, target, taken) per row of ``docs``; taken is the row's copies times its size.

    size is the text's number of words (null: 0). A row has floor or ceil of target / source_size copies, so never more than
    ``most``. A rerun takes the same, however the rows are dealt. A null source is a source of its own, the last. Every row is
    rounded by itself: rows with equal ids, null ids among them, are told apart by source and size, and those that are equal in
    all three are counted and numbered, as it doesn't matter which of them is which. A source without words has target 0. An empty
    table gives an empty result; other columns are ignored.
    """
    size = F.regexp_count(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(WORD)).cast("long")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"))
    # rows that are alike are counted, never gathered
    alike = stored(rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")), "sizes")
    sizes = alike.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))
    targets = stored(source_targets(sizes, weights, most), "targets")
    n_sources = targets.count()
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = targets.withColumn("share", share)
    told = small_side(targets.select(F.col("source").alias("own"), "source_size", "target", "share"), n_sources)
    lane = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))
    numbered = _numbered(alike)
    # an id, and a hash of what tells its rows apart
    row = F.struct(F.coalesce("doc_id", F.lit(0)).alias("id"), F.xxhash64(F.col("doc_id").isNull(), lane, F.col("size"), F.col("nth")).alias("tag"))
    joined = numbered.join(told, F.col("source").eqNullSafe(F.col("own"))).drop("own").withColumn("row", row)
    copies = F.floor(F.col("share") + EPS)
    fraction = F.greatest(F.col("share") - copies, F.lit(0.0))
    units = joined.filter((fraction > EPS) & (F.col("size") > 0)).select("row", "size", lane.alias("lane"), F.xxhash64(F.lit(seed), "row").alias("spread"))
    lanes = targets.filter(fraction > EPS).select(lane.alias("lane"), fraction.alias("p"))
    ups = banded_round(units, lanes, seed).select(F.col("row").alias("up"))
    taken = joined.join(ups, F.col("row") == F.col("up"), "left")
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * (copies + F.col("up").isNotNull().cast("int"))).cast("long").alias("taken"))
