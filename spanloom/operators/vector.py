"""Vector analytics: weighted profiles, ranking, leave-one-out, label noise, nearest neighbours.

Sums over vectors run as hash aggregates over (group, dimension), so they combine before the shuffle; scoring against a profile table runs
on Arrow batches as a matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions.vectors import dot, unit
from spanloom.sources.files import private_folder

from .relational import spread_join
from .sequence import fold

#: Bytes of vectors that a table sent to every task, or a block of one, may have.
BLOCK_BYTES = 64 << 20
#: Rows that a table sent to every task may have.
FEW_ROWS = 20_000
#: Scores worked out together.
SCORES = 4 << 20
#: Items for each slice that meets a block.
SLICE_ITEMS = 65_536
#: Items and queries of a block of a blocked search; a task holds a block's queries and streams its items.
BLOCK_ITEMS, BLOCK_QUERIES = 65_536, 4_096


def _few_rows(table: DataFrame, order: Sequence[str], vector: str) -> list | None:
    """The rows of a table in order, if they are few enough to be sent to every task; at most FEW_ROWS + 1 are looked at."""
    rows = table.orderBy(*order).limit(FEW_ROWS + 1).collect()
    return rows if len(rows) <= FEW_ROWS and sum(8 * len(r[vector]) + 64 for r in rows) <= BLOCK_BYTES else None


def _blocks_of(table: DataFrame, vector: str) -> int:
    """How many blocks of BLOCK_BYTES the vectors of a table make."""
    size = table.select(F.sum(F.size(vector)).alias("n"), F.count("*").alias("rows")).first()
    return max(1, -(-(8 * (size["n"] or 0) + 64 * size["rows"]) // BLOCK_BYTES))


def _best_of(score: np.ndarray, top: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row the places of its ``top`` greatest scores, greatest first, equals by place."""
    if score.shape[1] <= max(64, 4 * top):
        yield from enumerate(np.argsort(-score, axis=1, kind="stable")[:, :top])
        return
    least = np.partition(score, score.shape[1] - top, axis=1)[:, score.shape[1] - top]
    for k in range(score.shape[0]):
        at = np.flatnonzero(score[k] >= least[k])
        yield k, at[np.argsort(-score[k, at], kind="stable")[:top]]


class _Table:
    """Vectors of labels in order; a label's score is its vector's, its best exemplar's, or the mean of that and its profile's."""

    def __init__(self, labels: list, vectors: np.ndarray, whole: np.ndarray, mode: str):
        # rows sorted by label; ``whole`` marks profiles where mode is blend
        self.names, first = [], []
        kept = ~whole
        own = [x for x, k in zip(labels, kept, strict=True) if k]
        for k, x in enumerate(own):
            if not k or x != own[k - 1]:
                self.names.append(x)
                first.append(k)
        self.starts, self.samples = np.array(first, np.int64), vectors[kept]
        self.plain = len(first) == len(own)
        means = dict(zip((x for x, w in zip(labels, whole, strict=True) if w), vectors[whole], strict=True))
        self.means = np.array([means[x] for x in self.names]) if mode == "blend" and self.names else None

    def ranked(self, x: np.ndarray, top: int, digits: int) -> Iterator[tuple[np.ndarray, list, np.ndarray]]:
        """(row, labels, scores) of the best labels of each row of ``x``, some rows' scores at a time."""
        if not self.names:
            return
        step = max(1, SCORES // self.samples.shape[0])
        for a in range(0, len(x), step):
            some = x[a : a + step]
            score = some @ self.samples.T
            if not self.plain:
                score = np.maximum.reduceat(score, self.starts, axis=1)
            if self.means is not None:
                score = (score + some @ self.means.T) / 2
            score = np.round(score, digits)
            for k, best in _best_of(score, top):
                yield a + k, [self.names[j] for j in best], score[k, best]


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.asarray(batch.column(name).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(batch.num_rows, -1)


def _ranked_by(items: DataFrame, key: str, vector: str, table: DataFrame, label: str, top: int, digits: int, mode: str = "exemplar", group: str | None = None) -> DataFrame:
    """(key, rank_no, label, score): the ``top`` labels of each row of ``items`` by ``table`` (label, __v, __whole, and a ``group`` that both sides have).

    A table of one block goes to all tasks. Else its labels are dealt into blocks and the items into slices; a task holds a block, streams
    its slice's items past it and keeps each one's best; the best of the blocks are ranked together. No block or score matrix grows
    with either side.
    """
    spark = items.sparkSession
    key_type, label_type = items.schema[key].dataType.simpleString(), table.schema[label].dataType.simpleString()
    parts = [group] if group else []
    sized = lambda labels, kinds: pa.array(labels).cast(kinds) if labels else pa.array([], kinds)

    def built(rows: list[tuple]) -> _Table:
        return _Table([r[0] for r in rows], np.array([r[1] for r in rows], np.float64), np.array([bool(r[2]) for r in rows]), mode)

    few = _few_rows(table.select(*parts, label, "__v", "__whole"), [*parts, label], "__v")
    if few is not None:
        found: dict = {}
        for *g, name, v, whole in few:
            found.setdefault(tuple(g), []).append((name, v, whole))
        model = spark.sparkContext.broadcast(found)
        arrow = {"int": pa.int32(), "bigint": pa.int64()}.get(label_type, pa.string())

        def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables = {g: built(rows) for g, rows in model.value.items()}
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _matrix(batch, vector)
                of = list(zip(batch.column(group).to_pylist(), strict=True)) if group else [()] * len(x)
                for g in set(of) & set(tables):
                    at = np.array([k for k, one in enumerate(of) if one == g])
                    rows, ranks, labels, scores = [], [], [], []
                    for k, names, score in tables[g].ranked(x[at], top, digits):
                        rows += [at[k]] * len(names)
                        ranks += range(1, len(names) + 1)
                        labels += names
                        scores.append(score)
                    if rows:
                        yield pa.record_batch({key: batch.column(key).take(pa.array(rows)), "rank_no": pa.array(ranks, pa.int32()), label: sized(labels, arrow), "score": np.concatenate(scores)})

        return items.select(key, vector, *parts).filter(F.col(vector).isNotNull()).mapInArrow(scored, f"`{key}` {key_type}, rank_no int, `{label}` {label_type}, score double")

    blocks = _blocks_of(table, "__v")
    slices = max(1, min(items.count() // SLICE_ITEMS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    numbered = items.filter(F.col(vector).isNotNull()).select(F.monotonically_increasing_id().alias("__row"), F.col(key).alias("__key"), F.col(vector).cast("array<double>").alias("__v"), *parts)
    right = table.select(F.pmod(F.xxhash64(label), F.lit(blocks)).cast("int").alias("__b"), every(slices).alias("__s"), F.lit(0).alias("__side"), F.col(label).alias("__l"), F.col("__v").cast("array<double>").alias("__v"), "__whole", *parts)
    left = numbered.select(every(blocks).alias("__b"), F.pmod(F.xxhash64("__row"), F.lit(slices)).cast("int").alias("__s"), F.lit(1).alias("__side"), "__row", "__key", "__v", *parts)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, model = None, [], None
        for batch in batches:
            places = list(zip(*(batch.column(c).to_pylist() for c in (*parts, "__b", "__s")), strict=True))
            side = batch.column("__side").to_pylist()
            begin = 0
            while begin < len(places):
                end = begin
                while end < len(places) and places[end] == places[begin] and side[end] == side[begin]:
                    end += 1
                some = batch.slice(begin, end - begin)
                if places[begin] != now:
                    now, held, model = places[begin], [], None
                if side[begin] == 0:
                    held += zip(some.column("__l").to_pylist(), some.column("__v").to_pylist(), some.column("__whole").to_pylist(), strict=True)
                elif held:
                    if model is None:
                        model, held = built(held), [None]
                    rows, labels, scores = [], [], []
                    for k, names, score in model.ranked(_matrix(some, "__v"), top, digits):
                        rows += [k] * len(names)
                        labels += names
                        scores.append(score)
                    if rows:
                        at = pa.array(rows)
                        yield pa.record_batch({"__row": some.column("__row").take(at), "__key": some.column("__key").take(at), "__l": pa.array(labels, batch.schema.field("__l").type), "score": np.concatenate(scores)})
                begin = end

    dealt = right.unionByName(left, allowMissingColumns=True)
    found = dealt.repartition(*parts, "__b", "__s").sortWithinPartitions(*parts, "__b", "__s", "__side", "__l").mapInArrow(best, f"__row long, __key {key_type}, __l {label_type}, score double")
    order = Window.partitionBy("__row").orderBy(F.desc("score"), "__l")
    ranked = found.withColumn("rank_no", F.row_number().over(order)).filter(F.col("rank_no") <= top)
    return ranked.select(F.col("__key").alias(key), "rank_no", F.col("__l").alias(label), "score")


def weighted_sums(df: DataFrame, keys: Sequence[str], vector: str, weight: Column | None = None) -> DataFrame:
    """(keys, dim, wx, w, n): per dimension the sums of weight * value and of weight, and the rows."""
    w = weight if weight is not None else F.lit(1.0)
    long = df.select(*keys, w.cast("double").alias("w"), F.posexplode(vector).alias("dim", "x"))
    return long.groupBy(*keys, "dim").agg(F.sum(F.col("w") * F.col("x").cast("double")).alias("wx"), F.sum("w").alias("w"), F.count("*").alias("n"))


def profiles(df: DataFrame, keys: Sequence[str], vector: str, weight: Column | None = None, out: str = "profile") -> DataFrame:
    """(keys, profile, n): the unit weighted mean vector of each group."""
    sums = weighted_sums(df, keys, vector, weight).withColumn("m", F.col("wx") / F.greatest(F.col("w"), F.lit(1e-9)))
    packed = sums.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("dim", "m"))), lambda x: x["m"]).alias("__m"), F.max("n").alias("n"))
    return packed.select(*keys, unit(F.col("__m")).alias(out), "n")


def rank_profiles(items: DataFrame, key: str, vector: str, profile_table: DataFrame, label: str, profile: str, top: int, digits: int = 6) -> DataFrame:
    """(key, rank_no, label, score): the ``top`` profiles of each item by inner product, equals by label; any number of profiles."""
    table = profile_table.filter(F.col(profile).isNotNull()).select(label, F.col(profile).alias("__v"), F.lit(False).alias("__whole"))
    return _ranked_by(items, key, vector, table, label, top, digits)


def rank_exemplars(items: DataFrame, key: str, vector: str, exemplar_table: DataFrame, label: str, exemplar: str, profile_table: DataFrame | None, top: int, mode: str = "exemplar", digits: int = 6) -> DataFrame:
    """(key, rank_no, label, score): as ``rank_profiles``, an item's score for a label being that of the label's best exemplar (mode exemplar),
    or the mean of that and its profile's (mode blend; ``profile_table`` has (label, profile)).

    A label's exemplars are in one block, so its best is known there; any number of labels.
    """
    if mode not in ("exemplar", "blend"):
        raise ValueError(f"unknown mode {mode}")
    table = exemplar_table.select(label, F.col(exemplar).cast("array<double>").alias("__v"), F.lit(False).alias("__whole"))
    if mode == "blend":
        named, value = profile_table.columns[:2]
        table = table.unionByName(profile_table.select(F.col(named).alias(label), F.col(value).cast("array<double>").alias("__v"), F.lit(True).alias("__whole")))
    return _ranked_by(items, key, vector, table, label, top, digits, mode)


def rolling_profiles(labelled: DataFrame, keys: Sequence[str], period: str, vector: str, weight: Column, half_life: float = 3.0, out: str = "profile") -> DataFrame:
    """(keys, period, profile, n): for each period with labelled items, each group's unit weighted mean over all items up to and with it.

    An item weighs ``weight``, halved for every ``half_life`` periods of age. A group's sums of each period are folded in order: what is older
    is scaled down when a period has items of its own, so a sum is never larger than what it sums, however many periods there are,
    and a period without items keeps the profile. Nothing is fitted again; a task holds one group's state.
    """
    keys = list(keys)
    sums = weighted_sums(labelled.filter(F.col(vector).isNotNull() & F.col(period).isNotNull()), [*keys, period], vector, weight)
    own = sums.groupBy(*keys, period).agg(F.transform(F.sort_array(F.collect_list(F.struct("dim", "wx"))), lambda x: x["wx"]).alias("__x"), F.max("w").alias("__w"), F.max("n").alias("__n"))
    # every group at every period of its own and of others: its state holds on
    periods = labelled.select(period).filter(F.col(period).isNotNull()).distinct()
    frame = own.select(*keys).distinct().join(F.broadcast(periods)).join(own, [*keys, period], "left")  # periods are few, a row each

    def state(rows: Iterator[tuple]) -> Iterator[tuple]:
        total, last, seen = None, None, 0
        for p, x, w, n in rows:
            if x is not None:
                x = np.array(x, np.float64)
                if total is None or w > 0:
                    total, last = (x if total is None else total * 2.0 ** (float(last - p) / half_life) + x), p
                seen += n
            if total is not None:
                yield p, total.tolist(), seen

    kind = labelled.schema[period].dataType.simpleString()
    folded = fold(frame, keys, [period], [period, "__x", "__w", "__n"], state, f"{period} {kind}, __x array<double>, __n long")
    return folded.select(*keys, period, unit(F.col("__x")).alias(out), F.col("__n").alias("n"))


def rolling_rank(items: DataFrame, key: str, period: str, vector: str, profile_table: DataFrame, label: str, profile: str, top: int, digits: int = 6) -> DataFrame:
    """(key, rank_no, label, score): each item ranked by the profiles (label, period, profile) of the last period before its own; none before the first.

    A period's profiles are a table of their own; any number of periods and labels.
    """
    known = profile_table.select(F.col(period).alias("__p")).filter("__p is not null").distinct()
    # the last known period before each period that items have: an as-of lookup among periods
    asked = items.select(F.col(period).alias("__p")).filter("__p is not null").distinct()
    both = known.select("__p", F.lit(0).alias("ask")).unionByName(asked.select("__p", F.lit(1).alias("ask"))).groupBy("__p").agg(F.max("ask").alias("ask"), F.min("ask").alias("known"))
    # periods are few, a row each
    last = F.last(F.when(F.col("known") == 0, F.col("__p")), ignorenulls=True).over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))
    before = both.withColumn("__of", last).filter("ask = 1 and __of is not null").select(F.col("__p").alias(period), "__of")
    placed = items.select(key, period, vector).join(F.broadcast(before), period)
    table = profile_table.select(label, F.col(profile).alias("__v"), F.lit(False).alias("__whole"), F.col(period).alias("__of"))
    return _ranked_by(placed, key, vector, table, label, top, digits, group="__of")


def left_out_profiles(labelled: DataFrame, keys: Sequence[str], period: str, vector: str, weight: Column, out: str = "profile") -> DataFrame:
    """(keys, period, profile, n): for each period and group the unit weighted mean over the items of all other periods: the group's sums less the period's."""
    keys = list(keys)
    own = weighted_sums(labelled, [*keys, period], vector, weight)
    periods = labelled.select(period).distinct()
    whole = own.groupBy(*keys, "dim").agg(F.sum("wx").alias("__x"), F.sum("w").alias("__w"), F.sum("n").alias("__n"))
    rest = whole.join(F.broadcast(periods)).join(own, [*keys, "dim", period], "left")  # periods are few
    less = rest.select(*keys, period, "dim", (F.col("__x") - F.coalesce("wx", F.lit(0.0))).alias("wx"), (F.col("__w") - F.coalesce("w", F.lit(0.0))).alias("w"), (F.col("__n") - F.coalesce("n", F.lit(0))).alias("n")).filter("n > 0")
    packed = less.withColumn("m", F.col("wx") / F.greatest(F.col("w"), F.lit(1e-9))).groupBy(*keys, period).agg(F.transform(F.sort_array(F.collect_list(F.struct("dim", "m"))), lambda x: x["m"]).alias("__m"), F.max("n").alias("n"))
    return packed.select(*keys, period, unit(F.col("__m")).alias(out), "n")


def label_scores(items: DataFrame, key: str, vector: str, label: str, profile_table: DataFrame, profile: str, digits: int = 6) -> DataFrame:
    """(key, score): each item's inner product with the profile of the one label it names; null if the label has none."""
    own = profile_table.select(label, F.col(profile).alias("__p"))
    return items.select(key, label, vector).join(own, label, "left").select(key, F.round(dot(F.col(vector), F.col("__p")), digits).alias("score"))


def decide(ranked: DataFrame, key: str, label: str, accept: float = 0.55, margin: float = 0.08, floor: float = 0.35) -> DataFrame:
    """(key, label, top1, top2, decision): below the floor no_candidate, accepted with a margin auto, else low_margin. Without a second candidate top2 is -1."""
    best = ranked.groupBy(key).agg(
        F.max(F.when(F.col("rank_no") == 1, F.col(label))).alias(label), F.max(F.when(F.col("rank_no") == 1, F.col("score"))).alias("top1"), F.coalesce(F.max(F.when(F.col("rank_no") == 2, F.col("score"))), F.lit(-1.0)).alias("top2")
    )
    decision = F.when(F.col("top1") < floor, F.lit("no_candidate")).when((F.col("top1") >= accept) & (F.round(F.col("top1") - F.col("top2"), 6) >= margin), F.lit("auto")).otherwise(F.lit("low_margin"))
    return best.withColumn("decision", decision)


def leave_one_out(items: DataFrame, key: str, label: str, vector: str, digits: int = 6) -> DataFrame:
    """(key, label, pred, sim, sim_true, margin): each item against every label's mean, its own label's without it.

    The mean without an item is the label's sum less the item, so nothing is fitted again; an item alone in its label has no
    sim_true. Other labels are ranked by their sums, any number of them, and the item's own meets it by label.
    """
    known = items.select(key, label, vector).filter(F.col(vector).isNotNull() & F.col(label).isNotNull())
    sums = weighted_sums(known, [label], vector)
    totals = sums.groupBy(label).agg(F.transform(F.sort_array(F.collect_list(F.struct("dim", "wx"))), lambda x: x["wx"]).alias("__s"), F.max("n").alias("__n"))
    few = _few_rows(totals, [label], "__s")
    return _left_out_of_many(known, totals, key, label, vector, digits) if few is None else _left_out_of_few(known, few, key, label, vector, digits)


def _left_out_of_few(known: DataFrame, packed: list, key: str, label: str, vector: str, digits: int) -> DataFrame:
    """``leave_one_out`` where the labels' sums are one block, sent to all tasks."""
    names = [r[0] for r in packed]
    model = known.sparkSession.sparkContext.broadcast((np.array([r[1] for r in packed], np.float64), np.array([r[2] for r in packed], np.float64)))
    number = {x: k for k, x in enumerate(names)}
    key_type, label_type = known.schema[key].dataType.simpleString(), known.schema[label].dataType.simpleString()

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, count = model.value
        step = max(1, SCORES // max(1, len(total)))
        for pdf in (whole.iloc[a : a + step] for whole in batches for a in range(0, len(whole), step)):
            x = np.stack(pdf[vector].to_numpy()).astype(np.float64)
            own = pdf[label].map(number).to_numpy()
            at = np.arange(len(x))
            score = x @ total.T / np.maximum(np.linalg.norm(total, axis=1), 1e-9)
            rest = total[own] - x
            left = count[own] > 1
            score[at, own] = np.where(left, np.einsum("ij,ij->i", x, rest) / (np.linalg.norm(rest, axis=1) + 1e-9), -np.inf)
            score = np.round(score, digits)
            best = score.argmax(axis=1)
            second = np.partition(np.c_[score, np.full(len(x), -np.inf)], -2, axis=1)[:, -2]
            yield pd.DataFrame({key: pdf[key], label: pdf[label], "pred": [names[b] for b in best], "sim": score[at, best], "sim_true": np.where(left, score[at, own], np.nan), "margin": np.round(score[at, best] - second, digits)})

    found = known.mapInPandas(scored, f"{key} {key_type}, {label} {label_type}, pred {label_type}, sim double, sim_true double, margin double")
    return found.withColumn("sim_true", F.when(~F.isnan("sim_true"), F.col("sim_true")))


def _left_out_of_many(known: DataFrame, totals: DataFrame, key: str, label: str, vector: str, digits: int) -> DataFrame:
    """``leave_one_out`` in blocks of labels: the three best of all sums hold the two best others, and the own one is worked out beside them."""
    spark = known.sparkSession
    path = private_folder(spark, "loo")
    known.select(F.monotonically_increasing_id().alias("__row"), F.col(key).alias("__key"), F.col(label).alias("__l"), F.col(vector).cast("array<double>").alias("__x")).write.parquet(path)  # settles the numbers
    rows = spark.read.parquet(path)
    length = F.sqrt(F.aggregate("__s", F.lit(0.0), lambda acc, x: acc + x * x))
    table = totals.select(F.col(label).alias("__o"), F.transform("__s", lambda x: x / F.greatest(length, F.lit(1e-9))).alias("__v"), F.lit(False).alias("__whole"))
    ranked = _ranked_by(rows.select("__row", "__x"), "__row", "__x", table, "__o", 3, digits)
    own = spread_join(rows, totals.select(F.col(label).alias("__l"), "__s", "__n"), "__l")
    rest = F.zip_with("__s", "__x", lambda a, b: a - b)
    own = own.withColumn("__rest", rest).select("__row", "__key", "__l", F.when(F.col("__n") > 1, F.round(dot(F.col("__x"), F.col("__rest")) / (F.sqrt(F.aggregate("__rest", F.lit(0.0), lambda acc, x: acc + x * x)) + 1e-9), digits)).alias("sim_true"))
    told = lambda score, name: F.struct((-score).alias("minus"), name.alias("name"))
    others = ranked.join(rows.select("__row", "__l"), "__row").filter(F.col("__o") != F.col("__l")).groupBy("__row").agg(F.slice(F.sort_array(F.collect_list(told(F.col("score"), F.col("__o")))), 1, 2).alias("__b"))
    mine = F.when(F.col("sim_true").isNotNull(), F.array(told(F.col("sim_true"), F.col("__l")))).otherwise(F.slice("__b", 1, 0))
    best = own.join(others, "__row").withColumn("__b", F.array_sort(F.concat("__b", mine)))
    first, second = F.col("__b")[0], F.col("__b")[1]
    return best.select(F.col("__key").alias(key), F.col("__l").alias(label), first["name"].alias("pred"), (-first["minus"]).alias("sim"), "sim_true", F.round(second["minus"] - first["minus"], digits).alias("margin"))


def consistency(items: DataFrame, key: str, label: str, vector: str, duration: str, tolerance: float = 0.10, least_items: int = 5, least_duration: float = 15.0) -> DataFrame:
    """(key, first_pass, dropped): items whose own label looks wrong by leave-one-out, and those still wrong against the cleaned means.

    Only labels with enough items and duration are judged; with fewer than two such labels none is.
    """
    judged = items.groupBy(label).agg(F.count("*").alias("n"), F.sum(duration).alias("d")).filter((F.col("n") >= least_items) & (F.col("d") >= least_duration)).select(label)
    if judged.limit(2).count() < 2:
        return items.select(key).limit(0).withColumns({"first_pass": F.lit(True), "dropped": F.lit(True)})
    pool = items.join(judged, label)
    loo = leave_one_out(pool, key, label, vector)
    first = loo.filter((F.col("pred") != F.col(label)) & (F.round(F.col("sim") - F.col("sim_true"), 6) > tolerance)).select(key)
    clean = profiles(pool.join(first, key, "left_anti"), [label], vector)
    doubted = pool.join(first, key, "left_semi")
    best = rank_profiles(doubted, key, vector, clean.withColumnRenamed(label, "other"), "other", "profile", 1).select(key, F.col("score").alias("best"))
    own = label_scores(doubted, key, vector, label, clean, "profile").withColumnRenamed("score", "own").join(best, key)
    return own.select(key, F.lit(True).alias("first_pass"), (F.coalesce(F.round(F.col("best") - F.col("own"), 6), F.lit(9.0)) > tolerance).alias("dropped"))


def nearest_in_blocks(items: DataFrame, key: str, vector: str, queries: DataFrame, digits: int = 6) -> DataFrame:
    """(key, other, score): for each query row the most similar other item. A stated query set against all items, in blocks.

    Items and queries are dealt into blocks by their numbers, and each pair of blocks is one group: a task holds the group's
    queries, streams its items past them and keeps the best; the best of the groups wins, equals by least other key.
    """
    across = max(1, -(-items.count() // BLOCK_ITEMS), min(items.count() // 64, int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    down = max(1, -(-queries.count() // BLOCK_QUERIES))
    block = lambda n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    sides = queries.select(block(down).alias("down"), every(across).alias("across"), F.lit(0).alias("side"), key, vector).unionByName(
        items.select(every(down).alias("down"), block(across).alias("across"), F.lit(1).alias("side"), key, vector)
    )

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, q, names, top, other = None, [], None, None, None, None

        def told() -> Iterator[pa.RecordBatch]:
            if q is not None:
                found = top > -np.inf
                yield pa.record_batch({key: names[found], "other": other[found], "score": top[found]})

        for batch in batches:
            group = batch.column("down").to_numpy().astype(np.int64) << 32 | batch.column("across").to_numpy()
            side, ids = batch.column("side").to_numpy(), batch.column(key).to_numpy()
            x = np.asarray(batch.column(vector).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(batch.num_rows, -1)
            ends = np.flatnonzero(np.r_[(group[1:] != group[:-1]) | (side[1:] != side[:-1]), True]) + 1
            for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                if group[a] != now:
                    yield from told()
                    now, held, q = group[a], [], None
                if side[a] == 0:
                    held.append((ids[a:b], x[a:b]))
                    continue
                if not held:
                    continue
                if q is None:
                    names, q = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
                    top, other = np.full(names.size, -np.inf), np.zeros(names.size, np.int64)
                score = np.round(q @ x[a:b].T, digits)
                score[names[:, None] == ids[None, a:b]] = -np.inf
                most = score.max(axis=1)
                least = np.where(score == most[:, None], ids[None, a:b], np.iinfo(np.int64).max).min(axis=1)
                better = (most > top) | ((most == top) & (least < other))
                top, other = np.where(better, most, top), np.where(better, least, other)
        yield from told()

    found = sides.repartition("down", "across").sortWithinPartitions("down", "across", "side").mapInArrow(best, f"{key} long, other long, score double")
    first = found.groupBy(key).agg(F.min(F.struct((-F.col("score")).alias("minus"), F.col("other"))).alias("b"))
    return first.select(key, F.col("b.other").alias("other"), (-F.col("b.minus")).alias("score"))


def exemplars(items: DataFrame, key: str, label: str, vector: str, size: str, k: int) -> DataFrame:
    """(label, key, pick): up to ``k`` items of each label, the one of greatest ``size`` first, then always the one farthest (by cosine) from those picked.

    Each pick is one aggregate over all items, which carry only their distance so far: no label is gathered anywhere.
    """
    now = items.select(key, label, vector, size, F.lit(2.0).alias("far"))
    picks = None
    for number in range(1, k + 1):
        rank = F.struct((-F.col(size)).alias("minus"), F.col(key)) if number == 1 else F.struct((-F.round("far", 6)).alias("minus"), F.col(key))
        best = now.filter("far > -1").groupBy(label).agg(F.min(F.struct(rank.alias("r"), F.col(vector))).alias("b")).select(label, F.col(f"b.r.{key}").alias("__k"), F.col(f"b.{vector}").alias("__v"))
        own = best.select(label, F.col("__k").alias(key), F.lit(number).alias("pick"))
        picks = own if picks is None else picks.unionByName(own)
        near = 1 - dot(F.col(vector), F.col("__v"))
        now = now.join(best, label).select(key, label, vector, size, F.when(F.col(key) == F.col("__k"), -2.0).otherwise(F.least("far", near)).alias("far"))
    return picks


def with_fallback(wanted: DataFrame, table: DataFrame, key: str, domain: str, value: str, order: Sequence) -> DataFrame:
    """``wanted`` (key, domain) with the value of its own domain, else of the first domain in ``order`` that has one, and which one it was."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col("__d"))
    there = table.select(key, F.col(domain).alias("__d"), F.col(value).alias("__v"))
    best = F.min_by(F.struct("__d", "__v"), F.when(F.col("__d") == F.col(domain), 0).otherwise(place)).alias("b")
    return wanted.join(there, key, "left").groupBy(key, domain).agg(best).select(key, domain, F.col("b.__d").alias("used_domain"), F.col("b.__v").alias(value))


def contrast(left: DataFrame, right: DataFrame, key: str, vector: str, profile_table: DataFrame, label: str, profile: str) -> DataFrame:
    """(key, left_label, right_label, contrast): how much better two halves (key, vector) fit two different labels than each other's."""
    a, b = (rank_profiles(side, key, vector, profile_table, label, profile, 1).select(key, F.col(label).alias(f"{n}_label"), F.col("score").alias(f"{n}_score")) for side, n in ((left, "l"), (right, "r")))
    top = a.join(b, key).filter("l_label <> r_label")
    across = lambda side, other, out: label_scores(side.select(key, vector).join(top.select(key, F.col(other).alias(label)), key), key, vector, label, profile_table, profile).withColumnRenamed("score", out)
    cross = top.join(across(left, "r_label", "lr"), key).join(across(right, "l_label", "rl"), key)
    return cross.select(key, F.col("l_label").alias("left_label"), F.col("r_label").alias("right_label"), F.round(F.col("l_score") - F.col("lr") + F.col("r_score") - F.col("rl"), 6).alias("contrast"))


def expanding_and_left_out(df: DataFrame, keys: Sequence[str], period: str, value: str) -> DataFrame:
    """(keys, period, own, earlier, others): a period's mean, that of all earlier ones, and that of all others, from one aggregate."""
    sums = df.groupBy(*keys, period).agg(F.sum(value).alias("s"), F.count(value).alias("n"))
    past = Window.partitionBy(*keys).orderBy(period).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    zero = lambda c: F.nullif(c, F.lit(0))
    return sums.select(
        *keys, period, (F.col("s") / F.col("n")).alias("own"), (F.sum("s").over(past) / zero(F.sum("n").over(past))).alias("earlier"),
        ((F.sum("s").over(whole) - F.col("s")) / zero(F.sum("n").over(whole) - F.col("n"))).alias("others"),
    )
