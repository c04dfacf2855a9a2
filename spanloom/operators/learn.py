"""A ridge logistic model fitted by Newton steps; each step's gradient and Hessian are one Spark aggregate."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.numbers import sigmoid


@dataclass
class Logistic:
    """Coefficients over standardised features."""

    features: list[str]
    mean: list[float]
    sd: list[float]
    coef: list[float]
    bias: float

    def score(self) -> Column:
        """The probability, as an expression over the feature columns; a null feature counts as its mean."""
        total = F.lit(float(self.bias))
        for name, m, s, c in zip(self.features, self.mean, self.sd, self.coef, strict=True):
            total = total + (F.coalesce(F.col(name).cast("double"), F.lit(float(m))) - float(m)) / float(s) * float(c)
        return sigmoid(total)


def standardise(df: DataFrame, features: Sequence[str]) -> tuple[list[float], list[float]]:
    """Means and population deviations (those near 0 count as 1), in one aggregate."""
    row = df.agg(*(F.avg(f).alias(f"m{k}") for k, f in enumerate(features)), *(F.stddev_pop(f).alias(f"s{k}") for k, f in enumerate(features))).first()
    sd = [row[f"s{k}"] or 0.0 for k in range(len(features))]
    return [row[f"m{k}"] or 0.0 for k in range(len(features))], [s if s >= 1e-9 else 1.0 for s in sd]


def fit_logistic(df: DataFrame, features: Sequence[str], label: str, l2: float = 1.0, weight: str | None = None, steps: int = 50, tolerance: float = 1e-7) -> Logistic:
    """Newton's method on standardised features, the bias unpenalised; (d + 1)^2 sums come to the driver a step."""
    features = list(features)
    mean, sd = standardise(df, features)
    xs = [F.lit(1.0)] + [(F.coalesce(F.col(f).cast("double"), F.lit(m)) - m) / s for f, m, s in zip(features, mean, sd, strict=True)]
    d = len(xs)
    own = df.select(F.array(*xs).alias("x"), F.col(label).cast("double").alias("y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"))
    beta, ridge = np.zeros(d), np.diag([0.0] + [l2] * (d - 1))
    pairs = [(a, b) for a in range(d) for b in range(a, d)]
    for _ in range(steps):
        total = sum((F.col("x")[k] * float(beta[k]) for k in range(d)), F.lit(0.0))
        scored = own.withColumn("p", sigmoid(total)).withColumns({"g": F.col("w") * (F.col("y") - F.col("p")), "h": F.col("w") * F.col("p") * (1 - F.col("p"))})
        sums = scored.agg(*(F.sum(F.col("g") * F.col("x")[k]).alias(f"g{k}") for k in range(d)), *(F.sum(F.col("h") * F.col("x")[a] * F.col("x")[b]).alias(f"h{a}_{b}") for a, b in pairs)).first()
        gradient = np.array([sums[f"g{k}"] or 0.0 for k in range(d)]) - ridge @ beta
        hessian = ridge.copy()
        for a, b in pairs:
            hessian[a, b] += sums[f"h{a}_{b}"] or 0.0
            hessian[b, a] = hessian[a, b]
        move = np.linalg.solve(hessian + 1e-9 * np.eye(d), gradient)
        beta = beta + move
        if np.abs(move).max() < tolerance:
            break
    return Logistic(features, mean, sd, beta[1:].tolist(), float(beta[0]))


def left_out_scores(df: DataFrame, group: str, features: Sequence[str], label: str, l2: float = 1.0, steps: int = 50, tolerance: float = 1e-7, out: str = "p", only: Column | None = None) -> DataFrame:
    """``df`` with ``out``: each row's probability by the model fitted on the rows of all other groups; null where those have one label only.

    All groups' models take their Newton steps together. A task holds a batch of rows and the models: what the batch adds to all models' sums is
    a few matrix products (see ``_step_sums``), no row is copied for a group; the tasks' sums meet by model, where the step is solved, and
    only coefficients come to the driver. With ``only`` the models learn from the rows where it holds. Rows without a group or a label
    aren't learnt from.
    """
    learn = (F.lit(True) if only is None else F.coalesce(only, F.lit(False))) & F.col(label).isNotNull()
    features = list(features)
    d = len(features) + 1
    x = [F.col(f).cast("double") for f in features]
    masked = [F.when(learn, c) for c in x]
    sums = [*(F.sum(c).alias(f"s{k}") for k, c in enumerate(masked)), *(F.sum(c * c).alias(f"q{k}") for k, c in enumerate(masked)), *(F.count(c).alias(f"n{k}") for k, c in enumerate(masked))]
    per = df.filter(F.col(group).isNotNull()).groupBy(group).agg(F.count_if(learn).alias("n"), F.sum(F.when(learn, F.col(label).cast("double"))).alias("y"), *sums)
    rows = per.orderBy(group).collect()  # a row a group, as the models
    total = lambda name: np.array([r[name] or 0 for r in rows], np.float64)
    rest = lambda name: total(name).sum() - total(name)
    usable = [k for k, (n, y) in enumerate(zip(rest("n"), rest("y"), strict=True)) if 0 < y < n]
    mean = np.array([rest(f"s{k}") / np.maximum(rest(f"n{k}"), 1) for k in range(d - 1)]).reshape(d - 1, len(rows)).T
    sd = np.sqrt(np.maximum(np.array([rest(f"q{k}") / np.maximum(rest(f"n{k}"), 1) for k in range(d - 1)]).reshape(d - 1, len(rows)).T - mean**2, 0))
    sd[sd < 1e-9] = 1.0
    beta = np.zeros((len(rows), d))
    spark = df.sparkSession
    name_type = df.schema[group].dataType.simpleString()
    number = spark.createDataFrame([(r[group], k) for k, r in enumerate(rows)], f"__g {name_type}, __k int")
    learnt = df.filter(learn & F.col(group).isNotNull()).select(F.col(group).alias("__g"), F.array(*x).alias("x"), F.col(label).cast("double").alias("y")).join(F.broadcast(number), "__g").select("__k", "x", "y")
    open_ = list(usable)
    for _ in range(steps if usable else 0):
        moves = _newton_moves(learnt, open_, mean, sd, beta, l2)
        for k, move in moves.items():
            beta[k] += move
        open_ = [k for k in open_ if np.abs(moves[k]).max() >= tolerance]
        if not open_:
            break
    made = [(rows[k][group], mean[k].tolist(), sd[k].tolist(), beta[k].tolist()) for k in usable]
    models = F.broadcast(spark.createDataFrame(made, f"__g {name_type}, __m array<double>, __s array<double>, __b array<double>"))
    z = [F.lit(1.0)] + [(F.coalesce(c, F.col("__m")[k]) - F.col("__m")[k]) / F.col("__s")[k] for k, c in enumerate(x)]
    score = sum((F.col("__b")[k] * v for k, v in enumerate(z)), F.lit(0.0))
    return df.join(models, F.col(group) == F.col("__g"), "left").select(*df.columns, F.when(F.col("__g").isNotNull(), sigmoid(score)).alias(out))


#: Models whose sums a task keeps together, and numbers of a product of rows and models.
PACK_MODELS, PRODUCT = 2_000, 2 << 20


def _step_sums(x: np.ndarray, y: np.ndarray, own: np.ndarray, maps: np.ndarray, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What rows add to the gradients and Hessians of models, each row to all models but the one (or none: -1) that leaves it out.

    A model's standardised features are a linear map of 1, the values (0 for null) and what isn't null, so all its sums come of sums in
    those: scores, gradients and Hessians are one product each of rows and models.
    """
    known = ~np.isnan(x)
    plain = np.c_[np.ones(len(x)), np.where(known, x, 0.0), known]
    p = 1 / (1 + np.exp(-np.clip(plain @ np.einsum("gzd,gz->dg", maps, beta), -700, 700)))
    hit = np.flatnonzero(own >= 0)
    miss, spread = y[:, None] - p, p * (1 - p)
    miss[hit, own[hit]] = spread[hit, own[hit]] = 0.0
    a, b = np.triu_indices(plain.shape[1])
    return (plain.T @ miss).T, ((plain[:, a] * plain[:, b]).T @ spread).T


def _newton_moves(learnt: DataFrame, open_: list[int], mean: np.ndarray, sd: np.ndarray, beta: np.ndarray, l2: float) -> dict[int, np.ndarray]:
    """The Newton step of each open model (by number); ``learnt`` has (__k, x, y), __k the number of the model that leaves the row out."""
    moves: dict[int, np.ndarray] = {}
    d = beta.shape[1]
    wide = 2 * d - 1
    for pack in (open_[k : k + PACK_MODELS] for k in range(0, len(open_), PACK_MODELS)):
        maps = np.zeros((len(pack), d, wide))
        maps[:, 0, 0] = 1
        for j in range(d - 1):
            maps[:, j + 1, j + 1] = 1 / sd[pack, j]
            maps[:, j + 1, d + j] = -mean[pack, j] / sd[pack, j]
        place = np.full(len(mean), -1, np.int64)
        place[pack] = np.arange(len(pack))
        told = learnt.sparkSession.sparkContext.broadcast((pack, place, maps, beta[pack]))

        def summed(batches: Iterator[pa.RecordBatch], told=told) -> Iterator[pa.RecordBatch]:
            names, place, maps, beta = told.value
            gradient, hessian = np.zeros((len(names), wide)), np.zeros((len(names), wide * (wide + 1) // 2))
            step = max(1, PRODUCT // len(names))
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
                y, own = batch.column("y").to_numpy(), place[batch.column("__k").to_numpy()]
                for a in range(0, len(x), step):
                    g, h = _step_sums(x[a : a + step], y[a : a + step], own[a : a + step], maps, beta)
                    gradient += g
                    hessian += h
            both = np.c_[gradient, hessian]
            yield pa.record_batch({"k": np.array(names, np.int32), "sums": pa.array([s.tobytes() for s in both], pa.binary())})

        def solved(batches: Iterator[pa.RecordBatch], told=told) -> Iterator[pa.RecordBatch]:
            names, _, maps, beta = told.value
            at = {k: j for j, k in enumerate(names)}
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for k, sums in zip(batch.column("k").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                    total[k] = total.get(k, 0) + np.frombuffer(sums)
            ridge, (a, b) = np.diag([0.0] + [l2] * (d - 1)), np.triu_indices(wide)
            moved = []
            for k, sums in total.items():
                inner = np.zeros((wide, wide))
                inner[a, b] = inner[b, a] = sums[wide:]
                own, now = maps[at[k]], beta[at[k]]
                moved.append(np.linalg.solve(own @ inner @ own.T + ridge + 1e-9 * np.eye(d), own @ sums[:wide] - ridge @ now).tolist())
            yield pa.record_batch({"k": pa.array(list(total), pa.int32()), "move": pa.array(moved, pa.list_(pa.float64()))})

        sums = learnt.mapInArrow(summed, "k int, sums binary").repartition("k")
        moves |= {r["k"]: np.array(r["move"]) for r in sums.mapInArrow(solved, "k int, move array<double>").collect()}  # coefficients only
    return moves


def to_json(model: Logistic) -> str:
    """The model as JSON."""
    return json.dumps(asdict(model))


def from_json(text: str) -> Logistic:
    """The model that ``to_json`` wrote."""
    return Logistic(**json.loads(text))
