"""What is known of a run when it is decided, as features of a calibrating model, and rankings of decisions to check."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions.numbers import logit

from .learn import left_out_scores

#: The features in order, those of the run and those of its surroundings.
RUN = "top1 top2 top3 margin gap23 n_cands log_dur log_n_utts confessional recap mention_pred host_pred log_bank_n log_bank_s log_bank_n2 log_ep top1_x_margin".split()
AROUND = "cap_pred_near cap_second_near cap_prev_pred cap_next_pred card_pred_near card_second_near ep_has_caps ep_has_cards".split()
FEATURES = RUN + AROUND
#: Seconds around a run in which captions, the turns beside it and cards count; captions an episode needs to have caption names.
NEAR, TURN, CARD = 60.0, 30.0, 90.0
LEAST_CAPTIONS = 20
#: What a run asks of the marks near it: whether of captions (else cards), of which of its labels, and how far.
ASKED = {"cap_pred_near": (True, "pred", NEAR), "cap_second_near": (True, "second", NEAR), "card_pred_near": (False, "pred", CARD), "card_second_near": (False, "second", CARD)}


def run_features(runs: DataFrame) -> DataFrame:
    """``runs`` with the RUN features, of columns: candidates (array of struct(label, score), best first), dur, n_utts, domain, segment, named (whether it
    names its first candidate), episode, and bank_n, bank_s, bank_n2: the items and seconds behind the first candidate's and the second's profile."""
    score = lambda k: F.coalesce(F.get(F.col("candidates"), F.lit(k))["score"], F.lit(0.0))
    label = F.get(F.col("candidates"), F.lit(0))["label"]
    number = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    one = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    return runs.withColumns({
        "top1": score(0), "top2": score(1), "top3": score(2), "margin": score(0) - score(1), "gap23": score(1) - score(2),
        "n_cands": F.least(F.coalesce(F.size("candidates"), F.lit(0)), F.lit(3)).cast("double"),
        "log_dur": F.log1p(F.greatest(number("dur"), F.lit(0.0))), "log_n_utts": F.log1p(number("n_utts")),
        "confessional": one(F.col("domain") == "confessional"), "recap": one(F.col("segment") == "recap"), "mention_pred": one(F.col("named")),
        "host_pred": one(label.cast("string").startswith("HOST")), "log_bank_n": F.log1p(number("bank_n")), "log_bank_s": F.log1p(number("bank_s")), "log_bank_n2": F.log1p(number("bank_n2")),
        "log_ep": F.ln(F.greatest(number("episode"), F.lit(1.0))), "top1_x_margin": score(0) * (score(0) - score(1)),
    })


def _counted(rows: DataFrame, keys: list[str], kept: list[str]) -> DataFrame:
    """The runs among ``rows`` with a column per near feature: how many marks of that label reach into the run's surroundings, its own among them.

    Marks that reach into a stretch are those that start up to its end less those that end before it begins, so a run asks twice, and no pair of
    run and mark is made: starts, ends and questions are a timeline per label.
    """
    # by code at one time: questions at a beginning (0 to 3), starts (4) and ends (5) of marks, questions at an end (6 to 9)
    point = lambda cap, label, at, code: F.struct(cap.alias("__cap"), F.col(label).alias("__name"), at.cast("double").alias("__at"), F.lit(code).alias("__code"))
    asked = []
    for k, (cap, label, reach) in enumerate(ASKED.values()):
        asked += [point(F.lit(cap), label, F.col("start_s") - reach, k), point(F.lit(cap), label, F.col("end_s") + reach, k + 6)]
    line = F.col("__kind") == 1
    marks = F.when(F.col("start_s").isNotNull() & F.col("end_s").isNotNull(), F.array(point(line, "__label", F.col("start_s"), 4), point(line, "__label", F.greatest("start_s", "end_s"), 5)))
    points = rows.select(*keys, "__id", F.struct(*kept).alias("__row"), F.explode(F.when(F.col("__kind") == 0, F.array(*asked)).otherwise(marks)).alias("__p")).select(*keys, "__id", "__p.*", "__row")
    # a run's first point brings its columns
    points = points.filter("__name is not null or __code = 0").withColumn("__row", F.when(F.col("__code") == 0, F.col("__row")))
    so_far = Window.partitionBy(*keys, "__cap", "__name").orderBy("__at", "__code").rowsBetween(Window.unboundedPreceding, 0)
    n = F.when(F.col("__code") > 5, F.count_if(F.col("__code") == 4).over(so_far)).otherwise(-F.count_if(F.col("__code") == 5).over(so_far))
    answers = points.withColumn("__n", n).filter("__code not in (4, 5)")
    sums = [F.sum(F.when(F.col("__code") % 6 == k, F.col("__n"))).alias(name) for k, name in enumerate(ASKED)]
    return answers.groupBy(*keys, "__id").agg(F.first("__row", ignorenulls=True).alias("__row"), *sums).select(*keys, "__row.*", *ASKED)


def around_features(runs: DataFrame, captions: DataFrame, cards: DataFrame, keys: list[str], run: str) -> DataFrame:
    """``runs`` with the AROUND features, of columns start_s, end_s, pred, second.

    ``captions`` has (keys, run, label, start_s, end_s) a line with an explicit name, its run among them: a run's own lines don't count.
    ``cards`` has (keys, label, t_s). Beside a run: the last line that ends up to TURN before it and the first that starts up to TURN
    after it. Without captions or cards the features are 0, which ep_has_caps and ep_has_cards tell apart; so they are where a key is null.
    Runs and lines end no earlier than they start. Runs, lines and cards move once, by ``keys``; all else are windows over them.
    """
    lines = captions.select(*keys, run, "start_s", "end_s", F.col("label").alias("__label"), F.lit(1).alias("__kind"))
    points = cards.select(*keys, F.col("t_s").alias("start_s"), F.col("t_s").alias("end_s"), F.col("label").alias("__label"), F.lit(2).alias("__kind"))
    rows = runs.withColumns({"__kind": F.lit(0), "__id": F.monotonically_increasing_id()}).unionByName(lines, allowMissingColumns=True).unionByName(points, allowMissingColumns=True).repartition(*keys)
    is_run, is_line = F.col("__kind") == 0, F.col("__kind") == 1
    # a run's own lines
    same = Window.partitionBy(*keys, run)
    told = rows.withColumn("__r", F.first(F.when(is_run, F.struct("start_s", "end_s", "pred", "second")), ignorenulls=True).over(same))
    here = is_line & (F.greatest("start_s", "end_s") >= F.col("__r.start_s") - NEAR) & (F.col("start_s") <= F.col("__r.end_s") + NEAR)
    own = {f"__own_{c}": F.count_if(here & (F.col("__label") == F.col(f"__r.{c}"))).over(same) for c in ("pred", "second")}
    # the lines beside a run: its own neither end before it nor start after it; of lines at one time the greatest label counts
    whole = Window.partitionBy(*keys)
    up_to = lambda *order: whole.orderBy(*order, F.desc("__kind"), "__label").rowsBetween(Window.unboundedPreceding, 0)
    last = lambda at, order: F.last(F.when(is_line & F.col(at).isNotNull(), F.struct(F.col(at).alias("at"), F.col("__label").alias("label"))), ignorenulls=True).over(order)
    beside = {
        "__before": last("end_s", up_to(F.when(is_run, F.col("start_s")).otherwise(F.col("end_s")))), "__after": last("start_s", up_to(F.desc(F.when(is_run, F.col("end_s")).otherwise(F.col("start_s"))))),
        "__lines": F.count_if(is_line).over(whole), "__cards": F.count_if(F.col("__kind") == 2).over(whole),
    }
    found = told.withColumns(own).drop("__r").withColumns(beside)
    kept = [c for c in runs.columns if c not in keys]
    counted = _counted(found, keys, [*kept, *own, *beside])
    near = {name: F.col(name) - (F.col(f"__own_{label}") if cap else 0) > 0 for name, (cap, label, _) in ASKED.items()}
    near = {name: x & F.col(ASKED[name][1]).isNotNull() & F.col("start_s").isNotNull() & F.col("end_s").isNotNull() for name, x in near.items()}
    rest = {
        "cap_prev_pred": (F.col("__before.label") == F.col("pred")) & (F.col("__before.at") >= F.col("start_s") - TURN), "cap_next_pred": (F.col("__after.label") == F.col("pred")) & (F.col("__after.at") <= F.col("end_s") + TURN),
        "ep_has_caps": F.col("__lines") >= LEAST_CAPTIONS, "ep_has_cards": F.col("__cards") > 0,
    }
    known = reduce(and_, (F.col(k).isNotNull() for k in keys))
    features = {n: F.coalesce((known & x).cast("double"), F.lit(0.0)) for n, x in (near | rest).items()}
    return counted.select(*runs.columns, *(features[n].alias(n) for n in AROUND))


def accepted(accept: float, margin: float, least_s: float) -> Column:
    """Whether the plain rule takes a run: score, margin, no mention of the predicted name, and long enough."""
    return (F.col("top1") >= accept) & (F.col("margin") >= margin) & (F.col("mention_pred") == 0) & (F.expm1("log_dur") >= least_s)


def audit_frame(verdicts: DataFrame, groups: DataFrame, group: str) -> DataFrame:
    """The features (``groups``, by ``group``) of what was audited, with y: 1 where the group's verdict was confirm.

    A group's verdicts agree; one that had another label than the group's prediction before doesn't count, nor do first episodes.
    """
    kept = verdicts.filter(F.col("prev_label").eqNullSafe(F.col("pred"))).groupBy(group).agg((F.min("verdict") == "confirm").cast("double").alias("y"))
    return groups.filter("episode >= 2").join(kept, group)


def ranked_for_audit(trained: DataFrame, audited: DataFrame, season: str, features: list[str], l2: float = 3.0, beside: tuple[str, ...] = ("log_dur", "top1", "margin")) -> DataFrame:
    """``audited`` with p: the chance that a label is right, by a small model on the log odds of the run model (fitted on ``trained``, other seasons)
    and the group's own length and scores (``beside``); both leave the season out. Null where the other seasons have one verdict only."""
    both = trained.select(season, *features, "y", F.lit(False).alias("__a")).unionByName(audited.withColumn("__a", F.lit(True)), allowMissingColumns=True)
    first = left_out_scores(both, season, features, "y", out="__p", only=~F.col("__a"))
    own = first.filter("__a").withColumn("lp", logit(F.col("__p"))).drop("__a", "__p")
    return left_out_scores(own, season, ["lp", *beside], "y", l2)


def suspects(decided: DataFrame, p: str, key: str, n: int) -> DataFrame:
    """The ``n`` decisions that are least likely right, with how many there are in all (``remaining``)."""
    judged = decided.filter(F.col(p).isNotNull())
    return judged.orderBy(p, key).limit(n).crossJoin(F.broadcast(judged.agg(F.count("*").alias("remaining"))))  # one row
