"""From items, vectors and trusted labels to decided labels: profiles by recency, scored items, split and pooled runs, rules, writes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import sequence, vector


@dataclass(frozen=True)
class Rules:
    """Thresholds of the decision; the defaults are the usual ones."""

    accept: float = 0.55
    margin: float = 0.08
    floor: float = 0.35
    vote_s: float = 1.0
    least_s: float = 2.0
    half_life: float = 3.0


def recency_weight(as_of: Column, episode: Column, duration: Column, half_life: float = 3.0, symmetric: bool = False) -> Column:
    """Half as much for every ``half_life`` episodes of age, times duration; later episodes count as new, or by distance if symmetric."""
    age = F.abs(as_of - episode) if symmetric else F.greatest(as_of - episode, F.lit(0))
    return F.pow(F.lit(0.5), age / half_life) * duration


def build_profiles(labelled: DataFrame, keys: Sequence[str], vec: str, as_of: int, rules: Rules = Rules()) -> DataFrame:
    """(keys, profile, n): weighted unit means of labelled items up to episode ``as_of`` (columns episode, dur)."""
    weight = recency_weight(F.lit(as_of), F.col("episode"), F.col("dur"), rules.half_life)
    return vector.profiles(labelled.filter(F.col("episode") <= as_of), keys, vec, weight)


def candidates(items: DataFrame, presence: DataFrame, season: str, episode: str, segment: str) -> DataFrame:
    """``items`` with the labels present in their episode; a recap's are those of the episode before."""
    present = presence.groupBy(season, F.col(episode).alias("__e")).agg(F.array_sort(F.collect_set("label")).alias("candidates"))
    wanted = items.withColumn("__e", F.when(F.col(segment) == "recap", F.col(episode) - 1).otherwise(F.col(episode)))
    return wanted.join(present, [season, "__e"], "left").drop("__e")


def pooled(items: DataFrame, keys: Sequence[str], vec: str, duration: str) -> DataFrame:
    """(keys, pooled, secs, n): the duration-weighted unit mean of each group's vectors; items without one count in secs only."""
    keys = list(keys)
    means = vector.profiles(items.filter(F.col(vec).isNotNull()), keys, vec, F.col(duration), "pooled").drop("n")
    return items.groupBy(*keys).agg(F.sum(duration).alias("secs"), F.count("*").alias("n")).join(means, keys, "left")


def assign(items: DataFrame, profiles: DataFrame, key: str, run: str, order: Sequence[str], vec: str, duration: str, label: str, rules: Rules = Rules()) -> DataFrame:
    """(run, part, label, top1, top2, decision, secs, n, first_key): each run cut where a confident item names another label, each part pooled and decided.

    A part whose items name (column ``named``, array of labels) the label it got is name_mentioned; a confident part under
    ``least_s`` seconds is too_short; a part without any vector is no_vector.
    """
    ranked = vector.rank_profiles(items, key, vec, profiles, label, "profile", 2)
    own = vector.decide(ranked, key, label, rules.accept, rules.margin, rules.floor).filter("decision = 'auto'").select(key, F.col(label).alias("__vote"))
    voting = items.join(own, key, "left").withColumn("__vote", F.when(F.col(duration) >= rules.vote_s, F.col("__vote")))
    parts = sequence.split_on_votes(voting, [run], order, "__vote", "part")
    pools = pooled(parts, [run, "part"], vec, duration)
    named = F.array_distinct(F.flatten(F.collect_list(F.coalesce("named", F.array().cast("array<string>"))))) if "named" in items.columns else F.array().cast("array<string>")
    facts = parts.groupBy(run, "part").agg(F.min(key).alias("first_key"), named.alias("__named"))
    scored = pools.join(facts, [run, "part"])
    again = vector.rank_profiles(scored.select("first_key", "pooled"), "first_key", "pooled", profiles, label, "profile", 2)
    decided = scored.join(vector.decide(again, "first_key", label, rules.accept, rules.margin, rules.floor), "first_key", "left")
    confident = F.col("decision") == "auto"
    decision = (
        F.when(F.col("decision").isNull(), "no_vector")
        .when(confident & F.array_contains("__named", F.col(label).cast("string")), "name_mentioned")
        .when(confident & (F.col("secs") < rules.least_s), "too_short")
        .otherwise(F.col("decision"))
    )
    return decided.select(run, "part", label, "top1", "top2", decision.alias("decision"), "secs", "n", "first_key")


def calibrated(decided: DataFrame, p: Column, cut: float, rules: Rules = Rules()) -> DataFrame:
    """``decided`` with auto and low_margin replaced by what a calibrated probability says; the floor and the other rules stay."""
    open_ = F.col("decision").isin("auto", "low_margin") & (F.col("top1") >= rules.floor)
    fresh = F.when((p >= cut) & (F.col("secs") >= rules.least_s), "auto").otherwise("low_margin")
    return decided.withColumn("decision", F.when(open_, fresh).otherwise(F.col("decision")))


def with_text_prior(decided: DataFrame, prior: DataFrame, keys: Sequence[str], label: str, least: float = 0.8) -> DataFrame:
    """``decided`` with auto_text where a text guess (columns guess, conf, and second, the runner-up) is sure and compatible: there was no candidate, it is one of the top two, or a mentioned name was taken for the speaker."""
    both = decided.join(prior, list(keys), "left")
    fits = (F.col("decision") == "no_candidate") | (F.col("guess") == F.col(label)) | (F.col("guess") == F.col("second")) | ((F.col("decision") == "name_mentioned") & (F.col("guess") != F.col(label)))
    take = (F.col("decision") != "auto") & (F.col("conf") >= least) & fits
    return both.withColumns({label: F.when(F.coalesce(take, F.lit(False)), F.col("guess")).otherwise(F.col(label)), "decision": F.when(F.coalesce(take, F.lit(False)), "auto_text").otherwise(F.col("decision"))}).select(decided.columns)


def shares(decided: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, secs, auto_share): decided seconds over all seconds."""
    done = F.sum(F.when(F.col("decision").isin("auto", "auto_text"), F.col("secs")).otherwise(0.0))
    return decided.groupBy(*by).agg(F.sum("secs").alias("secs"), (done / F.greatest(F.sum("secs"), F.lit(1e-9))).alias("auto_share"))


def majority_remap(old: DataFrame, new: DataFrame, old_id: str, new_id: str, key: str) -> DataFrame:
    """(old_id, new_id): for each old item the new one that holds most of its keys, equals by id."""
    hits = old.select(old_id, key).distinct().join(new.select(new_id, key).distinct(), key).groupBy(old_id, new_id).agg(F.count("*").alias("n"))
    return hits.groupBy(old_id).agg(F.min(F.struct((-F.col("n")).alias("minus"), F.col(new_id))).alias("b")).select(old_id, F.col(f"b.{new_id}").alias(new_id))


def containing_window(items: DataFrame, windows: DataFrame, keys: Sequence[str], item: str, start: str, end: str, w_start: str, w_end: str, width: int) -> DataFrame:
    """(item, window start, room): the window around an item that leaves most room on its tighter side, equals by start. ``width`` is the windows' greatest length."""
    from .temporal import within_band

    pairs = within_band(items, windows, keys, start, w_start, width, 0).filter(F.col(w_end) >= F.col(end))
    room = F.least(F.col(start) - F.col(w_start), F.col(w_end) - F.col(end))
    best = F.min(F.struct((-room).alias("minus"), F.col(w_start))).alias("b")
    return pairs.groupBy(item).agg(best).select(item, F.col(f"b.{w_start}").alias(w_start), (-F.col("b.minus")).alias("room"))


def tag_segments(items: DataFrame, bounds: DataFrame, keys: Sequence[str], start: str) -> DataFrame:
    """``items`` with segment: recap before the group's recap_end, preview from its preview_start on, else body."""
    joined = items.join(bounds, list(keys), "left")
    tag = F.when(F.col(start) < F.col("recap_end"), "recap").when(F.col(start) >= F.col("preview_start"), "preview").otherwise("body")
    return joined.withColumn("segment", tag).select(*items.columns, "segment")


def merged_tally(old: DataFrame, new: DataFrame, keys: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """Counts of two tables added up by key."""
    columns = [*keys, *counts]
    return old.select(columns).unionByName(new.select(columns)).groupBy(*keys).agg(*(F.sum(c).alias(c) for c in counts))


def undo(now: DataFrame, log: DataFrame, key: str, schema: str) -> DataFrame:
    """``now`` with the logged rows put back as the JSON in ``previous`` says; a null there removes the row. The newest entry (column at) of a key counts."""
    last = log.groupBy(key).agg(F.max_by("previous", "at").alias("__p"))
    back = last.filter("__p is not null").select(F.from_json("__p", schema).alias("r")).select("r.*")
    return now.join(last.select(key), key, "left_anti").select(now.columns).unionByName(back.select(now.columns))
