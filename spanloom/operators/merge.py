"""Table maintenance as whole-table rewrites: upserts, protected merges, diffs, row splits, re-anchored labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those with equal keys, and its other rows added. New rows win whole, nulls included."""
    return new.select(old.columns).unionByName(old.join(new.select(*keys).distinct(), list(keys), "left_anti").select(old.columns))


def upsert_fields(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As ``upsert``, but a null in a new row keeps the old value."""
    keys = list(keys)
    fields = [c for c in old.columns if c not in keys]
    renamed = new.select(*keys, *(F.col(c).alias(f"__{c}") for c in fields))
    return old.join(renamed, keys, "full").select(*keys, *(F.coalesce(f"__{c}", c).alias(c) for c in fields))


def protected_merge(old: DataFrame, new: DataFrame, keys: Sequence[str], source: str, protected: Sequence[str]) -> DataFrame:
    """The protected rows of ``old`` and the rows of ``new`` for other keys; what else was in ``old`` goes."""
    kept = old.filter(F.col(source).isin(*protected))
    return kept.unionByName(new.join(kept.select(*keys), list(keys), "left_anti").select(old.columns))


def precedence(labels: DataFrame, key: str, label: str, source: str, order: Sequence[str]) -> DataFrame:
    """(key, label, source): of several labels that of the source named first in ``order``, equals by least label; other sources don't count."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col(source))
    best = F.min(F.struct(place.alias("p"), F.col(label), F.col(source))).alias("b")
    return labels.filter(F.col(source).isin(*order)).groupBy(key).agg(best).select(key, F.col(f"b.{label}").alias(label), F.col(f"b.{source}").alias(source))


def changes(before: DataFrame, after: DataFrame, keys: Sequence[str], value: str, weight: str) -> DataFrame:
    """(keys, was, now, change, weight): rows whose value flipped, is new, or was dropped."""
    keys = list(keys)
    both = before.select(*keys, F.col(value).alias("was"), F.col(weight).alias("__w0"), F.lit(True).alias("__b")).join(after.select(*keys, F.col(value).alias("now"), F.col(weight).alias("__w1"), F.lit(True).alias("__a")), keys, "full")
    change = F.when(F.col("__b").isNull(), "new").when(F.col("__a").isNull(), "dropped").when(~F.col("was").eqNullSafe(F.col("now")), "flipped")
    return both.withColumn("change", change).filter("change is not null").select(*keys, "was", "now", "change", F.coalesce("__w1", "__w0").alias("weight"))


def staleness(old: DataFrame, new: DataFrame, keys: Sequence[str], at: str, tolerance: float) -> DataFrame:
    """One row (only_old, only_new, moved): how far two versions of a table differ."""
    keys = list(keys)
    both = old.select(*keys, F.col(at).alias("__a"), F.lit(1).alias("__o")).join(new.select(*keys, F.col(at).alias("__b"), F.lit(1).alias("__n")), keys, "full")
    return both.agg(F.count_if(F.col("__n").isNull()).alias("only_old"), F.count_if(F.col("__o").isNull()).alias("only_new"), F.count_if(F.abs(F.col("__a") - F.col("__b")) > tolerance).alias("moved"))


def split_rows(df: DataFrame, chosen: Column, cut: Column, key: str, start: str, end: str, label: str) -> DataFrame:
    """``df`` with each chosen row as two, keys ending in a and b, cut in time; only the first keeps the label."""
    rest = [c for c in df.columns if c not in (key, start, end, label)]
    part = lambda suffix, a, b, name: F.struct(F.concat(F.col(key).cast("string"), F.lit(suffix)).alias(key), a.cast(df.schema[start].dataType).alias(start), b.cast(df.schema[end].dataType).alias(end), name.cast(df.schema[label].dataType).alias(label))
    whole = F.array(part("", F.col(start), F.col(end), F.col(label)))
    two = F.array(part("a", F.col(start), cut, F.col(label)), part("b", cut, F.col(end), F.lit(None)))
    return df.select(*rest, F.explode(F.when(chosen, two).otherwise(whole)).alias("__p")).select(*rest, "__p.*").select(df.columns)


def reanchor(old: DataFrame, new: DataFrame, old_id: str, new_id: str, key: str, label: str, share: float = 0.6) -> DataFrame:
    """(new_id, label, hits, n_keys): the label of the old item that shares most keys with a new one.

    Accepted if it shares at least ``share`` of the new item's keys or all old items it shares keys with have one label; equals by
    least old id. ``old`` has (old_id, key, label), ``new`` (new_id, key).
    """
    sizes = new.groupBy(new_id).agg(F.countDistinct(key).alias("n_keys"))
    hits = old.select(old_id, key, label).distinct().join(new.select(new_id, key).distinct(), key).groupBy(new_id, old_id, label).agg(F.count("*").alias("hits"))
    best = hits.groupBy(new_id).agg(F.min(F.struct((-F.col("hits")).alias("minus"), F.col(old_id), F.col(label))).alias("b"), F.countDistinct(label).alias("n_labels"))
    found = best.join(sizes, new_id).select(new_id, F.col(f"b.{label}").alias(label), (-F.col("b.minus")).alias("hits"), "n_keys", "n_labels")
    return found.filter((F.col("hits") / F.col("n_keys") >= share) | (F.col("n_labels") == 1)).drop("n_labels")


def lost(old: DataFrame, anchored: DataFrame, label_key: str) -> DataFrame:
    """Old labels that no new item took."""
    return old.select(label_key).distinct().join(anchored.select(label_key).distinct(), label_key, "left_anti")


def fill_from_sibling(parts: DataFrame, key: str, label: str, confidence: str, discount: float = 0.9) -> DataFrame:
    """``parts`` (keys ending in a or b) with a missing label taken from the other part at a discounted confidence."""
    stem = F.regexp_replace(F.col(key), "[ab]$", "")
    other = parts.filter(F.col(label).isNotNull()).select(stem.alias("__s"), F.col(key).alias("__k"), F.col(label).alias("__l"), F.col(confidence).alias("__c"))
    joined = parts.withColumn("__s", stem).join(other, "__s", "left")
    best = joined.withColumn("__use", F.col("__k").isNotNull() & (F.col("__k") != F.col(key))).groupBy(*parts.columns).agg(F.max(F.when(F.col("__use"), F.col("__l"))).alias("__l"), F.max(F.when(F.col("__use"), F.col("__c"))).alias("__c"))
    return best.select(*(F.coalesce(F.col(label), F.col("__l")).alias(label) if c == label else F.when(F.col(label).isNull(), F.col("__c") * discount).otherwise(F.col(confidence)).alias(confidence) if c == confidence else F.col(c) for c in parts.columns))


def keep_newest(versions: DataFrame, group: str, at: str, keep: int) -> DataFrame:
    """The ``keep`` newest rows of each group."""
    from .relational import first_per_group

    return first_per_group(versions, [group], [F.desc(at)], keep, "__r").drop("__r")


def replace_partitions(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` with the rows of every partition (by ``keys``) that ``new`` has rows of replaced by those."""
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").select(old.columns).unionByName(new.select(old.columns))


def write_partitions(new: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Writes ``new`` over the partitions it has rows of; others stay, and a second run leaves the same files' rows."""
    new.write.partitionBy(*keys).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def delete_cascade(tables: Mapping[str, DataFrame], gone: DataFrame, key: str) -> dict[str, DataFrame]:
    """Each table without the rows of the keys in ``gone``: one delete, carried to all tables that refer to it."""
    dead = gone.select(key).distinct()
    return {name: df.join(dead, key, "left_anti").select(df.columns) for name, df in tables.items()}


def insert_from(target: DataFrame, rows: DataFrame, key: str, constants: Mapping[str, Column]) -> DataFrame:
    """``target`` with a row for each of ``rows``: its columns where it has them, else ``constants``, else null; equal keys are replaced."""
    values = [constants[c] if c in constants else F.col(c) if c in rows.columns else F.lit(None) for c in target.columns]
    made = rows.select(*(v.cast(target.schema[c].dataType).alias(c) for v, c in zip(values, target.columns, strict=True)))
    return upsert(target, made, [key])


def resolve_queue(queue: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """``queue`` with resolved = 1 for the keys in ``done``."""
    marked = queue.join(done.select(key).distinct().withColumn("__d", F.lit(1)), key, "left")
    return marked.select(*(F.coalesce("__d", "resolved").cast(queue.schema["resolved"].dataType).alias(c) if c == "resolved" else F.col(c) for c in queue.columns))


def record_verdicts(now: DataFrame, verdicts: DataFrame, key: str, label: str, at: str) -> tuple[DataFrame, DataFrame]:
    """(the table after the verdicts, the log): a verdict (key, label, at) replaces the key's row by one from a human, and the log keeps the row it
    replaced as JSON (null where there was none), as ``undo`` reads it. Of several verdicts on a key the newest counts."""
    last = verdicts.groupBy(key).agg(F.max_by(label, at).alias("__l"), F.max(at).alias(at))
    before = now.select(F.col(key), F.to_json(F.struct(*now.columns)).alias("previous"))
    log = last.join(before, key, "left").select(key, F.col("__l").alias(label), "previous", at)
    fresh = last.join(now.drop(label), key, "left").select(*(F.col("__l").alias(label) if c == label else F.lit("human").alias(c) if c == "source" else F.col(c) for c in now.columns))
    return upsert(now, fresh, [key]), log


def update_where(df: DataFrame, where: Column, values: Mapping[str, Column]) -> DataFrame:
    """``df`` with new values in the rows where ``where`` holds."""
    return df.withColumns({c: F.when(where, v).otherwise(F.col(c)) for c, v in values.items()})


def backfill(df: DataFrame, facts: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``df`` with missing values of ``columns`` taken from the row of ``facts`` (a row a key); columns it lacks are added."""
    told = facts.select(key, *(F.col(c).alias(f"__{c}") for c in columns))
    joined = df.join(told, key, "left")
    rest = [F.col(f"__{c}").alias(c) for c in columns if c not in df.columns]
    return joined.select(*(F.coalesce(F.col(c), F.col(f"__{c}")).alias(c) if c in columns else F.col(c) for c in df.columns), *rest)


def card_labels(cards: DataFrame, items: DataFrame, labels: DataFrame, checks: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(labels after the cards, conflicts): cards (key, label, score, t_s), anchored on items, become labels of source card.

    A person's check (t_s, label, checked_key; null: nobody speaks it) decides where its card goes, at score 1; labels by a human stay; a card against
    an item's explicit other name (column explicit) is a conflict for the queue, unless it was checked. Of several cards of an item the
    last counts. Earlier labels of source card go; ``labels`` has (key, label, source, confidence).
    """
    checked = cards.join(checks, ["t_s", "label"]).select(F.col("checked_key").alias(key), "label", F.lit(1.0).alias("confidence"), "t_s", F.lit(True).alias("sure"))
    plain = cards.join(checks.select("t_s", "label"), ["t_s", "label"], "left_anti").select(key, "label", "score", "t_s")
    told = checked.unionByName(plain.withColumn("confidence", F.col("score") / 100).withColumn("sure", F.lit(False)).drop("score")).filter(F.col(key).isNotNull())
    kept = labels.filter("source <> 'card'")
    open_ = told.join(kept.filter("source = 'human'").select(key), key, "left_anti").join(items.select(key, "explicit"), key)
    against = ~F.col("sure") & F.coalesce(F.col("explicit") != F.col("label"), F.lit(False))
    best = F.max(F.struct("t_s", "label", "confidence")).alias("b")
    fresh = open_.filter(~against).groupBy(key).agg(best).select(key, "b.label", F.lit("card").alias("source"), "b.confidence")
    conflicts = open_.filter(against).groupBy(key).agg(F.max(F.struct("t_s", "label", "explicit")).alias("b")).select(key, "b.label", "b.explicit", "b.t_s")
    return upsert(kept, fresh, [key]), conflicts


def stale(inputs: DataFrame, done: DataFrame, key: str, version: str) -> DataFrame:
    """(key, reason): what has to be made again: missing in ``done``, or made from another version of its input. What is fresh is left out."""
    had = done.select(key, F.col(version).alias("__v"), F.lit(True).alias("__there"))
    both = inputs.join(had, key, "left")
    reason = F.when(F.col("__there").isNull(), "missing").when(~F.col("__v").eqNullSafe(F.col(version)), "changed")
    return both.withColumn("reason", reason).filter("reason is not null").select(key, "reason")


def refreshed(inputs: DataFrame, done: DataFrame, key: str, version: str, make, force: bool = False) -> DataFrame:
    """``done`` with the rows that ``make(some inputs)`` gives for stale inputs (all with ``force``); fresh ones are not made again, and rows of
    inputs that are gone go."""
    todo = inputs if force else inputs.join(stale(inputs, done, key, version).select(key), key, "left_semi")
    kept = done.join(inputs.select(key), key, "left_semi")
    return upsert(kept, make(todo), [key])
