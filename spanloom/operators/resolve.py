"""Entity resolution: ordered lookups, fuzzy matches, mentions, borrowed values, shared passages."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions.text import indel_ratio, partial_ratio

from .align import anchored_times, ordered_blocks  # noqa: F401  once part of this module
from .relational import small_side


def with_borrowed(members: DataFrame, owned: DataFrame, member: str, group: str, value: str, order: Sequence[Column]) -> DataFrame:
    """(member, value, borrowed): the member's best own value, else the best one any member of its group has; null if none has."""
    own = members.join(owned, member, "left").withColumn("__r", F.row_number().over(Window.partitionBy(member).orderBy(*order))).filter("__r = 1")
    best = own.filter(F.col(value).isNotNull()).withColumn("__g", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter("__g = 1").select(group, F.col(value).alias("__lent"))
    return own.join(best, group, "left").select(member, F.coalesce(value, "__lent").alias(value), F.col(value).isNull().alias("borrowed"))


def first_lookup(tokens: DataFrame, key: str, tables: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """``tokens`` with resolved, via and candidates: the first of the ordered tables (key, value) that knows the key decides.

    One value there resolves it, several make it ambiguous (sorted in candidates); no table: unresolved. Tables are aggregated
    before they are joined, so that no key multiplies rows.
    """
    found = tokens
    for name, lookup in tables:
        values = lookup.groupBy(key).agg(F.array_sort(F.collect_set("value")).alias(f"__{name}"))
        found = found.join(values, key, "left")
    columns = [f"__{name}" for name, _ in tables]
    hit = F.coalesce(*columns)
    via = F.coalesce(*(F.when(F.col(c).isNotNull(), F.lit(name)) for c, (name, _) in zip(columns, tables, strict=True)))
    return found.withColumns({
        "resolved": F.when(F.size(hit) == 1, hit[0]),
        "via": F.when(F.size(hit) == 1, via).when(F.size(hit) > 1, F.lit("ambiguous")).otherwise(F.lit("unresolved")),
        "candidates": F.when(F.size(hit) > 1, hit),
    }).drop(*columns)


def fuzzy_unique(tokens: DataFrame, names: DataFrame, token: str, name: str, distance: int = 1, least: int = 4) -> DataFrame:
    """(token, name, distance): the only name within an edit ``distance`` of 1 of a token; an equal name wins outright.

    Words within one edit share their text with one character left out: both sides are keyed by those, so it is an equi-join,
    and the distance is then checked.
    """
    if distance != 1:
        raise ValueError("keys are made for a distance of 1")
    keyed = lambda c: F.explode(F.array_distinct(F.concat(F.array(c), F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, F.length(c)))))))
    left = tokens.select(token).distinct().filter(F.length(token) >= least).withColumn("__k", keyed(F.col(token)))
    right = names.select(name).distinct().filter(F.length(name) >= least).withColumn("__k", keyed(F.col(name)))
    pairs = left.join(right, "__k").select(token, name).distinct().withColumn("distance", F.levenshtein(token, name)).filter("distance <= 1")
    best = pairs.groupBy(token).agg(F.min("distance").alias("d"), F.count("*").alias("n"), F.min(F.struct("distance", name)).alias("b"))
    return best.filter("d = 0 or n = 1").select(token, F.col(f"b.{name}").alias(name), F.col("d").alias("distance"))


def _marked_pairs(text: Column) -> Column:
    """The pairs of neighbouring characters of a text, ends marked; one that comes again is numbered, so that equal elements count once."""

    def numbered(marked: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.length(marked) - 1), lambda i: F.substring(marked, i, F.lit(2)))
        again = lambda p: F.transform(p, lambda x, i: F.concat(x, F.size(F.filter(F.slice(p, F.lit(1), i), lambda y: y == x)).cast("string")))
        return F.transform(F.array(pairs), again)[0]

    return F.transform(F.array(F.concat(F.lit("^"), text, F.lit("$"))), numbered)[0]


def _least_shared(sizes: Column, least: float) -> Column:
    """The pairs that two texts of ``sizes`` characters together share at a ratio of ``least``: of those of one, a character left out takes
    two and one put in takes one."""
    return F.greatest(F.lit(1), F.ceil(sizes * (0.5 - 1.5 * (1 - least / 100)) + 1 - 1e-6).cast("int"))


def ratio_candidates(tokens: DataFrame, names: DataFrame, token: str, name: str, least: float) -> DataFrame:
    """(token, name): pairs that a ratio of ``least`` or more may have, all such among them.

    The lengths must be near enough; of either text's pairs of neighbouring characters, rarest first, so many are keys that a text which shares
    none of them shares too few; and all in all enough pairs must be shared.
    """
    if least <= 200 / 3:
        raise ValueError("below two thirds a ratio promises no shared pair")
    ratio = least / 100
    sides = [df.select(F.col(c).alias("x")).filter("x is not null").distinct().select("x", F.length("x").alias("l"), _marked_pairs(F.col("x")).alias("g")) for df, c in ((tokens, token), (names, name))]
    often = sides[1].select(F.explode("g").alias("k")).groupBy("k").agg(F.count("*").alias("n"))
    seen = small_side(often)

    def keyed(df: DataFrame, x: str) -> DataFrame:
        ranked = df.select("*", F.explode("g").alias("k")).join(seen, "k", "left").groupBy("x").agg(F.first("l").alias("l"), F.first("g").alias("g"), F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "k"))).alias("r"))
        shortest = F.ceil(F.col("l") * (ratio / (2 - ratio)) - 1e-6)
        keys = F.slice("r", F.lit(1), F.size("r") - _least_shared(F.col("l") + shortest, least) + 1)
        return ranked.select(F.col("x").alias(x), F.col("l").alias(f"l_{x}"), F.col("g").alias(f"g_{x}"), F.explode(keys["k"]).alias("k"))

    a, b = keyed(sides[0], "a"), keyed(sides[1], "b")
    both = F.col("l_a") + F.col("l_b")
    near = a.join(b, "k").filter(200 * F.least("l_a", "l_b") + 1e-6 >= least * both).dropDuplicates(["a", "b"])
    return near.filter(F.size(F.array_intersect("g_a", "g_b")) >= _least_shared(both, least)).select(F.col("a").alias(token), F.col("b").alias(name))


def fuzzy_best(tokens: DataFrame, names: DataFrame, token: str, name: str, least: float = 85.0, hint: str | None = None) -> DataFrame:
    """(token, name, score): the name with the best ratio of at least ``least`` (equals: the least name), else the only one within one edit, at ``least``.

    Ratios are worked out for ``ratio_candidates`` only. ``hint`` names a column of both sides: where one's hint is in the other's to 80 or
    more, a score under 100 rises by 5.
    """
    left, right = tokens.select(token, *([F.col(hint).alias("__h")] if hint else [])).distinct(), names.select(name, *([F.col(hint).alias("__o")] if hint else [])).distinct()
    near = ratio_candidates(tokens, names, token, name, least)
    scored = near.withColumn("score", F.when(F.col(token) == F.col(name), 100.0).otherwise(indel_ratio(token, name))).filter(F.col("score") >= least)
    if hint:
        scored = scored.join(left, token).join(right, name)
        helped = (F.col("score") < 100) & (F.length("__o") > 0) & (partial_ratio(F.coalesce("__o", F.lit("")), F.coalesce("__h", F.lit(""))) >= 80)
        scored = scored.withColumn("score", F.when(helped, F.least(F.lit(100.0), F.col("score") + 5)).otherwise(F.col("score")))
    best = scored.groupBy(token).agg(F.min(F.struct((-F.col("score")).alias("minus"), F.col(name))).alias("b")).select(token, F.col(f"b.{name}").alias(name), (-F.col("b.minus")).alias("score"))
    rest = tokens.select(token).distinct().join(best, token, "left_anti")
    return best.unionByName(fuzzy_unique(rest, names, token, name).select(token, name, F.lit(float(least)).alias("score")))


#: Names that one automaton holds; more make further passes over the texts.
PACK_NAMES = 100_000


def _names_at(text: str, found: Iterator[tuple[int, list[tuple[int, int]]]]) -> dict[int, int]:
    """How often each person of ``found`` ((last place, [(person, length)]) per place) is named: whole words, at a place the longest name, none overlapping."""
    hits: dict[int, list[tuple[int, int]]] = {}
    for last, people in found:
        if last + 1 < len(text) and text[last + 1] in _LETTERS:
            continue
        for person, length in people:
            start = last - length + 1
            if not start or text[start - 1] not in _BEFORE:
                hits.setdefault(person, []).append((start, -length))
    counts = {}
    for person, places in hits.items():
        reach, n = 0, 0
        for start, minus in sorted(places):
            if start >= reach:
                reach, n = start - minus, n + 1
        counts[person] = n
    return counts


#: A name doesn't begin after a letter of ASCII or an apostrophe, nor end before a letter of ASCII.
_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyz")
_BEFORE = _LETTERS | {"'"}


def mentions(texts: DataFrame, key: str, text: str, names: DataFrame, who: str, name: str) -> DataFrame:
    """(key, who, n): how often a text names someone, as whole words in any case; the longest of someone's names counts at a place.

    ``names`` has a row per person and name, of one word or several, in any script; names of one character don't count. They are sent to the tasks
    as an Aho-Corasick automaton, or several of PACK_NAMES names about; each text is read where it is, once a pack, and nothing but
    the counts moves. Null texts and names name no one.
    """
    import ahocorasick

    spark = texts.sparkSession
    known = names.select(F.col(who).alias("__who"), F.trim(F.lower(F.col(name))).alias("__n")).filter(F.col("__who").isNotNull() & (F.length("__n") >= 2)).distinct()
    packs = max(1, -(-known.count() // PACK_NAMES))
    said = texts.select(key, F.lower(F.col(text).cast("string")).alias("__t")).filter("__t is not null")
    schema = f"`{key}` {texts.schema[key].dataType.simpleString()}, __p int, n long"
    found = None
    for pack in range(packs):
        own = known.filter(F.pmod(F.xxhash64("__who"), F.lit(packs)) == pack).groupBy("__who").agg(F.collect_set("__n").alias("names")).collect()  # a pack of names
        people = spark.sparkContext.broadcast([r["names"] for r in own])

        def counted(batches: Iterator[pa.RecordBatch], people=people) -> Iterator[pa.RecordBatch]:
            holders: dict[str, list[int]] = {}
            for person, own_names in enumerate(people.value):
                for x in own_names:
                    holders.setdefault(x, []).append(person)
            automaton = ahocorasick.Automaton()
            for x, those in holders.items():
                automaton.add_word(x, [(person, len(x)) for person in those])
            automaton.make_automaton()
            for batch in batches:
                if not holders or not batch.num_rows:
                    continue
                rows, who_said, n = [], [], []
                for k, said_text in enumerate(batch.column("__t").to_pylist()):
                    for person, times in _names_at(said_text, automaton.iter(said_text)).items():
                        rows.append(k)
                        who_said.append(person)
                        n.append(times)
                yield pa.record_batch({key: batch.column(key).take(pa.array(rows, pa.int64())), "__p": pa.array(who_said, pa.int32()), "n": pa.array(n, pa.int64())})

        ids = spark.createDataFrame([(k, r["__who"]) for k, r in enumerate(own)], f"__p int, `{who}` {names.schema[who].dataType.simpleString()}")
        part = said.mapInArrow(counted, schema).join(F.broadcast(ids), "__p").select(key, who, "n")  # a pack of people
        found = part if found is None else found.unionByName(part)
    return found


def shared_blocks(a: DataFrame, b: DataFrame, a_key: str, b_key: str, a_words: Column, b_words: Column, width: int) -> DataFrame:
    """(a_key, b_key, n, first_at): runs of ``width`` equal words that two texts share: how many of a's places, and the first.

    Both sides are keyed by a hash of the run; a's repeats are counted first, so that no common run fills a task, and b's distinct ones,
    where they are few, come to a's rows, which then don't move.
    """

    def places(words: Column) -> Column:
        make = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - width), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(width))))
        return F.transform(F.array(words), lambda w: F.when(F.size(w) >= width, make(w)).otherwise(F.array().cast("array<bigint>")))[0]

    left = a.select(a_key, F.posexplode(places(a_words)).alias("at", "h"))
    right = b.select(b_key, F.explode(places(b_words)).alias("h")).distinct()
    wanted = small_side(right)
    counted = left.join(small_side(right.select("h").distinct()), "h", "left_semi").groupBy(a_key, "h").agg(F.count("*").alias("n"), F.min("at").alias("at"))
    return counted.join(wanted, "h").groupBy(a_key, b_key).agg(F.sum("n").alias("n"), F.min("at").alias("first_at"))
