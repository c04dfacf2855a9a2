"""Secrets in texts: fixed patterns, and character Markov models of random strings against ordinary identifiers.

Everything here is DataFrame expressions. The models are transition tables over the printable ASCII characters, counted from
labelled samples; a token's score is the sum of the log-likelihood ratios of its transitions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let

#: The base kinds in order, each with its pattern, and the least length of the match (for assign: of group 2).
#: A match of access or hex reaches to the end of its run, so asking for the length in the pattern drops the matches that are too short
#: and moves no other; a short match of assign may hide one that begins inside it, so it is dropped afterwards.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = [("assign", ASSIGN, 6), ("access", ACCESS, 20), ("hex", HEX, 24)]

#: Tokens the models look at, and when one counts as random.
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
LEAST_RATIO = 0.5
STATES = 96

#: Words of ordinary identifiers for the labelled samples, from the whole alphabet.
PARTS = """
account active address admin agent align anchor app archive array asset author backup badge balance batch bind block board body border bridge bucket
buffer build bundle button cache canvas category cell channel child client clock cluster column config context cookie count customer daemon
dashboard database delete device display driver editor element email encoder engine event export factory feature field filter folder frame function
gateway global graph group handler header height history home host icon image import index input invoice item job join journal json kernel keyboard
label layout library limit link list loader local lock logger manager matrix member menu message method mobile model module monitor network node
notify number object offset option order output owner package page parser partner path payment pipeline player plugin policy portal process project
proxy publish quality quantity query queue random range reader record region release request resource response router sample schema screen search
section server service session socket source stage state storage stream style subject system table target task template thread ticket time timer
topic track trigger unit update upload value vector version view virtual vocabulary volume wallet watch web weight widget window worker wrapper xml
zero
""".split()
#: Syllables of ordinary words in several languages: beginnings, middles and ends.
ONSETS = "b bl br c ch d dr f fr g gr h j k kl l m n p pl pr qu r s sch sh st str t tr v w z".split()
NUCLEI = "a e i o u ai au ea ei ie io ou".split()
CODAS = "n r s t l nd nt st ng ck m tion ment ung lich able ar er or".split()


def labelled_samples(spark: SparkSession, n: int = 8000, seed: str = "train") -> DataFrame:
    """(label, token): label 1 for random strings over the usual alphabets, 0 for names and paths joined from words in the usual styles.

    A word is one of PARTS or made of syllables. Another ``seed`` gives other tokens, for instance to hold out.
    """
    rows = spark.range(n, numPartitions=1)
    bits = lambda name, size: F.unhex(F.sha2(F.concat(F.lit(f"{seed}-{name}"), F.col("id").cast("string")), size))
    random = rows.select(
        F.lit(1).alias("label"),
        F.element_at(
            F.array(
                F.lower(F.hex(bits("a", 256))),
                F.base64(bits("b", 256)),
                F.base64(bits("c", 384)),
                F.translate(F.upper(F.base64(bits("d", 256))), "+/=", "QZ"),
                F.translate(F.base64(bits("e", 224)), "+/=", "-_"),
                F.substring(F.translate(F.lower(F.base64(bits("f", 256))), "+/=", "7k"), 1, 32),
            ),
            (F.col("id") % 6 + 1).cast("int"),
        ).alias("token"),
    )
    roll = lambda k, most: F.pmod(F.xxhash64(F.lit(seed), "id", F.lit(k)), F.lit(most)).cast("int")
    of = lambda k, words: F.element_at(F.array(*map(F.lit, words)), roll(k, len(words)) + 1)
    syllables = lambda k: F.concat(of(k + 1, ONSETS), of(k + 2, NUCLEI), of(k + 3, ONSETS), of(k + 4, NUCLEI), of(k + 5, CODAS))
    word = lambda k: F.when(roll(k, 3) == 0, syllables(k)).otherwise(of(k + 6, PARTS))
    chosen = F.slice(F.array(*(word(10 * k) for k in range(1, 7))), 1, roll(1, 4) + 3)
    camel = F.array_join(F.transform("w", F.initcap), "")
    number = roll(2, 2000).cast("string")
    styles = [
        F.array_join("w", "_"), F.array_join("w", "-"), camel, F.concat(F.lower(F.substring(camel, 1, 1)), F.substring(camel, 2, 200)), F.upper(F.array_join("w", "_")), F.array_join("w", ""),
        F.array_join("w", "/"), F.concat(F.lit("/usr/"), F.array_join("w", "/"), F.lit("/"), camel), F.concat(F.array_join("w", "_"), F.lit("_"), number), F.concat(F.lit("//www"), F.lit("/"), F.array_join("w", "/"), F.lit("/"), number, F.lit("/"), F.array_join("w", "-")),
        F.concat(of(3, ["is", "get", "set", "has", "on", "k", "m_", "I", "_"]), camel), F.concat(F.upper(of(4, PARTS)), camel, number), F.concat(camel, F.lit("/"), F.array_join("w", "_")), F.array_join(F.transform("w", F.initcap), "-"),
    ]
    ordinary = rows.select("id", chosen.alias("w")).select(F.lit(0).alias("label"), F.element_at(F.array(*styles), (F.col("id") % len(styles) + 1).cast("int")).alias("token"))
    return random.unionByName(ordinary)


def _states(token: Column) -> Column:
    """The state of each character; those outside printable ASCII have the last one. A token is read once, whatever its length."""
    return F.transform(F.split(token, ""), lambda c: F.greatest(F.least(F.ascii(c) - 32, F.lit(STATES - 1)), F.lit(0)))


def _transitions(states: Column) -> Column:
    """The place in a table of STATES x STATES of each character's state and the next one's."""
    return F.zip_with(F.slice(states, F.lit(1), F.size(states) - 1), F.slice(states, F.lit(2), F.size(states) - 1), lambda a, b: a * STATES + b)


@dataclass
class Markov:
    """log P(next | character) of random strings less that of ordinary identifiers, STATES x STATES, row by row."""

    ratios: list[float]

    def table(self) -> Column:
        return F.split(F.lit(",".join(f"{x:.6f}" for x in self.ratios)), ",").cast("array<double>")

    def score(self, token: Column) -> Column:
        """The mean ratio over a token's transitions; 0 for fewer than two characters."""
        total = lambda s: F.aggregate(_transitions(s), F.lit(0.0), lambda acc, pair: acc + F.get(self.table(), pair))
        return let(_states(token), lambda s: F.when(F.size(s) < 2, F.lit(0.0)).otherwise(total(s) / (F.size(s) - 1)))


def train(samples: DataFrame, smoothing: float = 0.5) -> Markov:
    """Counts the transitions of samples (label, token); characters outside printable ASCII count as the last state."""
    pairs = samples.filter("token is not null and length(token) > 1 and label in (0, 1)").select("label", F.explode(let(_states(F.col("token")), _transitions)).alias("pair"))
    counts = [[smoothing] * STATES * STATES for _ in range(2)]
    for row in pairs.groupBy("label", "pair").count().collect():  # STATES * STATES rows a label at most
        counts[row["label"]][row["pair"]] += row["count"]
    from math import log

    sums = [[sum(c[a * STATES : (a + 1) * STATES]) for a in range(STATES)] for c in counts]
    return Markov([log(counts[1][k] / sums[1][k // STATES]) - log(counts[0][k] / sums[0][k // STATES]) for k in range(STATES * STATES)])


_SPAN = "struct<start:int,rank:int,end:int,kind:string,match:string>"


#: Elements a scan gathers before it puts them aside, so that its time follows their number.
BLOCK = 128
#: Gaps cut from one stretch of a text; a place in a text is found by counting from the start of what is cut.
STRETCH = 512


def _scan(items: Column, kind: str, step) -> Column:
    """The arrays that ``step(at, item)`` gives, as (at, array of ``kind``) from the place before and an item, one after the other; ``at`` begins at 0."""
    none = F.array().cast(f"array<{kind}>")

    def one(acc: Column, x: Column) -> Column:
        at, out = step(acc["at"], x)
        return F.struct(at.cast("int").alias("at"), F.concat(acc["out"], out).alias("out"))

    def block(acc: Column, some: Column) -> Column:
        return let(F.aggregate(some, F.struct(acc["at"].alias("at"), none.alias("out")), one), lambda p: F.struct(p["at"].alias("at"), F.concat(acc["out"], F.array(p["out"])).alias("out")))

    def whole(p: Column) -> Column:
        return F.flatten(F.aggregate(_cut_up(p, BLOCK), F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{kind}>>").alias("out")), block)["out"])

    return let(items, whole)


def _cut_up(items: Column, size: int) -> Column:
    """An array that isn't empty in slices of ``size``."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / size).cast("int")), lambda k: F.slice(items, k * size + 1, size))


def spans(text: Column, pattern: str, kind: str, rank: int) -> Column:
    """The leftmost non-overlapping matches of ``pattern``: array of (start, rank, end, kind, match), code points, end exclusive."""
    pieces = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda gap, match: F.struct(F.length(gap).alias("gap"), match.alias("match")))

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        begin = at + x["gap"]
        end = begin + F.coalesce(F.length(x["match"]), F.lit(0))
        span = F.struct(begin.cast("int").alias("start"), F.lit(rank).alias("rank"), end.cast("int").alias("end"), F.lit(kind).alias("kind"), x["match"].alias("match"))
        return end, F.when(x["match"].isNull(), F.array().cast(f"array<{_SPAN}>")).otherwise(F.array(span))

    return F.when(text.rlike(pattern), _scan(pieces, _SPAN, step)).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _long_enough(kind: str, least: int):
    """A test for spans of a kind: the match, or for assign its second group, has ``least`` characters."""
    return lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2) if kind == "assign" else s["match"]) >= least


def base_spans(text: Column) -> Column:
    """The spans of the base kinds in order of start, then kind."""
    found = []
    for rank, (kind, pattern, least) in enumerate(KINDS):
        found.append(F.filter(spans(text, pattern, kind, rank), _long_enough(kind, least)))
    return F.array_sort(F.concat(*found))


def model_spans(text: Column, model: Markov, least_ratio: float = LEAST_RATIO) -> Column:
    """The spans of tokens that are likelier random than ordinary by ``least_ratio`` a transition."""
    return F.filter(spans(text, TOKEN, "markov", len(KINDS)), lambda s: model.score(s["match"]) >= least_ratio)


def with_secrets(docs: DataFrame, model: Markov | None = None, text_col: str = "text", out: str = "secret_spans") -> DataFrame:
    """``docs`` with arrays ``out``_base and ``out`` (all spans: the base ones, and the models' that overlap none of them)."""
    model = model or train(labelled_samples(docs.sparkSession))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    based = docs.withColumn(f"{out}_base", base_spans(text))
    clear = lambda base: F.filter(model_spans(text, model), lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (b["end"] > s["start"])))
    return based.withColumn(out, F.array_sort(F.concat(F.col(f"{out}_base"), clear(F.col(f"{out}_base")))))


def _listed(column: Column) -> Column:
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, model: Markov | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) per row of ``docs``.

    A span is that of the whole match, in code points, as kind:start:end. Null texts count as empty and have no span. Null ids
    and repeated rows are returned as they come; an empty table gives an empty result; other columns are ignored.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = with_secrets(own, model)
    base = F.col("secret_spans_base")
    number = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(number(kind) for kind, _, _ in KINDS), F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("secret_spans")).alias("spans"))


def redact_secrets(docs: DataFrame, model: Markov | None = None, text_col: str = "text", mark: str = "[SECRET]", count_col: str | None = None) -> DataFrame:
    """``docs`` with every span of a secret replaced by ``mark``, spans that overlap by one; other columns are kept.

    A text without secrets is left as it is, null included. With ``count_col`` that column holds the new text's characters where
    it was changed.
    """
    found = with_secrets(docs, model, text_col, "__secret_spans")
    text = F.col(text_col)
    last = F.struct(F.length(text).alias("start"), F.length(text).alias("end"))
    bounds = F.concat(F.transform("__secret_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))), F.array(last))

    def gap(at: Column, s: Column) -> tuple[Column, Column]:
        """What stands before a span that begins after all spans so far have ended."""
        kept = F.array(F.struct(at.alias("a"), s["start"].alias("b")))
        return F.greatest(at, s["end"]), F.when(s["start"] >= at, kept).otherwise(F.array().cast("array<struct<a:int,b:int>>"))

    def pieced(gaps: Column) -> Column:
        base = gaps[0]["a"]
        stretch = F.substring(text, base + 1, F.element_at(gaps, -1)["b"] - base)
        return let(F.struct(stretch.alias("t"), base.alias("base")), lambda x: F.array_join(F.transform(gaps, lambda g: F.substring(x["t"], g["a"] - x["base"] + 1, g["b"] - g["a"])), mark))

    whole = let(_scan(bounds, "struct<a:int,b:int>", gap), lambda gaps: F.array_join(F.transform(_cut_up(gaps, STRETCH), pieced), mark))
    changed = F.size("__secret_spans") > 0
    done = found.withColumn(text_col, F.when(changed, whole).otherwise(text))
    if count_col:
        done = done.withColumn(count_col, F.when(changed, F.length(text_col)).otherwise(F.col(count_col)).cast(docs.schema[count_col].dataType))
    return done.drop("__secret_spans", "__secret_spans_base")
