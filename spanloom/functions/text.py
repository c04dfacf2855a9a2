"""Text expressions: token normal forms, slugs, shares, identifiers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def token_norm(text: Column) -> Column:
    """Upper case without parentheticals, only letters, digits and .'-#, single spaces, no outer dots or dashes."""
    bare = F.regexp_replace(F.upper(text), r"\([^)]*\)", "")
    kept = F.regexp_replace(bare, r"[^A-Z0-9.'\- #]", " ")
    return F.btrim(F.regexp_replace(kept, r"\s+", " "), F.lit(" .-"))


def slug(text: Column) -> Column:
    """Lower case, runs of other characters as one dash, none at the ends."""
    return F.btrim(F.lower(F.regexp_replace(text, r"[^A-Za-z0-9]+", "-")), F.lit("-"))


def upper_share(text: Column) -> Column:
    """The share of upper-case letters among all letters; 0 without letters."""
    letters = F.regexp_count(text, F.lit(r"\p{L}"))
    return F.when(letters == 0, F.lit(0.0)).otherwise(F.regexp_count(text, F.lit(r"\p{Lu}")) / letters)


def word_tokens(text: Column) -> Column:
    """Lower-case words of letters, digits and apostrophes, curly ones folded."""
    return F.regexp_extract_all(F.lower(F.replace(text, F.lit("’"), F.lit("'"))), F.lit("([a-z0-9']+)"), F.lit(1))


def in_words(code: Column, words: Mapping[str, str], what: str = "code") -> Column:
    """What a lookup says for a code; null for null, and a code that the lookup lacks is an error that names it."""
    known = F.create_map(*(F.lit(x) for pair in words.items() for x in pair))
    said = F.try_element_at(known, code)
    return F.when(code.isNull() | said.isNotNull(), said).otherwise(F.raise_error(F.concat(F.lit(f"unknown {what}: "), code)).cast("string"))


def item_id(season: Column, episode: Column, mark: str, number: Column) -> Column:
    """Positional id such as S01_E02_U0003."""
    return F.concat(season, F.lit("_E"), F.lpad(episode.cast("string"), 2, "0"), F.lit(f"_{mark}"), F.lpad(number.cast("string"), 4, "0"))


def season_episode(text: Column) -> Column:
    """struct(season, episode, second_episode) of names such as S01E02 or S01E02E03; nulls where there is none."""
    pattern = r"(?i)S(\d{1,2})E(\d{1,3})(?:-?E(\d{1,3}))?(?!\d)"
    number = lambda k: F.nullif(F.regexp_extract(text, pattern, k), F.lit("")).cast("int")
    return F.struct(number(1).alias("season"), number(2).alias("episode"), number(3).alias("second_episode"))


#: Fixed values of subtitle lines: tags, turn marks, a speaker prefix, whole-line sounds, music.
TAG = r"<[^>]+>|\{\\[^}]*\}"
TURN = r"^\s*(?:>>|[-–—])\s*"
SPEAKER = r"^\s*([A-Z][A-Z0-9.'\-#]*(?:\s+[A-Z0-9#][A-Z0-9.'\-#]*){0,2})\s*(?:\([^)]*\))?\s*:\s*(.*)$"
SOUND = r"^\s*(?:\([^)]*\)|\[[^\]]*\]|♪+.*♪*|\*[^*]*\*)\s*$"
MUSIC = "[♪♫]"
INVISIBLE = "[\u200b\ufeff]"


def clean_line(text: Column) -> Column:
    """struct(text, name, is_turn, is_sound) of a subtitle line: tags, marks, a leading NAME: of two letters or more, bracketed sounds and
    spare space taken off; a line that is only a sound, or music with fewer than three other characters, has no text."""
    bare = F.btrim(F.regexp_replace(F.regexp_replace(F.btrim(text, F.lit(" \t\r\n")), TAG, ""), INVISIBLE, ""), F.lit(" \t\r\n"))
    turn = bare.rlike(TURN)
    body = F.regexp_replace(bare, TURN, "")
    prefix = F.regexp_extract(body, SPEAKER, 1)
    named = F.length(prefix) >= 2
    name = F.when(named, F.btrim(F.regexp_replace(prefix, r"\s+", " "), F.lit(" .")))
    rest = F.when(named, F.regexp_extract(body, SPEAKER, 2)).otherwise(body)
    sound = (F.length(rest) > 0) & (rest.rlike(SOUND) | (rest.rlike(MUSIC) & (F.length(F.regexp_replace(rest, r"[♪♫\s]", "")) < 3)))
    words = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(rest, r"\([^()]*\)", ""), r"\[[^\[\]]*\]", ""), r"\s+", " "))
    return F.struct(F.when(sound, F.lit("")).otherwise(words).alias("text"), name.alias("name"), turn.alias("is_turn"), sound.alias("is_sound"))


def italic_lines(lines: DataFrame, keys: Sequence[str], order: str, text: str) -> DataFrame:
    """``lines`` with is_italic: the line opens an italic tag, or an earlier line of its key opened one that is still open.

    A line that opens and closes leaves the state as it was, one that only opens sets it, one that only closes ends it.
    """
    opens, closes = F.col(text).rlike(r"(?i)<i\b[^>]*>"), F.col(text).rlike(r"(?i)</i\s*>")
    change = F.when(opens & ~closes, True).when(closes & ~opens, False)
    before = F.last(change, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return lines.withColumn("is_italic", opens | F.coalesce(before, F.lit(False)))


def name_words(text: Column) -> Column:
    """The runs of ASCII letters, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z]+)"), F.lit(1))


#: Fixed value of on-screen place cards: a tribe, then day or night and its number.
PLACE = r"^([A-Z][A-Z' .-]{1,30}?)\s*(?:TRIBE)?\s*[/|]?\s*(DAY|NIGHT)\s*(\d{1,2})\b"


def location_card(lines: Column) -> Column:
    """struct(tribe, kind, n) of an on-screen place card, its lines (array) in normal form and joined by a stroke; null if it is none."""
    kept = F.filter(lines, lambda x: F.length(F.trim(x)) > 0)
    joined = F.array_join(F.transform(kept, token_norm), " / ")
    part = lambda k: F.regexp_extract(joined, PLACE, k)
    return F.when(joined.rlike(PLACE), F.struct(F.trim(F.replace(part(1), F.lit(" TRIBE"), F.lit(""))).alias("tribe"), F.lower(part(2)).alias("kind"), part(3).cast("int").alias("n")))


def contains_any(text: Column, parts: Sequence[str]) -> Column:
    """Whether a text holds one of some lower-case parts, whatever its case; false for null."""
    found = F.lit(False)
    for part in parts:
        found = found | F.coalesce(F.contains(F.lower(text), F.lit(part)), F.lit(False))
    return found


def int_list(text: Column) -> Column:
    """The whole numbers of a comma-separated list; empty parts are left out."""
    return F.transform(F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != ""), lambda x: x.cast("int"))


def markdown_table(heads: Sequence[str], rows: Column, cells) -> Column:
    """A markdown table of an array of structs; ``cells(row)`` gives a row's columns."""
    line = lambda values: F.concat(F.lit("| "), F.concat_ws(" | ", *values), F.lit(" |"))
    top = f"| {' | '.join(heads)} |\n|{'---|' * len(heads)}"
    return F.concat_ws("\n", F.lit(top), F.transform(rows, lambda r: line([F.coalesce(c.cast("string"), F.lit("")) for c in cells(r)])))


def _common(a: str, b: str) -> int:
    """The length of the longest common subsequence, by bit-parallel rows."""
    places: dict[str, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


#: Pairs worked on together, and characters of a bit row.
PAIRS, BITS = 4096, 64


def _common_many(a: list[str], b: list[str]) -> np.ndarray:
    """``_common`` of many pairs: the shorter text of each is a row of bits in one integer, and all pairs take a character of the other at a time."""
    out = np.zeros(len(a), np.int64)
    short, long = [min(x, y, key=len) for x, y in zip(a, b, strict=True)], [max(y, x, key=len) for x, y in zip(a, b, strict=True)]
    sizes, steps = np.fromiter(map(len, short), np.int64, len(a)), np.fromiter(map(len, long), np.int64, len(a))
    for k in np.flatnonzero(sizes > BITS).tolist():
        out[k] = _common(short[k], long[k])
    small = np.flatnonzero(sizes <= BITS)
    small = small[np.argsort(steps[small], kind="stable")]
    for at in (small[k : k + PAIRS] for k in range(0, small.size, PAIRS)):
        most = int(steps[at[-1]])
        codes = lambda texts, width, fill: np.stack([np.frombuffer(texts[k].encode("utf-32-le"), np.uint32) if len(texts[k]) == width else np.r_[np.frombuffer(texts[k].encode("utf-32-le"), np.uint32), np.full(width - len(texts[k]), fill, np.uint32)] for k in at.tolist()])
        # what fills up is no character, nor the same on both sides
        left, right = codes(short, BITS, 0xFFFFFFFE), codes(long, most, 0xFFFFFFFF)
        row = np.full(at.size, np.iinfo(np.uint64).max, np.uint64)
        for step in range(most):
            hit = row & np.packbits(left == right[:, step : step + 1], axis=1, bitorder="little").view("<u8")[:, 0]
            row = (row + hit) | (row - hit)
        held = np.where(sizes[at] == BITS, np.iinfo(np.uint64).max, (np.uint64(1) << (sizes[at] % BITS).astype(np.uint64)) - np.uint64(1))
        out[at] = sizes[at] - np.bitwise_count(row & held).astype(np.int64)
    return out


def _ratio_many(a: list[str], b: list[str]) -> np.ndarray:
    total = np.fromiter((len(x) + len(y) for x, y in zip(a, b, strict=True)), np.float64, len(a))
    return np.where(total > 0, 200.0 * _common_many(a, b) / np.maximum(total, 1), 100.0)


def _given(a: pd.Series, b: pd.Series) -> np.ndarray:
    return np.flatnonzero(a.notna().to_numpy() & b.notna().to_numpy())


def _ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    at, out = _given(a, b), pd.Series(np.full(len(a), None), dtype="float64")
    if at.size:
        out.iloc[at] = _ratio_many(a.iloc[at].tolist(), b.iloc[at].tolist())
    return out


def _parts(a: pd.Series, b: pd.Series) -> pd.Series:
    """All stretches of the longer texts are pairs with the shorter ones, some thousand at a time."""
    at, out = _given(a, b), pd.Series(np.full(len(a), None), dtype="float64")
    best = np.zeros(at.size)
    left, right, owner = [], [], []

    def told() -> None:
        np.maximum.at(best, owner, _ratio_many(left, right))
        left.clear(), right.clear(), owner.clear()

    for k, (x, y) in enumerate(zip(a.iloc[at].tolist(), b.iloc[at].tolist(), strict=True)):
        short, long = sorted((x, y), key=len)
        if not long:
            best[k] = 100.0
        for start in range(1 - len(short), len(long)):
            left.append(short)
            right.append(long[max(0, start) : start + len(short)])
            owner.append(k)
            if len(left) >= PAIRS:
                told()
    if left:
        told()
    out.iloc[at] = best
    return out


def indel_ratio(a: Column, b: Column) -> Column:
    """100 times the share of characters that insertions and deletions leave of two texts; null for null."""
    return F.pandas_udf(_ratios, "double")(a, b)


def partial_ratio(a: Column, b: Column) -> Column:
    """The best ratio of the shorter text with a stretch of the longer one of at most its length; null for null."""
    return F.pandas_udf(_parts, "double")(a, b)
