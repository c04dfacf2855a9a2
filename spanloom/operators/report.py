"""Reports: inventories, causes, resolution and corpus statistics, ablations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def probable_cause(delta: Column, duration: Column, last: Column, listed_min: Column, late: float) -> Column:
    """Why a subtitle's times don't fit its file: the first rule that holds, as text. Times in seconds, ``listed_min`` the listed length in minutes."""
    whole = lambda x: F.format_string("%.0f", x + F.lit(0.0))  # noqa: E731  no minus before a zero
    return (
        F.when(delta.isNull(), "unknown")
        .when((listed_min > 0) & (duration > 1.7 * listed_min * 60) & (duration > 70 * 60), F.concat(F.lit("probably a double episode ("), whole(duration / 60), F.lit(" min against "), whole(listed_min), F.lit(")")))
        .when((delta > late) & (delta < 120), F.concat(F.lit("runs "), whole(delta), F.lit(" s past the end: frame-rate drift")))
        .when(delta > late, F.concat(F.lit("covers "), whole(delta / 60), F.lit(" min more than the file: other cut or wrong episode")))
        .when((duration > 0) & (last < 0.7 * duration), F.concat(F.lit("truncated at "), whole(100 * last / duration), F.lit(" %")))
        .otherwise(F.concat(F.lit("ends "), whole(-delta / 60), F.lit(" min early: different cut")))
    )


def inventory(episodes: DataFrame, season: str, longest_delta: float) -> dict[str, DataFrame]:
    """The frames of an inventory: per_season counts, missing subtitles, bad timings, double episodes, and lengths that don't fit.

    ``episodes`` has source (none, or a kind ending in sdh or starting with embedded), timing_ok, is_double, channels, length_delta.
    """
    off = F.abs("length_delta") > longest_delta
    counts = {
        "n_episodes": F.count("*"), "n_no_subs": F.count_if(F.col("source") == "none"), "n_sdh": F.count_if(F.col("source").endswith("sdh")), "n_embedded": F.count_if(F.col("source").startswith("embedded")),
        "n_timing_bad": F.count_if(F.col("timing_ok") == 0), "n_doubles": F.count_if(F.col("is_double") == 1), "n_51": F.count_if(F.col("channels") == 6), "n_length_mismatch": F.count_if(off),
    }
    return {
        "per_season": episodes.groupBy(season).agg(*(c.alias(n) for n, c in counts.items())), "missing": episodes.filter("source = 'none'"), "timing_bad": episodes.filter("timing_ok = 0"),
        "doubles": episodes.filter("is_double = 1"), "length_mismatch": episodes.filter(off),
    }


def resolution_report(tokens: DataFrame, season: str, kind: str, lines: str, kinds: Sequence[str]) -> DataFrame:
    """(season, lines, a column a kind, pct_resolved): lines by how their name was resolved; those of stop words don't count in the share."""
    of = lambda names: F.sum(F.when(F.col(kind).isin(*names), F.col(lines)).otherwise(0))
    named = F.sum(F.when(F.col(kind) != "stop", F.col(lines)).otherwise(0))
    done = [k for k in kinds if k not in ("stop", "ambiguous", "unresolved")]
    return tokens.groupBy(season).agg(F.sum(lines).alias("lines"), *(of([k]).alias(k) for k in kinds), F.round(100 * F.try_divide(of(done), named), 1).alias("pct_resolved"))


def corpus_statistics(items: DataFrame, split: str, episode: str, label: str, seconds: str) -> DataFrame:
    """(of, name, n, hours): the corpus in all, per split (episodes too) and per label."""
    hours = F.round(F.sum(seconds) / 3600, 2)
    frames = [items.agg(F.lit("all").alias("of"), F.lit("items").alias("name"), F.count("*").alias("n"), hours.alias("hours"))]
    frames.append(items.agg(F.lit("all").alias("of"), F.lit("labels").alias("name"), F.countDistinct(label).alias("n"), hours.alias("hours")))
    for of, column in (("split", split), ("label", label)):
        frames.append(items.groupBy(F.col(column).cast("string").alias("name")).agg(F.count("*").alias("n"), hours.alias("hours")).select(F.lit(of).alias("of"), "name", "n", "hours"))
    frames.append(items.groupBy(F.col(split).cast("string").alias("name")).agg(F.countDistinct(episode).alias("n"), hours.alias("hours")).select(F.lit("episodes").alias("of"), "name", "n", "hours"))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def ablation(scored: DataFrame, variant: str, hit: Column, groups: dict[str, Column]) -> DataFrame:
    """(variant, subset, n, accuracy): each variant's accuracy over all rows and over each named subset."""
    rows = scored.withColumn("__hit", hit.cast("double"))
    subsets = F.array(F.lit("all"), *(F.when(c, F.lit(name)) for name, c in groups.items()))
    return rows.withColumn("subset", F.explode(F.filter(subsets, lambda x: x.isNotNull()))).groupBy(variant, "subset").agg(F.count("*").alias("n"), F.avg("__hit").alias("accuracy"))


def episode_titles(items: DataFrame, listed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``items`` with title and length of their listed episode; entries without an episode number don't count, of several the first by title."""
    known = listed.dropna(subset=list(keys)).groupBy(*keys).agg(F.min(F.struct("title", "length")).alias("__t"))
    return items.join(known, list(keys), "left").select(*items.columns, "__t.title", "__t.length")
