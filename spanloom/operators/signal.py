"""Sampled signals as arrays: loudness frames, cue frames, signal ratios, packed vectors, ragged tracks, anchor fits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _mean_square(samples: Column) -> Column:
    return F.aggregate(samples, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"), lambda acc: acc / F.greatest(F.size(samples), F.lit(1)))


def log_rms(samples: Column, hop: int) -> Column:
    """array<double>: log(rms + 1e-6) of each whole frame of ``hop`` samples."""
    frames = F.transform(F.sequence(F.lit(1), F.floor(F.size(samples) / hop).cast("int")), lambda k: F.slice(samples, (k - 1) * hop + 1, hop))
    made = F.transform(frames, lambda f: F.ln(F.sqrt(_mean_square(f) + 1e-12) + 1e-6))
    return F.when(F.size(samples) >= hop, made).otherwise(F.array().cast("array<double>"))


def rms_ratio(samples: Column, raw: Column) -> Column:
    """The loudness of a slice over that of the raw one, a proxy of its share of the signal."""
    return F.sqrt(_mean_square(samples)) / (F.sqrt(_mean_square(raw)) + 1e-9)


def cue_frames(cues: DataFrame, lengths: DataFrame, key: str, start: str, end: str, n: str, hop: float) -> DataFrame:
    """(key, on array<double>): a signal of ``n`` frames per key (table ``lengths``), 1 where a cue is on.

    A cue covers frames floor(start / hop) up to ceil(end / hop), cut to the signal; frames are exploded and made distinct, so
    overlapping cues count once.
    """
    bounded = cues.join(lengths.select(key, n), key).select(key, n, F.greatest(F.floor(F.col(start) / hop), F.lit(0)).alias("a"), F.least(F.ceil(F.col(end) / hop), F.col(n)).alias("b")).filter("b > a")
    frames = bounded.select(key, F.explode(F.sequence(F.col("a"), F.col("b") - 1)).alias("f")).groupBy(key).agg(F.collect_set("f").alias("fs"))
    whole = lengths.select(key, n).join(frames, key, "left").withColumn("fs", F.map_from_arrays(F.coalesce("fs", F.array().cast("array<bigint>")), F.transform(F.coalesce("fs", F.array().cast("array<bigint>")), lambda x: F.lit(1.0))))
    on = F.when(F.col(n) > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1), lambda k: F.coalesce(F.try_element_at("fs", k), F.lit(0.0)))).otherwise(F.array().cast("array<double>"))
    return whole.select(key, on.alias("on"))


def packed_vector(vector: Column) -> Column:
    """A vector as the bytes of its little-endian single-precision numbers."""
    return F.pandas_udf(_packed, "binary")(vector)


def unpacked_vector(data: Column) -> Column:
    """The vector whose bytes ``packed_vector`` gives; null where the length is no multiple of four."""
    return F.pandas_udf(_unpacked, "array<float>")(data)


def _packed(vectors):
    import numpy as np

    return vectors.map(lambda v: None if v is None else np.asarray(v, "<f4").tobytes())


def _unpacked(data):
    import numpy as np

    return data.map(lambda b: None if b is None or len(b) % 4 else np.frombuffer(b, "<f4"))


def ragged_frames(tracks: DataFrame, key: str, starts: str, lengths: str, values: str) -> DataFrame:
    """(key, window_start, frame_no, value): the frames of ragged tracks, a window's values being the next ``lengths`` of the flat array."""
    ends = F.aggregate(lengths, F.array(F.lit(0).cast("long")), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n.cast("long"))))
    cut = tracks.select(key, F.col(values).alias("__v"), F.posexplode(F.arrays_zip(F.col(starts).alias("s"), F.col(lengths).alias("n"))).alias("k", "w"), ends.alias("e"))
    one = cut.select(key, F.col("w.s").alias("window_start"), F.slice("__v", F.get("e", F.col("k")).cast("int") + 1, F.col("w.n").cast("int")).alias("x"))
    return one.select(key, "window_start", F.posexplode("x").alias("frame_no", "value"))


def anchor_fit(bounds: DataFrame, cues: DataFrame, key: str, least_share: float = 0.3, least_knots: int = 10) -> DataFrame:
    """(key, share, n_knots, offset, source): the median lag of matched cue boundaries (key, kind, cue, t_s, lag) where enough cues' starts are
    matched and there are knots enough, else source envelope and no offset. ``cues`` has a row a cue."""
    counts = cues.groupBy(key).agg(F.count("*").alias("n_cues"))
    found = bounds.groupBy(key).agg(F.countDistinct(F.when(F.col("kind") == "s", F.col("cue"))).alias("n_starts"), F.countDistinct(F.round("t_s", 2)).alias("n_knots"), F.percentile("lag", F.lit(0.5)).alias("lag"))
    both = counts.join(found, key, "left").na.fill(0, ["n_starts", "n_knots"]).withColumn("share", F.col("n_starts") / F.greatest(F.col("n_cues"), F.lit(1)))
    good = (F.col("share") >= least_share) & (F.col("n_knots") >= least_knots)
    return both.select(key, "share", "n_knots", F.when(good, F.col("lag")).alias("offset"), F.when(good, "anchors").otherwise("envelope").alias("source"))
