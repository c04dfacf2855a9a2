"""Versions of a table that are checked: a copy with a manifest, published by one pointer, verified when read, rotated.

A version is a folder of its own, so a reader never sees a half-written one: the pointer is renamed into place once the version and its
manifest are there. A manifest has each file's rows and a hash of them that doesn't depend on their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MANIFEST = "file string, n long, hash string"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _written(spark: SparkSession, path: str, text: str) -> None:
    """A small file put in place by one rename, over an older one."""
    jvm = spark._jvm
    out = _files(spark, path).create(_path(spark, f"{path}.partial"), True)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, path).toUri(), spark._jsc.hadoopConfiguration()).rename(_path(spark, f"{path}.partial"), _path(spark, path), options)


def _sums(rows: DataFrame) -> DataFrame:
    """(file, n, hash) of the rows read from each file; the hash is a sum over rows, so their order doesn't count."""
    whole = F.xxhash64(*(F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`") for f in rows.schema))
    return rows.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), whole.cast("decimal(38,0)").alias("h")).groupBy("file").agg(F.count("*").alias("n"), F.sum("h").cast("string").alias("hash"))


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    """(file): the data files in a folder."""
    names = [s.getPath().getName() for s in _files(spark, folder).listStatus(_path(spark, folder)) if s.getPath().getName().startswith("part-")]
    return spark.createDataFrame([(n,) for n in names], "file string")


def versions(spark: SparkSession, folder: str) -> list[str]:
    """The versions that have a manifest, in order of name."""
    fs = _files(spark, folder)
    if not fs.exists(_path(spark, folder)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(_path(spark, folder)) if s.isDirectory()]
    return sorted(n for n in names if fs.exists(_path(spark, f"{folder}/{n}/manifest/_SUCCESS")))


def current(spark: SparkSession, folder: str) -> str | None:
    """The version that is published."""
    fs, at = _files(spark, folder), f"{folder}/CURRENT"
    return spark.read.text(at, wholetext=True).first()[0] if fs.exists(_path(spark, at)) else None


def write_snapshot(df: DataFrame, folder: str, version: str) -> str:
    """Writes ``df`` as a version, with its manifest, and publishes it. A version that was published before is not written over."""
    spark, base = df.sparkSession, f"{folder}/{version}"
    if version in versions(spark, folder):
        raise ValueError(f"version {version} is there already")
    df.write.mode("overwrite").parquet(f"{base}/data")
    sums = _listed(spark, f"{base}/data").join(_sums(spark.read.schema(df.schema).parquet(f"{base}/data")), "file", "left").na.fill(0, ["n"])
    sums.coalesce(1).write.mode("overwrite").json(f"{base}/manifest")  # a row a file
    _written(spark, f"{folder}/CURRENT", version)
    return version


def check_snapshot(spark: SparkSession, folder: str, version: str) -> DataFrame:
    """(file, state): of each file of a version whether its rows are those of the manifest: ok, changed, missing or unknown; unreadable ones are changed."""
    base = f"{folder}/{version}"
    told = spark.read.schema(_MANIFEST).json(f"{base}/manifest")
    listed = _listed(spark, f"{base}/data")
    read = _sums(spark.read.option("ignoreCorruptFiles", "true").parquet(f"{base}/data")) if not listed.isEmpty() else spark.createDataFrame([], _MANIFEST)
    both = told.join(listed.withColumn("listed", F.lit(True)), "file", "full").join(read.select("file", F.col("n").alias("n_now"), F.col("hash").alias("hash_now")), "file", "left").na.fill(0, ["n_now"])
    same = F.col("n").eqNullSafe(F.col("n_now")) & F.col("hash").eqNullSafe(F.col("hash_now"))
    return both.select("file", F.when(F.col("n").isNull(), "unknown").when(F.col("listed").isNull(), "missing").when(same, "ok").otherwise("changed").alias("state"))


def read_snapshot(spark: SparkSession, folder: str, version: str | None = None, check: bool = True) -> DataFrame:
    """The rows of a version, by default the published one; with ``check`` a damaged one is an error that names the files."""
    version = version or current(spark, folder)
    if version is None:
        raise FileNotFoundError(f"no version is published in {folder}")
    if check:
        bad = check_snapshot(spark, folder, version).filter("state <> 'ok'").orderBy("file").limit(20).collect()
        if bad:
            raise ValueError(f"version {version} is damaged: " + ", ".join(f"{r['file']} {r['state']}" for r in bad))
    return spark.read.parquet(f"{folder}/{version}/data")


def rotate(spark: SparkSession, folder: str, keep: int) -> list[str]:
    """Removes all but the ``keep`` last versions (one at least, and never the published one); returns what went."""
    known, kept_one = versions(spark, folder), current(spark, folder)
    gone = [v for v in known[: len(known) - max(1, keep)] if v != kept_one]
    for v in gone:
        _files(spark, folder).delete(_path(spark, f"{folder}/{v}"), True)
    return gone
