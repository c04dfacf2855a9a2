"""Streams of inputs that come late or are corrected, and what is derived from them.

Each micro-batch is stored under its own number, which a batch that runs again writes over: so a run that was stopped anywhere goes on from its
checkpoint and gives the rows of one that was not. The newest version of a key counts, in whatever order versions arrive. What is derived
from inputs that changed is made again from those, beside what it was before, and once more if it is still out of date; what is out of
date after that is told as a row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def newest(rows: DataFrame, key: str, version: str, batch: str = "batch") -> DataFrame:
    """Of each key's rows that with the greatest version; of equal versions the later batch's, then that which is the greatest as JSON."""
    order = Window.partitionBy(key).orderBy(F.desc(version), F.desc(batch), F.desc(F.to_json(F.struct(*(c for c in rows.columns if c != batch)))))
    return rows.withColumn("__r", F.row_number().over(order)).filter("__r = 1").drop("__r", batch)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All batches stored so far, with their number; nothing where there are none."""
    probe = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = probe.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch=*/_SUCCESS"))
    found = [s.getPath().getParent().toString() for s in there or ()]
    whole = f"{schema}, batch long"
    return spark.read.schema(whole).option("basePath", path).parquet(*found) if found else spark.createDataFrame([], whole)


def _shape(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def made_with_retry(todo: DataFrame, before: DataFrame, key: str, version: str, make: Callable[[DataFrame, DataFrame], DataFrame], folder: str) -> tuple[DataFrame, DataFrame]:
    """What ``make(inputs, derived before)`` gives for ``todo``, and (key, reason) of inputs whose derived row is missing or of another version even after
    one more try. Both tries are stored in ``folder``, so each input is made once or twice, not once a use."""
    spark = todo.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    def outdated(inputs: DataFrame, made: DataFrame) -> DataFrame:
        had = made.select(key, F.col(version).alias("__v"), F.lit(True).alias("__there")).dropDuplicates([key])
        reason = F.when(F.col("__there").isNull(), "missing").when(~F.col("__v").eqNullSafe(F.col(version)), "changed")
        return inputs.join(had, key, "left").withColumn("reason", reason).filter("reason is not null").select(key, "reason")

    first = stored(make(todo, before), "first")
    again = todo.join(outdated(todo, first).select(key), key, "left_semi")
    if again.isEmpty():
        return first, outdated(todo, first)
    second = stored(make(again, before), "second")
    whole = first.join(again.select(key), key, "left_anti").unionByName(second)
    return whole, outdated(todo, whole)


def follow(stream: DataFrame, folder: str, key: str, version: str, make: Callable[[DataFrame, DataFrame], DataFrame], derived: str, each: Callable[[int, str], None] = lambda number, step: None) -> None:
    """Takes in all of ``stream`` (key, version, more) that is there, a micro-batch at a time, and keeps what ``make(inputs, derived before)`` derives.

    ``derived`` is the schema of derived rows, which have key and version. Only the keys of a batch are made again, and only if the
    batch's row is the newest. ``each(number, step)`` is called before a batch's steps. Null keys are left out.
    """
    spark, inputs_shape = stream.sparkSession, _shape(stream)

    def batch(rows: DataFrame, number: int) -> None:
        each(number, "inputs")
        rows.filter(F.col(key).isNotNull()).write.mode("overwrite").parquet(f"{folder}/inputs/batch={number}")
        each(number, "derived")
        mine = spark.read.schema(inputs_shape).parquet(f"{folder}/inputs/batch={number}").select(key).distinct()
        upto = lambda part, shape: _read(spark, f"{folder}/{part}", shape).join(mine, key, "left_semi")
        now = newest(upto("inputs", inputs_shape).filter(F.col("batch") <= number), key, version)
        before = newest(upto("derived", derived).filter(F.col("batch") < number), key, version)
        had = before.select(key, F.col(version).alias("__v"))
        todo = now.join(had, key, "left").filter("__v is null or __v < " + f"`{version}`").select(now.columns)
        made, late = made_with_retry(todo, before, key, version, make, f"{folder}/tries/{number}")
        made.write.mode("overwrite").parquet(f"{folder}/derived/batch={number}")
        late.write.mode("overwrite").parquet(f"{folder}/late/batch={number}")

    stream.writeStream.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).foreachBatch(batch).start().awaitTermination()


def derived_rows(spark: SparkSession, folder: str, key: str, version: str, derived: str) -> DataFrame:
    """What is derived from the newest inputs so far."""
    return newest(_read(spark, f"{folder}/derived", derived), key, version)


def late_rows(spark: SparkSession, folder: str, key: str, key_type: str = "long") -> DataFrame:
    """(key, reason, batch): what stayed out of date."""
    return _read(spark, f"{folder}/late", f"{key} {key_type}, reason string")
