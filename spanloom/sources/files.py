"""Where files that one stage writes and another reads lie, and lists of settings read as tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def private_folder(spark: SparkSession, label: str) -> str:
    """A new path in the folder all executors share: spark.checkpoint.dir, or a temporary one, which only a local master may use."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    base = named.rstrip("/") if named else tempfile.mkdtemp(prefix="spanloom-")
    return f"{base}/{label}-{uuid.uuid4().hex}"


def layered(*layers: Mapping) -> dict:
    """Settings of several layers as one: later layers win, mappings are merged at every depth, other values replaced whole."""
    out: dict = {}
    for layer in layers:
        for key, value in (layer or {}).items():
            out[key] = layered(out[key], value) if isinstance(value, Mapping) and isinstance(out.get(key), Mapping) else dict(value) if isinstance(value, Mapping) else value
    return out


def read_settings(*paths: str) -> dict:
    """The layered settings of YAML files, which the driver reads; a path that isn't there counts as empty."""
    import yaml

    return layered(*(yaml.safe_load(Path(p).read_text()) or {} for p in paths if Path(p).exists()))


def alias_table(spark: SparkSession, settings: Mapping) -> DataFrame:
    """(season, token, value) of the settings' aliases by season, and the stop list with season and value null: a few rows, for lookups."""
    rows = [(season, token, value) for season, own in (settings.get("seasons") or {}).items() for token, value in (own or {}).items()]
    rows += [(None, token, None) for token in settings.get("stoplist") or ()]
    return spark.createDataFrame(rows, "season string, token string, value string")
