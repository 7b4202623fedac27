"""Parquet tables of a data folder, read by column."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir); a local one only where none is set and all runs in one process."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = _WRITTEN.setdefault("folder", "file://" + tempfile.mkdtemp(prefix="citespark-"))
    return found.rstrip("/")


_WRITTEN: dict = {}


def derived(spark: SparkSession, source: DataFrame, name: str | tuple, build, write) -> DataFrame:
    """A table built from `source` once and kept in the shared folder for later queries of the application.

    It is built anew when the files of `source` are not those it was built from. `build` gives the table, `write` (table, path) writes it.
    What a tuple holds after a name tells tables of that name apart.
    """
    files = source.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    state = files.agg(F.count("*"), F.sum(F.xxhash64("file_path", "file_size", "file_modification_time").cast("decimal(38,0)"))).first()
    key = (spark.sparkContext.applicationId, name, str(state[0]), str(state[1]))
    if key not in _WRITTEN:
        table = build()
        path = f"{shared_folder(spark)}/citespark/{name if isinstance(name, str) else name[0]}-{uuid.uuid4().hex}"
        write(table, path)
        _WRITTEN[key] = (path, table.schema)
    path, schema = _WRITTEN[key]
    return spark.read.schema(schema).parquet(path)
