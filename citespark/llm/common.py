"""Shared pieces: durable intermediate tables and distributed running totals."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citespark.sources.tables import shared_folder as shared_dir

#: Words are runs of anything but space and the ASCII controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, for files that tasks write or read themselves, and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def store(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Write `df` once as a Parquet table in the shared folder and read it back: cuts lineage, survives lost executors.

    The shuffle files of the write are dropped when it ends: nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/citespark/{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        writer.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path  # type: ignore[attr-defined]
    return out


def forget(df: DataFrame) -> None:
    """Delete the table behind a DataFrame that `store` returned and that nothing reads any more."""
    path = getattr(df, "stored_at", None)
    if path:
        spark = df.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def running_totals(df: DataFrame, group: list[str], order: list[str], values: dict[str, str]) -> DataFrame:
    """Add exclusive running totals inside each group without gathering a group in one task.

    `values` maps a column to the name of its running total (the sum over the rows before it).
    Rows are range-partitioned by (group, order), so a hot group spreads over many tasks; the
    totals of the partitions (one row per partition and group in it) are summed by a window, and
    a window inside each partition adds the rest. Group columns must not be null. Rows equal in
    all of `group` and `order` stand in any order among themselves.
    """
    pid = "__pid"
    ranged = store(df.repartitionByRange(*group, *order).withColumn(pid, F.spark_partition_id()))
    sums = ranged.groupBy(pid, *group).agg(*[F.sum(v).alias(f"__s_{v}") for v in values])
    # at most one row per partition and group in it
    before = Window.partitionBy(*group).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(pid, *group, *[F.coalesce(F.sum(f"__s_{v}").over(before), F.lit(0)).alias(f"__o_{v}") for v in values])
    inside = Window.partitionBy(pid, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"__l_{v}") for v in values])
    out = local.join(offsets, [pid, *group])
    return out.select(*df.columns, *[(F.col(f"__l_{v}") + F.col(f"__o_{v}")).cast("long").alias(name) for v, name in values.items()])


def packed(docs: DataFrame, **columns) -> DataFrame:
    """`docs` as one struct column `row`, so that none of its names clashes with the working `columns` (expressions over `docs`)."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in columns.items()])


def unpacked(rows: DataFrame, names: list[str]) -> DataFrame:
    """The columns that `packed` put away."""
    return rows.select(*[F.col("row").getField(c).alias(c) for c in names])


def word_count(text):
    """Number of words of a string column; null and blank texts have none."""
    blank = " \t\n\x0b\x0c\r"
    trimmed = F.btrim(text, F.lit(blank))
    return F.when(F.coalesce(F.length(trimmed), F.lit(0)) == 0, F.lit(0)).otherwise(F.size(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))).cast("long")
