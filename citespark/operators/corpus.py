"""Captures, readings and the current snapshot; sampling; set comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row per key: the first by `order`. A rank limit cuts rows before the shuffle, so a hot key costs little."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("__n = 1").drop("__n")


def current_readings(readings: DataFrame) -> DataFrame:
    """(url_hash, version, ingested_at, status) with is_current: the latest not failed one of each url_hash."""
    usable = F.col("status") != "failed"
    w = Window.partitionBy("url_hash").orderBy(usable.desc(), F.desc("ingested_at"), F.desc("version"))
    return readings.withColumn("is_current", (F.row_number().over(w) == 1) & usable)


def merge_readings(old: DataFrame, new: DataFrame) -> DataFrame:
    """Snapshot after an append: rows of `new` replace those of equal (url_hash, version); is_current is derived anew."""
    kept = old.drop("is_current").join(new.select("url_hash", "version"), ["url_hash", "version"], "left_anti")
    return current_readings(kept.unionByName(new))


def seed_tasks(captures: DataFrame, tasks: DataFrame, max_bytes: int = 100 << 20) -> DataFrame:
    """New tasks: newest successful 2xx capture of each url_hash within the size limit that has no task yet."""
    ok = captures.where((F.col("status") == "success") & F.col("http_status").startswith("2") & (F.col("bytes") <= max_bytes))
    return newest(ok, "url_hash", [F.desc("finished_at"), F.desc("capture_id")]).join(tasks.select("url_hash"), "url_hash", "left_anti")


def stratified_sample(rows: DataFrame, stratum: str, key: str, seed: str, per_stratum: int, caps: dict[str, int] | None = None) -> DataFrame:
    """The same rows every time: the first of each stratum by md5(key + seed), up to its cap."""
    most = F.lit(per_stratum)
    for name, n in (caps or {}).items():
        most = F.when(F.col(stratum) == name, n).otherwise(most)
    w = Window.partitionBy(stratum).orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(seed))))
    return rows.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= most)


def nearest_rank(rows: DataFrame, group: str, value: str, fractions: tuple[float, ...]) -> DataFrame:
    """Nearest-rank percentiles: the value at place round(f * (n - 1)), halves to even; no interpolation."""
    w = Window.partitionBy(group)
    placed = rows.select(group, value, (F.row_number().over(w.orderBy(value)) - 1).alias("i"), F.count("*").over(w).alias("n"))
    return placed.groupBy(group).agg(*[F.max(F.when(F.col("i") == F.rint(F.lit(f) * (F.col("n") - 1)), F.col(value))).alias(f"p{round(100 * f)}") for f in fractions])


def filter_rows(rows: DataFrame, outlet=None, section=None, tag=None, author=None, date_from=None, date_to=None, date: str = "published_at") -> DataFrame:
    """Exact filters; None filters nothing. The last day of a range is in it whole."""
    if outlet is not None:
        rows = rows.where(F.col("outlet") == outlet)
    if section is not None:
        rows = rows.where(F.col("section") == section)
    if tag is not None:
        rows = rows.where(F.array_contains("tags", tag))
    if author is not None:
        rows = rows.where(F.array_contains("authors", author))
    if date_from is not None:
        rows = rows.where(F.col(date) >= F.lit(date_from).cast("timestamp"))
    if date_to is not None:
        rows = rows.where(F.col(date) < F.date_add(F.lit(date_to).cast("date"), 1).cast("timestamp"))
    return rows
