"""Ledger as a stream: lease sessions with watermarks, the batch fold's streaming form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lease_sessions(events: DataFrame, lease: str = "900 seconds", late: str = "1 hour", key: str = "user_id") -> DataFrame:
    """Unbroken spells of activity per worker: a gap of a lease ends one. Works on streams (append mode) and batches alike."""
    s = events.withWatermark("ts", late).groupBy(key, F.session_window("ts", lease).alias("w")).agg(F.count("*").alias("n"), F.min("ts").alias("first_at"), F.max("ts").alias("last_at"))
    return s.select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("expires_at"), "n", "first_at", "last_at")


def windowed_counts(events: DataFrame, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "event_type", "n")
