"""Task states from an append-only event log: claims, heartbeats, leases, retries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEASE_SECONDS = 900
MAX_ATTEMPTS = 3


def fold_events(events: DataFrame) -> DataFrame:
    """State per task of (task, seq, ts, kind, worker): the last decisive event wins; attempts count claims.

    kind: seed, claim, heartbeat, finish, fail, release, ingest. A failure leaves `failed` until MAX_ATTEMPTS claims are used up, then
    `quarantined`.
    """
    at = F.struct("ts", "seq")
    decisive = F.col("kind").isin("seed", "claim", "finish", "fail", "release", "ingest")
    out = events.groupBy("task").agg(
        F.max_by(F.when(decisive, F.col("kind")), F.when(decisive, at)).alias("last"),
        F.count_if(F.col("kind") == "claim").alias("attempts"),
        F.max(F.when(F.col("kind").isin("claim", "heartbeat"), F.col("ts"))).alias("seen_at"),
        F.max_by(F.when(F.col("kind") == "claim", F.col("worker")), F.when(F.col("kind") == "claim", at)).alias("worker"),
    )
    return out.withColumn("state", state_of(F.col("last"), F.col("attempts")))


def state_of(last: Column, attempts: Column) -> Column:
    return (
        F.when(last == "claim", "processing").when(last == "finish", "done").when(last == "ingest", "ingested")
        .when((last == "fail") & (attempts >= MAX_ATTEMPTS), "quarantined").when(last == "fail", "failed").otherwise("pending")
    )


def stale(tasks: DataFrame, now: Column, lease: int = LEASE_SECONDS) -> DataFrame:
    """Tasks in processing whose worker was last seen before now - lease, with the state they return to."""
    old = (F.col("state") == "processing") & (F.col("seen_at") < now - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(lease)))
    return tasks.where(old).withColumn("next_state", F.when(F.col("attempts") >= MAX_ATTEMPTS, "quarantined").otherwise("pending"))


def claim_batches(tasks: DataFrame, workers: int, batch: int) -> DataFrame:
    """Deterministic batches instead of row locks: each claimable task goes to a worker by its hash, in task order, `batch` at a time."""
    ready = tasks.where(F.col("state").isin("pending", "failed") & (F.col("attempts") < MAX_ATTEMPTS))
    ready = ready.withColumn("worker_no", F.pmod(F.crc32(F.col("task").cast("string")), F.lit(workers)))
    place = F.row_number().over(Window.partitionBy("worker_no").orderBy("task"))
    return ready.select("task", "worker_no", F.floor((place - 1) / batch).alias("batch_no"))


def summary(tasks: DataFrame, by: str | None = None) -> DataFrame:
    states = ("pending", "processing", "done", "ingested", "failed", "quarantined")
    return (tasks.groupBy(by) if by else tasks).agg(F.count("*").alias("total"), *[F.count_if(F.col("state") == s).alias(s) for s in states], F.max("attempts").alias("max_attempts"))
