import datetime as dt

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from citespark.operators import audit as M
from citespark.operators import corpus as C
from citespark.operators import ledger as G
from citespark.operators import selectors as L
from citespark.plans import catalog
from citespark.streaming import leases

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(df):
    df = df[sorted(df.columns)].astype(object).where(df[sorted(df.columns)].notna(), None)
    show = lambda v: f"{v:.6g}" if isinstance(v, float) else str(int(v)) if hasattr(v, "item") and not isinstance(v, bool) and str(v).isdigit() else str(v)
    return sorted("|".join(show(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else show(v) for v in row) for row in df.itertuples(index=False))


@pytest.mark.parametrize("name", ["u01_canonical_url", "e07_page_blocks", "l03_verify", "q14_phrase_gap", "z01_search_two_words", "g05_states", "a10_nearest_rank", "v01_snapshot", "m09_violations"])
def test_against_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    assert _plain(catalog.QUERIES[name](spark, sf).toPandas()) == _plain(con.execute(catalog.ORACLE_SQL[name]).df())


def test_selectors(spark):
    df = spark.createDataFrame([("😀 one two one",)], "t string")
    get = lambda c: df.select(c.alias("x")).first().x
    s = get(L.find_selector(F.col("t"), F.lit("one"), 2))
    assert (s.start, s.end, s.exact, s.prefix, s.suffix) == (10, 13, "one", "😀 one two ", None)
    assert get(L.find_selector(F.lit("aaa"), F.lit("aa"), 2)).start == 1
    assert get(L.find_selector(F.col("t"), F.lit("zzz"))) is None and get(L.find_selector(F.col("t"), F.lit(""))) is None
    for a, b in ((3, 3), (4, 2), (0, 99), (-1, 2)):
        assert get(L.make_selector(F.col("t"), F.lit(a), F.lit(b))) is None
    v = lambda t, a, b, q: get(L.verify(t, F.lit(a), F.lit(b), F.lit(q)))
    assert v(F.col("t"), 2, 5, "one") == "ok" and v(F.col("t"), 3, 6, "one") == "quote_mismatch" and v(F.col("t"), 2, 50, "two") == "range_out_of_bounds" and v(F.lit(None).cast("string"), 2, 5, "one") == "xpath_unresolved"


def test_readings(spark):
    r = spark.createDataFrame([("a", 1, 1, "success"), ("a", 2, 2, "failed"), ("a", 3, 2, "partial"), ("b", 1, 1, "failed")], "url_hash string, version int, ingested_at int, status string")
    assert [(x.url_hash, x.version) for x in C.current_readings(r).where("is_current").collect()] == [("a", 3)]
    again = C.merge_readings(C.current_readings(r), r.where("version = 3").withColumn("status", F.lit("failed")))
    assert [(x.url_hash, x.version) for x in again.where("is_current").collect()] == [("a", 1)] and again.count() == 4


def test_ledger(spark):
    t = dt.datetime(2024, 1, 1)
    at = lambda n: t + dt.timedelta(seconds=n)
    events = [(1, 1, at(0), "seed", None), (1, 2, at(5), "claim", "w"), (1, 3, at(9), "heartbeat", "w"), (2, 4, at(0), "claim", "w"), (2, 5, at(1), "fail", "w"), (3, 6, at(0), "claim", "v"), (3, 7, at(2), "finish", "v"), *((4, 10 + i, at(i), k, "w") for i, k in enumerate(("claim", "fail") * 3))]
    s = G.fold_events(spark.createDataFrame(events, "task int, seq int, ts timestamp, kind string, worker string"))
    assert {r.task: (r.state, r.attempts) for r in s.collect()} == {1: ("processing", 1), 2: ("failed", 1), 3: ("done", 1), 4: ("quarantined", 3)}
    assert [r.task for r in G.stale(s, F.lit(at(910))).collect()] == [1] and G.stale(s, F.lit(at(909))).count() == 0
    assert {r.task for r in G.claim_batches(s, 4, 1).collect()} == {2}


def test_audit(spark):
    rows = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (2, 2), (3, 1)], "k int, i int")
    assert {r.k for r in M.contiguity(rows, "k", "i", 0).collect()} == {2, 3}
    a, b = spark.createDataFrame([(1,), (2,), (3,)], "id int"), spark.createDataFrame([(2,), (3,), (4,), (5,)], "id int")
    r = M.compare(a, b, "id").first()
    assert (r.n_both, r.recall, r.precision) == (2, 0.5, 0.666667)


def test_stream_equals_batch(spark, tmp_path):
    rows = pd.DataFrame({"user_id": [1, 1, 1, 2], "ts": pd.to_datetime(["2024-01-01 00:00", "2024-01-01 00:10", "2024-01-01 02:00", "2024-01-01 00:00"]), "event_type": "x"})
    later = pd.DataFrame({"user_id": [9], "ts": pd.to_datetime(["2024-01-03"]), "event_type": "x"})
    for n, part in enumerate((rows, later)):
        spark.createDataFrame(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("user_id long, ts timestamp, event_type string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = leases.lease_sessions(stream).writeStream.format("memory").queryName("sessions").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    got = sorted((r.user_id, r.n) for r in spark.table("sessions").collect())
    want = sorted((r.user_id, r.n) for r in leases.lease_sessions(spark.createDataFrame(rows)).collect())
    assert got == want == [(1, 1), (1, 2), (2, 1)]
