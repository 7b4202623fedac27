"""Steps that must grow no faster than their input: what they shuffle, write or hold, and equal results on odd rows."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from citespark.functions.text import is_boilerplate
from citespark.operators import extraction as X
from citespark.operators import search as Z
from citespark.operators import selectors as L
from citespark.plans import catalog
from tests.test_engine import TABLES, _plain

ODD_DOCUMENTS = [
    (1, "Für with this und\nwith this from thanedble\nfurs fur für für", "en", "src1"), (1, "with this again running runs\nthanedbles from", "en", "src1"), (2, None, "en", "src1"), (3, "", None, None),
    (None, "with this of nobody unheardofword", "fr", "src2"), (None, "fur another unheardofword", "fr", "src2"), (4, "\n \nStatements statement furry\nthintions thintion the with", "fr", "src2"),
    (5, "THIS with\x00 this​x\n" + "over " * 50 + "thintion Überfür", "de", "src3"), (6, "[a]\U0001f600-\U0001f600 \\Q aloneword walking alonewords\ntail", "de", "src3"),
]
ODD_PAGES = [
    (7_000_001, "https://h.example/a", "<html><article><p>One word two word</p><p>one <b>more</b></p><h1>--</h1><p>two</p></article>tail</html>"), (7_000_001, "https://h.example/a", "<article><p>other words here</p></article>"),
    (7_000_002, "https://h.example/b", None), (7_000_003, "https://h.example/c", "<article><p>split<!-- no -->ted wo<br>rd</p><ul>a b c</ul></article>"), (None, "https://h.example/d", "<article><p>nobody's page</p></article>"), (7_000_004, "", ""),
]
ODD_NEEDLES = [(9_000_001, "fur"), (9_000_002, "h\nTHIS with"), (9_000_003, "\U0001f600"), (9_000_004, "[a"), (9_000_005, "of nobody"), (9_000_006, "with this again")]


@pytest.fixture(scope="session")
def odd(spark, sf, tmp_path_factory):
    d = tmp_path_factory.mktemp("odd")
    for t in TABLES:
        spark.read.parquet(f"{sf}/{t}.parquet").write.parquet(f"{d}/{t}.parquet")
    rows = spark.createDataFrame(ODD_DOCUMENTS, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text"))
    pages = spark.createDataFrame(ODD_PAGES, "page_id long, url string, html string")
    pages.write.mode("append").parquet(f"{d}/pages.parquet")
    spark.createDataFrame(ODD_NEEDLES, "item_id long, text string").write.mode("append").parquet(f"{d}/benchmark.parquet")
    kind = dict(spark.read.parquet(f"{sf}/documents.parquet").dtypes)
    rows.select(*[F.col(c).cast(t) for c, t in kind.items()]).write.mode("append").parquet(f"{d}/documents.parquet")
    return str(d)


def against_sql(spark, d, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{d}/{t}.parquet/*.parquet'")
    assert _plain(catalog.QUERIES[name](spark, d).toPandas()) == _plain(con.execute(catalog.ORACLE_SQL[name]).df())


def exchanged(df) -> str:
    """The shuffles of a plan, with their keys."""
    return "\n".join(x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in x)


SEARCHES = ["q06_folded_term", "q06_accented_term", "q05_prefix_term", "q09_hyphen_terms", "q10_all_terms", "t01_union_hits", "t03_intersect_except", "a01_document_and", "a02_ranks", "z01_search_accented", "z01_search_phrase", "z01_search_filtered", "z02_matching_ids", "z03_search_blocks", "z05_passages_per_term", "m05_recall_precision", "m10_misses"]


@pytest.mark.parametrize("name", [*SEARCHES, "q02_postings", "a11_document_frequency", "m12_prose_only_words", "q14_phrase", "q14_phrase_gap", "q14_phrase_accent", "q14_phrase_one"])
def test_odd_documents(spark, odd, name):
    against_sql(spark, odd, name)


def test_index_holds_what_is_asked(spark, odd):
    whole = catalog._index(spark, odd)
    for query in ("fur", "für", "thintion", "with this", "statements"):
        wanted = [(x, p) for *_, x, p in catalog.compile_query(query).rows()]
        rows = lambda t: sorted(map(str, t.select(*whole.columns).collect()))
        assert rows(catalog._index(spark, odd, query)) == rows(whole.where(Z.holds(F.col("lexeme"), wanted))) != []


def test_wanted_and_rowwise_postings(spark):
    texts = ["İstanbul's ΑΣ\ufeffΑ ας İSTANBULS", "Ős ős os őrs", "runnings running run runs", "the THE a", "", None]
    v = Z.vectors(spark.createDataFrame([(i, 1 + i % 2, t) for i, t in enumerate(texts)], "article_id long, block_index int, block_text string"))
    rows = lambda t: sorted(map(str, t.collect()))
    assert rows(Z.postings_of_rows(v)) == rows(Z.postings(v)) != []
    for query in ("İstanbul", "ας", "ος", "os", "ős", "running runs", "the"):
        wanted = [(x, p) for *_, x, p in catalog.compile_query(query).rows()]
        assert rows(Z.postings(v, wanted)) == rows(Z.postings(v).where(Z.holds(F.col("lexeme"), wanted)))


def test_counts_by_lexeme_shuffle_no_postings(spark, sf):
    assert exchanged(catalog.QUERIES["q02_postings"](spark, sf)) == ""
    for name in ("a11_document_frequency", "m12_prose_only_words"):
        found = exchanged(catalog.QUERIES[name](spark, sf))
        assert "hashpartitioning(lexeme" in found and "article_id" not in found


@pytest.mark.parametrize("name", ["e09_boilerplate_lines", "e10_clean_lines", "l02_find_quotes", "l03_verify", "l04_slices", "l05_passage", "l07_repair", "l09_citation_audit", "m01_fidelity", "m06_probe_words"])
def test_odd_rows(spark, odd, name):
    against_sql(spark, odd, name)


def test_fidelity_shuffles_no_words(spark, sf):
    found = exchanged(catalog.QUERIES["m01_fidelity"](spark, sf))
    assert "page_id" in found and "word" not in found.replace("n_words", "")


def test_probe_words_shuffle_no_articles(spark, sf):
    found = exchanged(catalog.QUERIES["m06_probe_words"](spark, sf))
    assert "folded" in found and "article_id" not in found


def test_boilerplate_filter_folds_a_line_once(spark):
    plan = spark.range(1).select(F.col("id").cast("string").alias("x")).where(is_boilerplate("x"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("translate(") == 1


def test_short_quotes_tell_few_grams(spark):
    """Only grams of letters that short needles have there become keys."""
    blocks = spark.createDataFrame([(1, 1, "abcdefghij " * 50 + "x[.z"), (2, 1, None)], "article_id long, block_index int, block_text string")
    needles = spark.createDataFrame([(1, "[.z"), (2, "zz zz")], "item_id long, needle string")
    found = L.locate_quotes(blocks, needles)
    assert [(r.article_id, r.item_id, r.start) for r in found.collect()] == [(1, 1, 551)]
    assert ".{" not in found._jdf.queryExecution().executedPlan().toString()


def test_a_worker_holds_few_articles(spark):
    """A batch of many pages comes out in pieces (an Arrow batch may be 10,000 pages)."""
    page = "<html><article>" + "<p>word</p>" * 1000 + "</article></html>"
    pieces = X.extract_frames(iter([pd.DataFrame({"page_id": range(300), "url": "https://h.example/", "html": page})]))
    rows = [len(p) for p in pieces]
    assert sum(rows) == 300 and max(rows) * len(page) <= X.HELD + len(page)
