import pytest
from pyspark.sql import functions as F

from citespark.operators import search as Z
from citespark.plans.query import UnsupportedQuery, compile_query, phrase_edges_survive, search_terms


@pytest.mark.parametrize("query", ["folyó OR hegy", "folyó NOT hegy", "x AND y", "folyó -hegy", "foly*", "tag:folyó", "folyó | hegy"])
def test_refused(query):
    with pytest.raises(UnsupportedQuery):
        compile_query(query)


@pytest.mark.parametrize("query", ["Duna-parti", "Kiss Mária: rövid út", "MI-6", "vízszintmérő", "folyó hegy", "Kiss Mária"])
def test_accepted(query):
    assert compile_query(query).terms


def test_terms():
    assert search_terms(" hegy-völgyi  út ") == ["hegy", "völgyi", "út"]
    assert search_terms("hegy–völgyi") == ["hegy–völgyi"]
    assert len(compile_query("folyó folyó").terms) == 2
    assert compile_query("").rows() == []
    assert all(len(x) > 2 for _, _, _, x, _ in compile_query("Nader").rows())
    assert all(x != "kep" for _, _, _, x, _ in compile_query("kép").rows())
    assert not phrase_edges_survive("folyó hogy") and phrase_edges_survive("folyó hogy árad")


# A document, a query, and whether it answers: split compounds, prefixes from seven letters on, accents that only a query without them forgives.
DOCUMENTS = [
    ("tavaszi duna-parti séta", "duna-parti", True), ("a parti őrség kihajózott", "duna-parti", False), ("vízszintmérő állomás épült", "vízszint", True), ("hegyvidéken esik", "hegy", False),
    ("új kepek lógnak", "kép", False), ("itt egy kep lóg", "kép", False), ("itt egy kép lóg", "kép", True), ("itt egy kép lóg", "kep", True), ("a szel messze jár", "szél", False),
    ("a folyó és a hegy", "folyó hegy", True), ("itt a folyó apad", "folyó hegy", False), ("folyóvizi hegymászók", "folyó hegy", False),
    ("Debrecentől északra havazik", "Debrecentől", True), ("Debrecentől északra havazik", "Debrecentol", True), ("hat madár repül", "hat", True), ("hatvan madár repül", "hat", False),
    ("Nem hogy árad, apad.", "apad", True),
]
# A text, a phrase, and whether it holds it: order, neighbours, accents, stop words inside and at the ends.
PHRASES = [
    ("Kiss Mária megérkezett", "Kiss Mária", True), ("Mária meg a kiss család", "Kiss Mária", False), ("Kiss Mária Győrben lakik", "Mária Kiss", False), ("Kiss Mária Győrben lakik", "Maria", True),
    ("Kiss Maria Gyorben lakik", "Maria", True), ("Kiss Maria Gyorben lakik", "Mária", False), ("a mariachi zenekar játszik", "Maria", False), ("a szel messze jar", "szél", False),
    ("a folyó hogy megáradt", "folyó hogy", True), ("Itt a folyó. Kérdés, hogy árad-e.", "folyó hogy", False), ("mert hogy a folyó árad", "hogy folyó", False),
    ("a folyó hogy árad", "folyó hogy árad", True), ("a partok kozott van", "kozott van", True), ("a partok kozott. Ott van a híd.", "kozott van", False), ("mindig tágas tér", "tagas ter", True),
    ("a duna-parti séta", "séta duna-parti", False), ("Nagy Péter és Kiss Mária", "Kiss Péter", False), ("Kép: MN/Helyi Hírügynökség", "mn/helyi hirugynokseg", True), (None, "Mária", False),
]


def _blocks(spark, texts):
    return spark.createDataFrame([(i, "s", "l", 1, t) for i, t in enumerate(texts)], "article_id long, source string, lang string, block_index int, block_text string")


def test_documents_answer(spark):
    index = Z.postings(Z.vectors(_blocks(spark, [d for d, _, _ in DOCUMENTS]))).cache()
    for query in sorted({q for _, q, _ in DOCUMENTS}):
        plan = compile_query(query)
        found = {r.article_id for r in Z.candidates(Z.term_hits(index, plan), len(plan.terms)).collect()}
        for i, (text, q, want) in enumerate(DOCUMENTS):
            if q == query:
                assert (i in found) is want, (text, q)
    index.unpersist()


def test_phrases(spark):
    df = _blocks(spark, [h for h, _, _ in PHRASES])
    tests = [Z.phrase_match(F.col("block_text"), n).alias(f"c{i}") for i, (_, n, _) in enumerate(PHRASES)]
    rows = {r.article_id: r for r in df.select("article_id", *tests).collect()}
    for i, (hay, needle, want) in enumerate(PHRASES):
        assert rows[i][f"c{i}"] is want, (hay, needle)


def test_score_is_sum_and_totals_agree(spark, sf):
    from citespark.plans import catalog as C

    rows = Z.search_articles(C._index(spark, sf), C._blocks(spark, sf), C._gate(spark, sf), "with from", limit=5).collect()
    ids = C.QUERIES["z02_matching_ids"](spark, sf).count()
    assert rows and all(r.score == r.term_rank + r.accent_rank + r.meta_rank + r.body_rank and r.total_matches == ids for r in rows)
    assert [(-r.score, r.article_id) for r in rows] == sorted((-r.score, r.article_id) for r in rows)
