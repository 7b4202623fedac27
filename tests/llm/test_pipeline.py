"""Stages of the pipeline on planted cases."""

from pyspark.sql import functions as F

import corpus_pipeline
from citespark.llm.langid import held_out

FOREIGN = {
    -1: "Съешь же ещё этих мягких французских булок, да выпей чаю. Широкая электрификация южных губерний даст мощный толчок подъёму сельского хозяйства.",
    -2: "我们今天在北京的图书馆里看了很多书。然后大家一起去吃饭,讨论下周的工作计划。",
    -3: "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    -4: "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
}


def test_language_stage_drops_foreign_documents(spark, sf):
    clean = spark.read.parquet(f"{sf}/documents.parquet")
    foreign = spark.createDataFrame([(i, t, None, "a", len(t)) for i, t in FOREIGN.items()], clean.select("doc_id", "text", "lang", "source", "n_chars").schema)
    # clean documents without a label stay, though nothing is learned from them
    docs = clean.withColumn("lang", F.when(~held_out(), F.col("lang"))).select(*foreign.columns).unionByName(foreign)
    got = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs, sf).select("doc_id").collect()}
    want = {r.doc_id for r in clean.where("regexp_count(text, '[a-zA-Z]') > 0").select("doc_id").collect()}
    assert not got & set(FOREIGN)
    assert got == want


CLASHING = "times int, __id int, __leaks int, __digest string, row int, found int, n int, doc struct<x:int>, `a.b` int"


def _stage_docs(spark, sf):
    """Documents of sf0.001 with nulls, empties, repeated rows, a benchmark passage and columns named like working ones."""
    base = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in base.select("doc_id", "text", "lang", "source", "n_chars").orderBy("doc_id").collect()]
    item = spark.read.parquet(f"{sf}/benchmark.parquet").where("length(text) > 150").orderBy("item_id").first().text
    clean = next(r for r in rows if r[1] and len(r[1]) > 300)
    rows += [(None, clean[1] + " more", clean[2], None, 1), (10**6, None, None, None, None), (10**6 + 1, "", "en", "a", 0), rows[3], rows[3], (10**6 + 2, f"{clean[1][:200]} {item} {clean[1][200:]}", clean[2], "a", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING
    return spark.createDataFrame([(*r, 1, 2, 3, "d", 4, 5, 6, (7,), 8) for r in rows], schema), rows, 10**6 + 2


def test_stages_keep_rows_and_columns(spark, sf):
    docs, rows, leaked = _stage_docs(spark, sf)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert all(tuple(r)[5:] == (1, 2, 3, "d", 4, 5, 6, (7,), 8) for r in got), name
        kept = {(r.doc_id, r.text) for r in got}
        assert kept <= {(r[0], r[1]) for r in rows}, name
        assert stage(spark, docs.limit(0), sf).count() == 0, name
        if name == "decontamination":
            assert (leaked, rows[-1][1]) not in kept and len(got) < len(rows)
        if name == "near_duplicates":
            assert len({r.doc_id for r in got}) == len(got) and sum(not r.text for r in got) <= 1
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert sorted(str(r.doc_id) for r in last) == sorted(str(r[0]) for r in rows)


def test_mixing_stage_repeats_as_taken(spark, sf):
    from collections import Counter

    from citespark.llm.mixing import mix

    docs, rows, _ = _stage_docs(spark, sf)
    unique = docs.dropDuplicates(["doc_id", "text"])
    want = Counter()
    for r in mix(unique).collect():
        if r.taken:
            want[r.doc_id] += -(-r.taken // r.size)
    assert Counter(r.doc_id for r in corpus_pipeline.mix_sources(spark, unique, sf).collect()) == want


def test_run_is_its_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect() or [], stage(spark, docs, sf).schema)
    assert sorted(map(tuple, docs.collect()), key=str) == sorted(map(tuple, corpus_pipeline.run(spark, sf).collect()), key=str)
