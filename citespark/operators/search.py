"""Document-level search over an inverted index: candidates, gate, filters, phrase check, rank, page, passages."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citespark.functions.analyze import fold_word, lexemes_col, lexemes_of, stem_col
from citespark.functions.text import fold, tokens
from citespark.operators.selectors import make_selector
from citespark.plans.query import Plan, compile_query, lemma_lexemes, phrase_patterns

#: Weights of the vector classes A to D; title is A, section and outlet B, body and captions D.
WEIGHTS = {"A": 10, "B": 4, "C": 2, "D": 1}


def vectors(blocks: DataFrame) -> DataFrame:
    """Texts to index: (article_id, vec_kind, vec_id, weight, vec_text), in one pass. The first block is the title as well (metadata, class A)."""
    vec = lambda kind, at, weight: F.struct(F.lit(kind).alias("vec_kind"), at.alias("vec_id"), F.lit(weight).alias("weight"))
    body, title = vec("b", F.col("block_index"), WEIGHTS["D"]), vec("m", F.lit(0), WEIGHTS["A"])
    both = F.when(F.col("block_index") == 1, F.array(body, title)).otherwise(F.array(body))
    return blocks.select("article_id", F.explode(both).alias("v"), F.col("block_text").alias("vec_text")).select("article_id", "v.*", "vec_text")


def holds(lexeme: Column, wanted: Iterable[tuple[str, bool]]) -> Column:
    """Whether a lexeme is one of `wanted`: (text, matches as prefix)."""
    return _any_of([lexeme.startswith(x) if prefix else lexeme == x for x, prefix in wanted])


def postings(texts: DataFrame, wanted: Iterable[tuple[str, bool]] | None = None) -> DataFrame:
    """(article_id, vec_kind, vec_id, weight, lexeme, tf) of (article_id, vec_kind, vec_id, weight, vec_text). Write it sorted by lexeme to prune scans.

    With `wanted`, (lexeme, matches as prefix), only the postings of these, and only they are shuffled: a lexeme's folded form begins the
    folded token, and so stands in the folded text; other texts and tokens go before lexemes are made.
    """
    starts = None if wanted is None else sorted({fold_word(x) for x, _ in wanted})
    if starts is not None:
        texts = texts.where(_any_of([fold("vec_text").contains(x) for x in starts]))
    t = texts.select("article_id", "vec_kind", "vec_id", "weight", F.explode(tokens("vec_text")).alias("token"))
    if starts is not None:
        t = t.where(_any_of([fold("token").startswith(x) for x in starts]))
    x = t.select("article_id", "vec_kind", "vec_id", "weight", F.explode(lexemes_col(F.col("token"))).alias("lexeme"))
    if starts is not None:
        x = x.where(holds(F.col("lexeme"), wanted))
    return x.groupBy("article_id", "vec_kind", "vec_id", "weight", "lexeme").agg(F.count("*").alias("tf"))


def postings_of_rows(texts: DataFrame) -> DataFrame:
    """`postings` of texts whose (article_id, vec_kind, vec_id) are unique: counted in the row, as runs of its sorted lexemes, without a shuffle."""
    lexemes = F.array_sort(lexemes_of(tokens("vec_text")))
    starts = F.filter(F.transform("all", lambda x, i: F.when((i == 0) | (x != F.get("all", i - 1)), i)), lambda i: i.isNotNull())
    run = lambda at, k: F.struct(F.get("all", at).alias("lexeme"), (F.coalesce(F.get("at", k + 1), F.size("all")) - at).cast("long").alias("tf"))
    vec = ("article_id", "vec_kind", "vec_id", "weight")
    return texts.select(*vec, lexemes.alias("all")).select(*vec, "all", starts.alias("at")).select(*vec, F.explode(F.transform("at", run)).alias("p")).select(*vec, "p.*")


def token_frequency(articles: DataFrame, least: int = 1) -> DataFrame:
    """(token, n, ndoc) of tokens of `least` letters or more: places, and articles that hold one, of `articles` as in document_frequency.

    An article's sorted tokens tell the first of each; only sums by token are shuffled.
    """
    every = F.array_sort(F.filter(F.flatten(F.transform("lines", tokens)), lambda t: F.length(t) >= least))
    first = lambda x, i: F.when(F.col("article_id").isNotNull() & ((i == 0) | (x != F.get("all", i - 1))), 1).otherwise(0)
    told = F.transform("all", lambda x, i: F.struct(x.alias("token"), first(x, i).alias("first")))
    rows = articles.select("article_id", every.alias("all")).select(F.explode(told).alias("t")).select("t.*")
    return rows.groupBy("token").agg(F.count("*").alias("n"), F.sum("first").alias("ndoc"))


def document_frequency(texts: DataFrame, articles: DataFrame) -> DataFrame:
    """(lexeme, ndoc, nentry): the articles that hold a lexeme and its places in all `texts` (vectors).

    `articles` is (article_id, lines), each article once. Only sums by token and by lexeme are shuffled: places are counted by token before
    lexemes are made, and an article tells each of its lexemes once.
    """
    n = texts.select(F.explode(tokens("vec_text")).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    entries = n.select(F.explode(lexemes_col(F.col("token"))).alias("lexeme"), F.lit(0).cast("long").alias("ndoc"), F.col("n").alias("nentry"))
    words = F.array_distinct(F.flatten(F.transform("lines", tokens)))
    held = articles.where("article_id is not null").select(F.explode(F.array_distinct(lexemes_of(words))).alias("lexeme")).groupBy("lexeme").agg(F.count("*").alias("ndoc"))
    both = entries.unionByName(held.select("lexeme", "ndoc", F.lit(0).cast("long").alias("nentry")))
    return both.groupBy("lexeme").agg(F.sum("ndoc").alias("ndoc"), F.sum("nentry").alias("nentry"))


def lexeme_spread(texts: DataFrame, least: int = 1) -> DataFrame:
    """(lexeme, first, last, n_title) of lexemes of `least` letters or more: smallest and largest article that hold one, and its title places. One article holds it if they are equal."""
    title = F.when(F.col("vec_kind") == "m", 1).otherwise(0)
    t = texts.select("article_id", title.alias("title"), F.explode(tokens("vec_text")).alias("token")).where(F.length("token") >= least)  # a lexeme is no longer than its token
    spread = lambda x, first, last, n, by: x.groupBy(by).agg(F.min(first).alias("first"), F.max(last).alias("last"), F.sum(n).alias("n_title"))
    x = spread(t, "article_id", "article_id", "title", "token").select(F.explode(lexemes_col(F.col("token"))).alias("lexeme"), "first", "last", "n_title")
    return spread(x.where(F.length("lexeme") >= least), "first", "last", "n_title", "lexeme")


def _any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def write_index(index: DataFrame, path: str) -> None:
    """Sorted by lexeme, in ranges of it, and in row groups small enough to skip."""
    index.repartitionByRange("lexeme", "article_id").sortWithinPartitions("lexeme", "article_id").write.option("parquet.block.size", 4 << 20).parquet(path)


def lexeme_hits(index: DataFrame, plan: Plan) -> DataFrame:
    """Index rows that a plan's lexemes match, with (ord, side, n_lex, which): a filter that reaches the scan, no join."""
    rows = plan.rows()
    if not rows:
        return index.where(F.lit(False)).select("*", *[F.lit(0).alias(c) for c in ("ord", "side", "n_lex", "which")])
    test = [holds(F.col("lexeme"), [(x, p)]) for _, _, _, x, p in rows]
    marks = F.array(*[F.when(t, F.struct(F.lit(o).alias("ord"), F.lit(s).alias("side"), F.lit(n).alias("n_lex"), F.lit(i).alias("which"))) for i, (t, (o, s, n, _, _)) in enumerate(zip(test, rows))])
    return index.where(_any_of(test)).select("*", F.explode(F.array_compact(marks)).alias("m")).select(*index.columns, "m.*")


def term_hits(index: DataFrame, plan: Plan) -> DataFrame:
    """(article_id, vec_kind, vec_id, ord, rank): vectors in which a side of the term matches whole, with rank = sum of weight * tf."""
    hits = lexeme_hits(index, plan).where("article_id is not null")
    full = hits.groupBy("article_id", "vec_kind", "vec_id", "ord", "side", "n_lex").agg(F.count_distinct("which").alias("n"), F.collect_set(F.struct("lexeme", (F.col("weight") * F.col("tf")).alias("r"))).alias("lex")).where("n = n_lex")
    whole = full.groupBy("article_id", "vec_kind", "vec_id", "ord").agg(F.array_distinct(F.flatten(F.collect_list("lex"))).alias("lex"))
    return whole.select("article_id", "vec_kind", "vec_id", "ord", F.aggregate("lex", F.lit(0).cast("long"), lambda a, x: a + x["r"]).alias("rank"))


def candidates(hits: DataFrame, n_terms: int) -> DataFrame:
    """Articles in which every term has a hit, in whatever vectors."""
    mask = hits.groupBy("article_id").agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("ord"))).alias("mask"))
    return mask.where(F.col("mask") == (1 << n_terms) - 1).select("article_id")


def gate(blocks: DataFrame, labels: DataFrame) -> DataFrame:
    """Searchable articles: a prose block, and not of quality 0 (no label means unknown, which passes)."""
    bad = labels.where("quality = 0").select(F.col("doc_id").alias("article_id"))
    return blocks.select("article_id", "source", "lang").distinct().join(bad, "article_id", "left_anti")


def ranks(hits: DataFrame, plan: Plan) -> DataFrame:
    """Per article: term_rank, accent_rank, bonus, and the parts that tell why it matched."""
    n = len(plan.terms)
    accented = [t.ord for t in plan.terms if t.accented]
    by_term = hits.groupBy("article_id", "ord").agg(
        F.max(F.when(F.col("vec_kind") == "m", F.col("rank"))).alias("m"), F.max(F.when(F.col("vec_kind") == "b", F.col("rank"))).alias("b")
    )
    zero = lambda x: F.coalesce(x, F.lit(0).cast("long"))
    terms = by_term.groupBy("article_id").agg(
        F.sum(zero(F.col("m")) + zero(F.col("b"))).alias("term_rank"),
        F.sum(F.when(F.col("ord").isin(accented), zero(F.col("m"))).otherwise(F.lit(0).cast("long"))).alias("accent_rank") if accented else F.lit(0).cast("long").alias("accent_rank"),
    )
    by_vec = hits.groupBy("article_id", "vec_kind", "vec_id").agg(F.count("*").alias("terms"), F.sum("rank").alias("rank")).where(F.col("terms") == n)
    whole = by_vec.groupBy("article_id").agg(
        F.max(F.when(F.col("vec_kind") == "m", F.col("rank"))).alias("meta_rank"), F.max(F.when(F.col("vec_kind") == "b", F.col("rank"))).alias("body_rank")
    )
    out = terms.join(whole, "article_id", "left").select("article_id", "term_rank", "accent_rank", zero(F.col("meta_rank")).alias("meta_rank"), zero(F.col("body_rank")).alias("body_rank"))
    reason = F.when((F.col("meta_rank") > 0) & (F.col("body_rank") > 0), "both").when(F.col("meta_rank") > 0, "metadata").when(F.col("body_rank") > 0, "body").otherwise("document")
    return out.withColumn("score", F.col("term_rank") + F.col("accent_rank") + F.col("meta_rank") + F.col("body_rank")).withColumn("match_reason", reason)


def phrase_match(text: Column, needle: str) -> Column:
    """Whether the words of `needle` stand in `text` in order and adjacent, by any branch in force; null text matches nothing."""
    words = tokens(text)
    folded = fold(text)
    forms = {
        "simple": lambda: F.array_join(words, " "), "folded": lambda: F.array_join(F.transform(words, fold), " "),
        "lemma": lambda: F.array_join(F.transform(words, lambda w: fold(stem_col(w))), " "), "accented_lemma": lambda: F.array_join(F.transform(words, stem_col), " "),
    }
    out = F.lit(False)
    for branch, pattern in phrase_patterns(needle).items():
        out = out | forms[branch]().rlike(pattern)
    for x in lemma_lexemes(needle):  # each begins a folded word in every branch: other texts are told without their words
        out = folded.contains(x) & out
    return F.coalesce(out, F.lit(False))


def matching_ids(index: DataFrame, query: str, searchable: DataFrame, where: Column | str | None = None) -> DataFrame:
    """All articles that answer the query under the gate and the filters, unlimited."""
    plan = compile_query(query)
    found = candidates(term_hits(index, plan), len(plan.terms)) if plan.terms else index.select("article_id").where(F.lit(False))
    passed = searchable if where is None else searchable.where(where)
    return found.join(passed.select("article_id"), "article_id", "left_semi")


def search_articles(
    index: DataFrame, blocks: DataFrame, searchable: DataFrame, query: str, limit: int | None = 10, offset: int = 0,
    where: Column | str | None = None, phrase: str | None = None, blocks_per_article: int = 1,
) -> DataFrame:
    """A page of articles: score parts, match reason, total, and the best passages joined as one string.

    Ids and scores are settled first; display columns and passages join the page only.
    """
    plan = compile_query(query)
    hits = term_hits(index, plan)
    ids = matching_ids(index, query, searchable, where)
    if phrase:
        held = blocks.where(phrase_match(F.col("block_text"), phrase)).select("article_id")
        ids = ids.join(held, "article_id", "left_semi")
    ranked = ranks(hits, plan).join(ids, "article_id", "left_semi")
    total = ids.agg(F.count("*").alias("total_matches"))
    page = ranked.orderBy(F.desc("score"), "article_id")
    if offset:
        page = page.offset(offset)
    if limit is not None:
        page = page.limit(limit)
    best = best_blocks(hits, len(plan.terms), blocks_per_article).join(page.select("article_id"), "article_id", "left_semi")
    shown = best.groupBy("article_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "vec_id"))), lambda x: x["vec_id"].cast("string")), ",").alias("passages"))
    return (
        page.join(shown, "article_id", "left").join(searchable.select("article_id", "source", "lang"), "article_id").crossJoin(F.broadcast(total))  # one row
        .select("article_id", "source", "lang", "term_rank", "accent_rank", "meta_rank", "body_rank", "score", "match_reason", F.coalesce("passages", F.lit("")).alias("passages"), "total_matches")
    )


def best_blocks(hits: DataFrame, n_terms: int, k: int) -> DataFrame:
    """The k best blocks per article that hold all terms: (article_id, place, vec_id, rank)."""
    whole = hits.where("vec_kind = 'b'").groupBy("article_id", "vec_id").agg(F.count("*").alias("terms"), F.sum("rank").alias("rank")).where(F.col("terms") == n_terms)
    place = F.row_number().over(Window.partitionBy("article_id").orderBy(F.desc("rank"), "vec_id"))
    return whole.withColumn("place", place).where(F.col("place") <= k).select("article_id", "place", "vec_id", "rank")


def best_blocks_per_term(hits: DataFrame) -> DataFrame:
    """The best block of each term, once each, in the order of terms."""
    place = F.row_number().over(Window.partitionBy("article_id", "ord").orderBy(F.desc("rank"), "vec_id"))
    first = hits.where("vec_kind = 'b'").withColumn("place", place).where("place = 1")
    return first.groupBy("article_id", "vec_id").agg(F.min("ord").alias("ord"), F.max("rank").alias("rank"))


def search_blocks(index: DataFrame, blocks: DataFrame, searchable: DataFrame, query: str) -> DataFrame:
    """Blocks that hold all terms, best first: rank, then article and block order."""
    plan = compile_query(query)
    hits = term_hits(index.where("vec_kind = 'b'"), plan)
    whole = hits.groupBy("article_id", "vec_id").agg(F.count("*").alias("terms"), F.sum("rank").alias("rank")).where(F.col("terms") == len(plan.terms))
    rows = whole.join(searchable.select("article_id"), "article_id", "left_semi").select("article_id", F.col("vec_id").alias("block_index"), "rank")
    return rows.join(blocks.select("article_id", "block_index", "block_text"), ["article_id", "block_index"])


def cite(rows: DataFrame, query: str) -> DataFrame:
    """A selector for the span to show of (article_id, block_index, block_text): the whole query, else the longest term of three letters or more."""
    plan = compile_query(query)
    tries = [query.strip()] + sorted((t.raw for t in plan.terms if len(t.raw) >= 3), key=lambda x: (-len(x), x))[:1]
    low = F.lower("block_text")
    at, n = F.lit(0), F.lit(0)
    for t in reversed(tries):
        here = F.instr(low, t.lower())
        at, n = F.when(here > 0, here).otherwise(at), F.when(here > 0, F.lit(len(t))).otherwise(n)
    s = make_selector(F.col("block_text"), at - 1, at - 1 + n)
    return rows.select("article_id", "block_index", s.alias("s")).select("article_id", "block_index", F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.col("s.exact").alias("exact"))


def headline(text: Column, query: str, before: int = 5, most: int = 22) -> Column:
    """A window of words around the first hit, hits marked « »."""
    plan = compile_query(query)
    words = F.split(text, " ")
    keys = [x for _, _, _, x, _ in plan.rows()]
    hit = lambda w: F.exists(F.transform(tokens(w), lambda t: F.array_contains(F.array(*[F.lit(k) for k in keys]), fold(t)) | F.array_contains(F.array(*[F.lit(k) for k in keys]), fold(stem_col(t)))), lambda b: b)
    first = F.coalesce(F.array_min(F.filter(F.transform(words, lambda w, i: F.when(hit(w), i)), lambda i: i.isNotNull())), F.lit(0))
    start = F.greatest(first - before, F.lit(0))
    return F.array_join(F.transform(F.slice(words, start + 1, F.lit(most)), lambda w: F.when(hit(w), F.concat(F.lit("«"), w, F.lit("»"))).otherwise(w)), " ")
