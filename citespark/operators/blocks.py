"""Ordered, addressable blocks from plain texts and from page markup; quality verdicts and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citespark.functions.text import collapse, html_text, is_boilerplate


def text_lines(text: Column) -> Column:
    """The non-empty lines of a text, white space collapsed."""
    return F.filter(F.transform(F.split(text, "\n"), collapse), lambda x: x != "")


def text_blocks(docs: DataFrame) -> DataFrame:
    """A block per non-empty line: article_id, block_index (from 1, contiguous), text. No shuffle: order comes from the array."""
    return docs.select(F.col("doc_id").alias("article_id"), "lang", "source", F.posexplode(text_lines(F.col("text"))).alias("pos", "block_text")).select(
        "article_id", "lang", "source", (F.col("pos") + 1).alias("block_index"), "block_text"
    )


# Tags that are furniture by their role.
FURNITURE_TAGS = ("nav", "header", "footer", "aside", "form", "script", "style", "noscript", "svg", "button")


def strip_furniture(html: Column) -> Column:
    """Markup without comments and furniture elements (not nested in themselves)."""
    out = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?s)<!--.*?-->", "")
    for tag in FURNITURE_TAGS:
        out = F.regexp_replace(out, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "")
    return out


def article_body(html: Column) -> Column:
    """Inside of the article element, furniture stripped."""
    return F.regexp_extract(strip_furniture(html), r"(?is)<article\b[^>]*>(.*?)</article\s*>", 1)


def page_title(html: Column) -> Column:
    return html_text(F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1))


def page_pieces(html: Column) -> Column:
    """The tag and the text of each block of a page's article, in order, as an array."""
    body = F.translate(article_body(html), "\x01\x02\x03", "")
    marked = F.regexp_replace(body, r"(?i)<(p|h[1-6]|blockquote|ul)(?:\s[^>]*)?>", "\x01$1\x03")
    marked = F.regexp_replace(marked, r"(?i)</(?:p|h[1-6]|blockquote|ul)\s*>", "\x02")
    pieces = F.slice(F.split(marked, "\x01"), 2, 1 << 30)  # to the end: a size would cut the markup again
    inside = lambda x: F.split_part(F.split_part(x, F.lit("\x03"), F.lit(2)), F.lit("\x02"), F.lit(1))
    cut = F.transform(pieces, lambda x: F.struct(F.lower(F.split_part(x, F.lit("\x03"), F.lit(1))).alias("tag"), html_text(inside(x)).alias("text")))
    return F.filter(cut, lambda x: x["text"] != "")


def page_blocks(pages: DataFrame) -> DataFrame:
    """Blocks of each page's article: page_id, block_index, block_type, heading_level, block_text, xpath.

    A paragraph or heading runs to the next one's start or its own end (end tags may be missing). A heading's level is 2 at
    least. The XPath numbers a tag only where its parent has several; it is a window over the page's own blocks.
    """
    b = pages.select("page_id", F.posexplode(page_pieces(F.col("html"))).alias("pos", "b")).select("page_id", (F.col("pos") + 1).alias("block_index"), F.col("b.tag").alias("tag"), F.col("b.text").alias("block_text"))
    level = F.greatest(F.substring("tag", 2, 1).try_cast("int"), F.lit(2))
    heading = F.col("tag").rlike("^h[1-6]$")
    name = F.when(heading, F.concat(F.lit("h"), level.cast("string"))).otherwise(F.col("tag"))
    same = Window.partitionBy("page_id", "name")
    place = F.row_number().over(same.orderBy("block_index"))
    number = F.when(F.count("*").over(same) > 1, F.concat(F.lit("["), place.cast("string"), F.lit("]"))).otherwise("")
    kind = F.when(heading, "heading").when(F.col("tag") == "blockquote", "quote").when(F.col("tag") == "ul", "list").otherwise("paragraph")
    return b.withColumn("name", name).select(
        "page_id", "block_index", kind.alias("block_type"), F.when(heading, level).alias("heading_level"), "block_text",
        F.concat(F.lit("/html/body/article/div/"), F.col("name"), number).alias("xpath"),
    )


def link_strip(anchors: Column, linked: Column, total: Column, text: Column) -> Column:
    """A row of links and no prose: two anchors or more, four fifths of the text linked, no sentence end."""
    return (anchors >= 2) & (linked >= 0.8 * total) & ~text.rlike("[.!?…]")


def clean_lines(blocks: DataFrame) -> DataFrame:
    """Per article its lines without furniture and the share of characters that were furniture."""
    flag = is_boilerplate("block_text")
    n = F.length("block_text")
    return blocks.groupBy("article_id").agg(
        F.count_if(flag).alias("boilerplate_lines"), F.count_if(~flag).alias("clean_lines"),
        F.coalesce(F.sum(F.when(~flag, n)), F.lit(0)).alias("clean_chars"),
        F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.sum(F.when(flag, n)), F.lit(0)) / F.sum(n))), 6).alias("boilerplate_ratio"),
    )


def counts(blocks: DataFrame, key: str) -> DataFrame:
    return blocks.groupBy(key).agg(
        F.count("*").alias("n_blocks"), F.sum(F.size(F.split("block_text", " "))).cast("long").alias("n_words"), F.sum(F.length("block_text")).alias("n_chars_total")
    )


def verdict(prose: Column, title: Column, published: Column, warnings: Column) -> tuple[Column, Column]:
    """Quality (invalid without a prose block; partial_valid without title or date or with warnings; else success) and its reason codes."""
    reasons = F.filter(
        F.array(
            F.when(prose == 0, "no_content_blocks"), F.when((prose > 0) & (F.coalesce(title, F.lit("")) == ""), "no_title"),
            F.when((prose > 0) & published.isNull(), "no_published_at"), F.when((prose > 0) & (warnings > 0), "extraction_warnings"),
        ),
        lambda x: x.isNotNull(),
    )
    quality = F.when(prose == 0, "invalid").when(F.size(reasons) > 0, "partial_valid").otherwise("success")
    return quality, reasons
