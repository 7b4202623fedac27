"""Extraction of captures as an Arrow-batched map: a nested row per page, exploded into tables by the callers."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citespark.functions import html as H

ARTICLE = (
    "page_id long, title string, description string, published_at string, updated_at string, authors array<string>, publisher string, tags array<string>, "
    "language string, section string, quality string, reasons array<string>, "
    "blocks array<struct<index:int,type:string,level:int,text:string,xpath:string>>, images array<struct<url:string,caption:string>>, videos array<string>, "
    "links array<struct<url:string,text:string,internal:boolean>>"
)


#: Characters of markup whose articles a worker holds at once: an Arrow batch may be 10,000 pages, and articles take many times their text.
HELD = 1 << 20


def extract_frames(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in ARTICLE.split(", ")]
    for frame in frames:
        rows, held = [], 0
        for page_id, url, markup in zip(frame.page_id, frame.url, frame.html):
            x = H.extract(markup, url or "")
            x["blocks"] = [{"index": b["index"], "type": b["type"], "level": b.get("level"), "text": b["text"], "xpath": b["xpath"]} for b in x["blocks"]]
            rows.append({"page_id": page_id, **{k: v for k, v in x.items() if k != "warnings"}})
            held += len(markup or "")
            if held >= HELD:
                yield pd.DataFrame(rows, columns=columns)
                rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=columns)


def extract_pages(pages: DataFrame) -> DataFrame:
    """An article for each (page_id, url, html)."""
    return pages.select("page_id", "url", "html").mapInPandas(extract_frames, ARTICLE)


def blocks_table(articles: DataFrame) -> DataFrame:
    return articles.select("page_id", F.explode("blocks").alias("b")).select("page_id", F.col("b.index").alias("block_index"), F.col("b.type").alias("block_type"), F.col("b.level").alias("heading_level"), F.col("b.text").alias("block_text"), F.col("b.xpath").alias("xpath"))


def links_table(articles: DataFrame) -> DataFrame:
    return articles.select("page_id", F.explode("links").alias("l")).select("page_id", "l.*")


def attribute_payloads(videos: DataFrame, payloads: DataFrame) -> DataFrame:
    """Captured video bytes to the embeds they belong to: by (platform, external_id), else to the page's only embed of the platform.

    videos: (page_id, platform, external_id, url); payloads: (page_id, platform, external_id or null, payload). Unplaced ones have a null url.
    """
    only = videos.groupBy("page_id", "platform").agg(F.count("*").alias("n"), F.min("url").alias("only_url")).where("n = 1").drop("n")
    by_id = payloads.join(videos, ["page_id", "platform", "external_id"], "left")
    out = by_id.join(only, ["page_id", "platform"], "left")
    return out.select("page_id", "platform", "external_id", "payload", F.coalesce("url", F.when(F.col("external_id").isNull(), F.col("only_url"))).alias("url"))
