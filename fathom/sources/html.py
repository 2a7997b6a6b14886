"""HTML pages to evidence rows, in document order."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathom.session import ship_package

from fathom.functions import text as t

SCHEMA = "page_id long, item int, level int, tag string, text string"
BLOCKS = frozenset("p li td th h1 h2 h3 h4 h5 h6 caption figcaption blockquote pre dt dd title".split())
SKIPPED = frozenset("script style noscript template".split())
MOST_EXCERPT = 500


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.items: list[tuple[int, str, str]] = []
        self.open: list[list] = []
        self.depth = self.skipping = 0

    def handle_starttag(self, tag, attrs):
        if tag in SKIPPED:
            self.skipping += 1
        self.depth += 1
        if tag in BLOCKS:
            self.open.append([self.depth, tag, []])
        elif tag == "br" and self.open:
            self.open[-1][2].append("\n")

    def handle_endtag(self, tag):
        if tag in SKIPPED and self.skipping:
            self.skipping -= 1
        if tag in BLOCKS and any(o[1] == tag for o in self.open):
            while self.open:
                level, name, parts = self.open.pop()
                text = " ".join("".join(parts).split())
                if text:
                    self.items.append((level, name, text))
                if name == tag:
                    break
        self.depth = max(0, self.depth - 1)

    def handle_data(self, data):
        if self.skipping:
            return
        if self.open:
            self.open[-1][2].append(data)
        elif data.strip():
            self.items.append((self.depth, "text", " ".join(data.split())))


def read_items(html: str) -> list[tuple[int, str, str]]:
    """(level, tag, text) of a page's text blocks."""
    reader = _Reader()
    reader.feed(html)
    reader.close()
    while reader.open:
        level, name, parts = reader.open.pop()
        text = " ".join("".join(parts).split())
        if text:
            reader.items.append((level, name, text))
    return reader.items


def html_items(pages: DataFrame) -> DataFrame:
    """(page_id, item, level, tag, text) of pages (page_id, html)."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(page, i, level, tag, text) for page, html in zip(frame["page_id"], frame["html"], strict=True)
                    for i, (level, tag, text) in enumerate(read_items(html or ""))]
            yield pd.DataFrame(rows, columns=["page_id", "item", "level", "tag", "text"])

    ship_package(pages.sparkSession)
    return pages.select("page_id", "html").mapInPandas(parse, SCHEMA)


def evidence(items: DataFrame) -> DataFrame:
    """Items with an excerpt of at most 500 characters."""
    return items.withColumn("excerpt", F.substring("text", 1, MOST_EXCERPT))


def markdown(items: DataFrame) -> DataFrame:
    """(page_id, markdown) of a page's items."""
    heading = F.col("tag").rlike("^h[1-6]$")
    line = (F.when(heading, F.concat(F.expr("repeat('#', CASE WHEN tag RLIKE '^h[1-6]$' THEN cast(substring(tag, 2, 1) AS int) ELSE 0 END)"), F.lit(" "), t.escape_inline(F.col("text"))))
            .when(F.col("tag") == "li", F.concat(F.lit("- "), t.escape_inline(F.col("text")))).otherwise(t.escape_inline(F.col("text"))))
    return items.groupBy("page_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(
        F.struct("item", line.alias("line")))), lambda x: x["line"]), "\n\n").alias("markdown"))


def without_generated(items: DataFrame) -> DataFrame:
    """Items without those labelled as AI generated and the item right after each."""
    w = Window.partitionBy("page_id").orderBy("item")
    label = F.lower("text").rlike(r"^\W*(ai[ -]generated|generated by ai)\W*$")
    m = items.withColumn("_label", label)
    follows = F.coalesce(F.lag("_label").over(w), F.lit(False)) & (F.lag("item").over(w) == F.col("item") - 1) & (
        (F.col("level") - F.lag("level").over(w)).isin(0, 1))
    return m.withColumn("_follows", F.coalesce(follows, F.lit(False))).where("NOT _label AND NOT _follows").drop("_label", "_follows")
