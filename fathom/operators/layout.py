"""From positioned characters to lines, regions, columns and reading order.

``atoms``: doc, page, region, ordinal, kind (character, space, line_break), text, box. Every step
partitions by doc or finer, so one exchange on doc carries the whole chain and no
document meets another.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.session import ship_package

from fathom.functions import geometry as g
from fathom.operators.sequences import islands, successor_edges

# Thresholds of the layout rules.
GAP_WIDTHS = 6.0
LINE_GAP = 1.75
COLUMN_OVERLAP = 0.20
EDGE_BAND = 0.10
REPEAT_RATIO = 0.60
SPACE_WIDTH = 0.60
ANCHOR_GAP = 0.04


def line_islands(atoms: DataFrame) -> DataFrame:
    """Adds ``line``: the chunk of its region each atom belongs to.

    A chunk ends after a line break, where the baseline of the last visible character in
    it is left, or at a gap of six median character widths. Chunks without extent join
    the chunk before them, leading ones the one after.
    """
    keys, order = ["doc", "region"], ["ordinal"]
    w = Window.partitionBy(*keys).orderBy(*order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    # All windows follow one order or none, so two sorts carry them; each repeats every character.
    width = F.when((F.col("kind") == "character") & (g.width(F.col("box")) > 0), g.width(F.col("box")))
    visible = (F.col("kind") == "character") & F.col("box").isNotNull()
    # The last visible box since the last line break: a break stands in the way of what is before it.
    mark = F.when(F.col("kind") == "line_break", F.struct(F.lit(0).alias("seen"), F.col("box").alias("box"))).when(
        visible, F.struct(F.lit(1).alias("seen"), F.col("box").alias("box")))
    a = atoms.withColumn("_mark", F.last(mark, ignorenulls=True).over(before)).withColumn("_after", F.lag("kind").over(w))
    a = a.withColumn("_typical", F.coalesce(F.median(width).over(whole), F.lit(0.0)))
    a = a.withColumn("_last", F.when(F.col("_mark.seen") == 1, F.col("_mark.box"))).drop("_mark")
    after_break = F.coalesce(F.col("_after") == "line_break", F.lit(False))
    jump = ((F.col("_typical") > 0) & F.col("box").isNotNull()
            & (F.col("box.left") - F.col("_last.right") > F.col("_typical") * GAP_WIDTHS))
    leaves = F.col("_last").isNotNull() & (F.col("kind") != "line_break") & (~g.same_baseline(F.col("_last"), F.col("box")) | jump)
    a = a.withColumn("_opens_line", after_break | F.coalesce(leaves, F.lit(False))).drop("_last", "_typical", "_after")
    a = islands(a, keys, order, F.col("_opens_line"), "_chunk").drop("_opens_line")
    solid = F.when((g.width(F.col("box")) > 0) & (g.height(F.col("box")) > 0), F.col("_chunk"))
    # The last chunk with extent up to an atom's own, or else the first one of all.
    upto = Window.partitionBy(*keys).orderBy("_chunk").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return a.withColumn("line", F.coalesce(F.max(solid).over(upto), F.min(solid).over(whole))).drop("_chunk")


def lines(atoms: DataFrame) -> DataFrame:
    """(doc, page, region, line, box, baseline, height, text, first, last) of every line."""
    a = line_islands(atoms).where("line IS NOT NULL")
    tall = F.when(g.height(F.col("box")) > 0, g.height(F.col("box")))
    out = a.groupBy("doc", "page", "region", "line").agg(
        g.union(F.col("box")).alias("box"), F.median(F.col("box.bottom")).alias("baseline"), F.median(tall).alias("height"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "text"))), lambda x: x["text"]), "").alias("text"),
        F.min("ordinal").alias("first"), F.max("ordinal").alias("last"))
    return out.where("height IS NOT NULL")


def line_text(atoms: DataFrame) -> DataFrame:
    """(doc, text): all visible characters of a document in order."""
    return atoms.where("kind = 'character'").groupBy("doc").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("ordinal", "text"))), lambda x: x["text"]), "").alias("text"))


def _columns_of_page(page: pd.DataFrame) -> pd.DataFrame:
    """Greedy columns: a line joins the first column it overlaps by a fifth, which grows."""
    page = page.sort_values(["left", "top", "first"], ascending=[True, False, True])
    spans: list[list[float]] = []
    chosen = []
    for left, right in zip(page["left"], page["right"], strict=True):
        for i, s in enumerate(spans):
            least = min(right - left, s[1] - s[0])
            if least > 0 and (min(right, s[1]) - max(left, s[0])) / least >= COLUMN_OVERLAP:
                s[0], s[1] = min(s[0], left), max(s[1], right)
                chosen.append(i)
                break
        else:
            chosen.append(len(spans))
            spans.append([left, right])
    place = {old: new for new, old in enumerate(sorted(range(len(spans)), key=lambda i: spans[i][0]))}
    return page.assign(column=[place[i] for i in chosen])[["doc", "page", "first", "column"]]


def with_columns(line_rows: DataFrame) -> DataFrame:
    """Adds ``column``. The rule depends on the order of lines, so it runs page by page."""
    ship_package(line_rows.sparkSession)
    flat = line_rows.select("doc", "page", "first", F.col("box.left").alias("left"), F.col("box.right").alias("right"),
                            F.col("box.top").alias("top"))
    # A page's time is in Python, not in its bytes, by which adaptive execution would put all pages into a task or two.
    dealt = flat.repartition(int(flat.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc", "page")
    found = dealt.groupBy("doc", "page").applyInPandas(_columns_of_page, "doc string, page int, first long, column int")
    return line_rows.join(found, ["doc", "page", "first"])


def shares_region(upper: Column, lower: Column) -> Column:
    """Whether a line continues the region of the one above: a small gap and a shared extent."""
    gap = upper["box"]["bottom"] - lower["box"]["top"]
    return (gap <= (upper["height"] + lower["height"]) / 2 * LINE_GAP) & (
        g.horizontal_overlap(upper["box"], lower["box"]) >= COLUMN_OVERLAP)


def regions(line_rows: DataFrame) -> DataFrame:
    """(doc, page, column, region, box, text, lines, first) of vertical runs of lines."""
    keys, order = ["doc", "page", "column"], [F.col("box.top").desc(), F.col("box.left"), F.col("first")]
    w = Window.partitionBy(*keys).orderBy(*order)
    own = F.struct("box", "height")
    marked = line_rows.withColumn("_above", F.lag(own).over(w))
    opens = F.col("_above").isNotNull() & ~shares_region(F.col("_above"), own)
    numbered = islands(marked, keys, order, opens, "block")
    out = numbered.groupBy(*keys, "block").agg(
        g.union(F.col("box")).alias("box"), F.count("*").alias("lines"), F.min("first").alias("first"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(
            (-F.col("box.top")).alias("t"), F.col("box.left").alias("l"), "first", "text"))), lambda x: x["text"]), "").alias("text"))
    return out


def mark_repeated_edges(region_rows: DataFrame, pages: DataFrame) -> DataFrame:
    """Adds ``edge``: page_header, page_footer, page_number or null.

    ``pages``: doc, page_count. The same text in the top or bottom band of 60 % of the pages
    is an edge; a bottom text of digits alone is a page number even if it is unique.
    """
    place = (F.when(F.col("box.top") >= 1 - EDGE_BAND, "page_header").when(F.col("box.bottom") <= EDGE_BAND, "page_footer"))
    r = region_rows.withColumn("_edge", place).withColumn("_text", F.lower(F.regexp_replace("text", r"\s+", "")))
    seen = r.where("_edge IS NOT NULL").groupBy("doc", "_edge", "_text").agg(F.count_distinct("page").alias("_seen"))
    seen = seen.join(pages, "doc").where(F.col("_seen") >= F.col("page_count") * REPEAT_RATIO).select(
        "doc", "_edge", "_text", F.lit(True).alias("_repeated"))
    j = r.join(seen, ["doc", "_edge", "_text"], "left")
    digits = F.col("_text").rlike("^[0-9]+$")
    repeated = F.coalesce("_repeated", F.lit(False))
    edge = (F.when(repeated & digits, "page_number").when(repeated, F.col("_edge"))
            .when(digits & (F.col("box.bottom") <= EDGE_BAND), "page_number"))
    return j.withColumn("edge", edge).drop("_edge", "_text", "_repeated")


def reading_edges(region_rows: DataFrame) -> DataFrame:
    """(doc, before, after, reason) along the reading order: page, column, down, right."""
    order = ["page", "column", F.col("box.top").desc(), F.col("box.left"), "first"]
    return successor_edges(region_rows, ["doc"], order, "first", "page", "column")


def geometric_text(atoms: DataFrame) -> DataFrame:
    """(doc, region, text): characters with a space at gaps of 0.6 of the upper median width."""
    keys = ["doc", "region"]
    w = Window.partitionBy(*keys).orderBy("ordinal")
    chars = atoms.withColumn("_breaks", F.sum(F.when(F.col("kind") == "line_break", 1).otherwise(0)).over(w)).where("kind = 'character'")
    wide = F.when(g.width(F.col("box")) > 0, g.width(F.col("box")))
    ranked = F.sort_array(F.collect_list(wide).over(Window.partitionBy(*keys)))
    c = chars.withColumn("_typical", F.coalesce(F.try_element_at(ranked, (F.floor(F.size(ranked) / 2) + 1).cast("int")), F.lit(0.0)))
    gap = F.coalesce(F.lead("box.left").over(w) - F.col("box.right"), F.lit(0.0))
    mark = (F.when(F.lead("text").over(w).isNull(), "").when(F.lead("_breaks").over(w) > F.col("_breaks"), "\n")
            .when((F.col("_typical") > 0) & (gap >= F.col("_typical") * SPACE_WIDTH), " ").otherwise(""))
    c = c.withColumn("_piece", F.concat("text", mark))
    return c.groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(
        F.struct("ordinal", "_piece"))), lambda x: x["_piece"]), "").alias("text"))


def row_groups(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``row_group``: boxes whose vertical extents overlap, directly or through others."""
    # Plain columns, so that both windows share one sort: after another one, equal boxes might stand in another order
    # and be counted before the one that opened their row.
    order = [F.col("_top").desc(), F.col("_bottom").desc()]
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = cells.withColumn("_top", F.col("box.top")).withColumn("_bottom", F.col("box.bottom"))
    marked = marked.withColumn("_floor", F.min("_bottom").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    return islands(marked, keys, order, F.col("_top") <= F.col("_floor"), "row_group").drop("_floor", "_top", "_bottom")


def _middle(ordered: list[float]) -> float:
    """The median of sorted values; a list that grows at its end needs no other sort."""
    at = len(ordered) // 2
    return ordered[at] if len(ordered) % 2 else (ordered[at - 1] + ordered[at]) / 2


def _clusters(lefts) -> list[list[float]]:
    """One-dimensional clusters: a start more than 0.04 beyond the running median opens a new one."""
    groups: list[list[float]] = []
    for x in sorted(lefts):
        if groups and x - _middle(groups[-1]) <= ANCHOR_GAP:
            groups[-1].append(x)
        else:
            groups.append([x])
    return groups


def anchor_positions(lefts) -> list[float]:
    """The medians of the clusters of left edges, in order."""
    return [_middle(c) for c in _clusters(lefts)]


def _anchors_of_group(frame: pd.DataFrame) -> pd.DataFrame:
    groups = _clusters(frame["left"])
    return pd.DataFrame({"doc": frame["doc"].iloc[0], "block": frame["block"].iloc[0], "anchor": range(len(groups)),
                         "position": [_middle(c) for c in groups], "members": [len(c) for c in groups]})


def column_anchors(starts: DataFrame) -> DataFrame:
    """(doc, block, anchor, position, members) of left edges (doc, block, left)."""
    ship_package(starts.sparkSession)
    return starts.groupBy("doc", "block").applyInPandas(
        _anchors_of_group, "doc string, block long, anchor int, position double, members int")


def continuations(region_rows: DataFrame, least: float = 0.75) -> DataFrame:
    """(doc, page, before, after, overlap): last and first regions of adjacent pages that align."""
    rank = F.struct(F.col("column"), (-F.col("box.top")).alias("t"), "box", "first")
    edge = region_rows.groupBy("doc", "page").agg(F.max(rank).alias("low"), F.min(rank).alias("high"))
    after = edge.select("doc", (F.col("page") - 1).alias("page"), F.col("high").alias("next"))
    j = edge.join(after, ["doc", "page"])
    overlap = g.horizontal_overlap(F.col("low.box"), F.col("next.box"))
    return j.select("doc", "page", F.col("low.first").alias("before"), F.col("next.first").alias("after"),
                    overlap.alias("overlap")).where(F.col("overlap") >= least)
