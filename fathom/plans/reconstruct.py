"""Positioned characters to a canonical document, as one plan.

atoms -> lines -> columns and regions -> repeated edges -> block candidates -> decisions ->
Markdown and accounting. Every step is partitioned by document; nothing is lost: each
region becomes one block, repeated edges are excluded with their proof.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions import geometry as g
from fathom.operators import candidates, canonical, layout, spatial, tables
from fathom.session import stored


@dataclass(frozen=True)
class Reconstruction:
    """The tables of a run; lazy beyond its regions."""

    regions: DataFrame  # doc, page, column, block, box, text, lines, first, edge
    decisions: DataFrame  # doc, region, outcome, kind, confidence
    blocks: DataFrame  # doc, order, kind, level, text
    markdown: DataFrame  # doc, markdown
    coverage: DataFrame  # doc, items, excluded, unknown, duplicated, unmatched, ratio


def _hinted_tables(line_rows: DataFrame, boxes: DataFrame) -> DataFrame:
    """Lines of sound tables, with ``block`` and their table's ``markdown``.

    A line belongs to the first box that covers half of it; a table whose cells don't fit a grid is none, and its
    lines stay text.
    """
    hints = boxes.select("doc", "page", "hint_order", F.col("box").alias("hint_box"))
    claims = spatial.claim_by_hints(line_rows.select("doc", "page", "first", "box"), hints, ["doc", "page"], "first", "box", "hint_box")
    inside = line_rows.join(claims.select("doc", "page", "first", F.col("hint_order").cast("long").alias("block")), ["doc", "page", "first"])
    cells = tables.geometry_cells(inside.select("doc", "block", "first", "box", "text"))
    return inside.join(tables.markdown(cells), tables.KEYS)


def reconstruct(atoms: DataFrame, hints: DataFrame | None = None, table_boxes: DataFrame | None = None) -> Reconstruction:
    """``atoms`` as in :mod:`fathom.operators.layout`; ``hints``: doc, region (first ordinal), hint;
    ``table_boxes``: doc, page, hint_order (a document's own number), box.

    Lines in a table's box become one table block where their places form a grid. Lines and regions are
    each used several times, so they are written in the folder of ``spark.checkpoint.dir``: characters are read once.
    With boxes, the lineage of tables is cut there too.
    """
    line_rows = stored(layout.lines(atoms), "lines")
    grids = None
    if table_boxes is not None:
        inside = _hinted_tables(line_rows, table_boxes).checkpoint(eager=False)
        line_rows = line_rows.join(inside.select("doc", "first"), ["doc", "first"], "left_anti")
        grids = inside.groupBy("doc", "page", "block").agg(g.union(F.col("box")).alias("box"), F.min("first").alias("first"), F.first("markdown").alias("text"))
    rows = stored(layout.regions(layout.with_columns(line_rows)), "regions")
    pages = rows.groupBy("doc").agg(F.max("page").alias("page_count"))
    marked = stored(layout.mark_repeated_edges(rows, pages), "marked")
    body = marked.where("edge IS NULL")
    if hints is None:
        body = body.withColumn("hint", F.lit(None).cast("string"))
    else:
        body = body.join(hints.select("doc", F.col("region").alias("first"), "hint"), ["doc", "first"], "left")
    typical = F.median(g.height(F.col("box")) / F.col("lines")).over(Window.partitionBy("doc"))
    scored = candidates.block_candidates(body.select(
        "doc", F.col("first").alias("region"), "text", (g.height(F.col("box")) / F.col("lines")).alias("line_height"), typical.alias("typical_height"), "hint"))
    decided = candidates.decide(scored.select("doc", "region", F.col("kind").alias("candidate_id"), "score", F.lit(False).alias("proven"),
                                              F.lit(None).cast("string").alias("signature"), F.lit(0).alias("defects")), ["doc", "region"])
    decided = decided.withColumnRenamed("candidate_id", "kind")
    w = Window.partitionBy("doc").orderBy("page", "column", F.col("box.top").desc(), F.col("box.left"), "first")
    chosen = decided.select("doc", F.col("region").alias("first"), "kind")
    placed = body.join(chosen, ["doc", "first"]).withColumn("drawn", F.lit(False)).select("doc", "page", "column", "box", "first", "kind", "text", "drawn")
    if grids is not None:
        # A table comes before the text of its column that lies lower; it spans columns, so it is in the first.
        placed = placed.unionByName(grids.select("doc", "page", F.lit(0).alias("column"), "box", "first", F.lit("table").alias("kind"), "text", F.lit(True).alias("drawn")))
    # A deferred table has no grid, so its text stays a paragraph.
    blocks = placed.withColumn("order", F.row_number().over(w) - 1).select(
        "doc", "order", F.when((F.col("kind") == "table") & ~F.col("drawn"), "paragraph").otherwise(F.col("kind")).alias("kind"),
        F.lit(None).cast("int").alias("level"), "text", "first")
    catalog = marked.select("doc", F.col("first").alias("item"))
    if grids is not None:
        catalog = catalog.unionByName(grids.select("doc", F.col("first").alias("item")))
    cover = canonical.coverage(catalog, blocks.select("doc", F.col("first").alias("item")), marked.where("edge IS NOT NULL").select("doc", F.col("first").alias("item")))
    return Reconstruction(marked, decided, blocks.drop("first"), canonical.document_markdown(blocks.select("doc", "order", "kind", "level", "text")), cover)
