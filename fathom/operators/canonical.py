"""Canonical documents: exactly-once accounting, grids, rendering, fidelity.

``catalog``: doc, item (all source items). ``allocations``: doc, item, owner. Findings are long tables
(doc, code, n), so one pass judges any number of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions import text as t
from fathom.operators.sequences import islands

MOST_ROWS, MOST_COLUMNS, MOST_AREA = 10_000, 256, 100_000


def coverage(catalog: DataFrame, allocations: DataFrame, excluded: DataFrame) -> DataFrame:
    """(doc, items, excluded, unknown, duplicated, unmatched, ratio) of exactly-once allocation."""
    owned = allocations.groupBy("doc", "item").agg(F.count("*").alias("n"))
    left = excluded.select("doc", "item").distinct().withColumn("out", F.lit(True))
    j = (catalog.withColumn("known", F.lit(True)).join(owned, ["doc", "item"], "full_outer")
         .join(left, ["doc", "item"], "left"))
    known, out, n = F.col("known").isNotNull(), F.col("out").isNotNull(), F.coalesce(F.col("n"), F.lit(0))
    agg = j.groupBy("doc").agg(
        F.count_if(known).alias("items"), F.count_if(known & out).alias("excluded"), F.count_if(~known).alias("unknown"),
        F.count_if(known & ((n > 1) | ((n == 1) & out))).alias("duplicated"), F.count_if(known & ~out & (n == 0)).alias("unmatched"))
    due = F.col("items") - F.col("excluded")
    return agg.withColumn("ratio", F.when(due > 0, F.round((due - F.col("unmatched")) / due, 6)).otherwise(1.0))


def grid_findings(cells: DataFrame, tables: DataFrame) -> DataFrame:
    """(table, code) of tables whose cells don't partition their grid exactly.

    ``cells``: table, cell, start_row, end_row, start_column, end_column (ends exclusive).
    ``tables``: table, row_count, column_count. Counting covered places by area and by
    overlapping pairs of the same row would miss shapes, so cells are unrolled to
    places; limits are checked first and bound that.
    """
    code = (F.when((F.col("row_count") > MOST_ROWS) | (F.col("column_count") > MOST_COLUMNS), "TABLE_GRID_DIMENSIONS_INVALID")
            .when(F.col("row_count") * F.col("column_count") > MOST_AREA, "TABLE_GRID_AREA_LIMIT"))
    limits = tables.select("table", code.alias("code")).where("code IS NOT NULL")
    sound = tables.join(limits, "table", "left_anti")
    c = cells.join(sound, "table")
    bad = (F.col("start_row") < 0) | (F.col("start_column") < 0) | (F.col("end_row") > F.col("row_count")) | (
        F.col("end_column") > F.col("column_count")) | (F.col("end_row") <= F.col("start_row")) | (F.col("end_column") <= F.col("start_column"))
    outside = c.where(bad).select("table", F.lit("TABLE_CELL_OUT_OF_BOUNDS").alias("code")).distinct()
    inside = c.join(outside, "table", "left_anti")
    places = inside.withColumn("r", F.explode(F.expr("sequence(start_row, end_row - 1)"))).withColumn(
        "k", F.explode(F.expr("sequence(start_column, end_column - 1)")))
    met = places.groupBy("table", "r", "k").agg(F.count("*").alias("n"))
    filled = met.groupBy("table").agg(F.count("*").alias("places"), F.max("n").alias("most"))
    rest = sound.join(outside, "table", "left_anti").join(filled, "table", "left")
    whole = F.when(F.coalesce("most", F.lit(0)) > 1, "TABLE_GRID_OVERLAP").when(
        F.coalesce("places", F.lit(0)) < F.col("row_count") * F.col("column_count"), "TABLE_GRID_NOT_PARTITIONED")
    return limits.unionByName(outside).unionByName(rest.select("table", whole.alias("code")).where("code IS NOT NULL"))


def complete_grid(cells: DataFrame, tables: DataFrame) -> DataFrame:
    """(table, r, k) of places no cell covers, to be filled with empty cells."""
    every = tables.withColumn("r", F.explode(F.expr("sequence(0, row_count - 1)"))).withColumn(
        "k", F.explode(F.expr("sequence(0, column_count - 1)"))).select("table", "r", "k")
    held = cells.withColumn("r", F.explode(F.expr("sequence(start_row, end_row - 1)"))).withColumn(
        "k", F.explode(F.expr("sequence(start_column, end_column - 1)"))).select("table", "r", "k")
    return every.join(held, ["table", "r", "k"], "left_anti")


def table_markdown(cells: DataFrame, tables: DataFrame) -> DataFrame:
    """(table, markdown): a rectangular table; spanned values repeat, the first header row heads it.

    ``cells`` also has text and header. Without a header row the head is blank.
    """
    places = cells.withColumn("r", F.explode(F.expr("sequence(start_row, end_row - 1)"))).withColumn(
        "k", F.explode(F.expr("sequence(start_column, end_column - 1)")))
    heads = places.where("header").groupBy("table").agg(F.min("r").alias("head"))
    rows = places.groupBy("table", "r").agg(F.concat(F.lit("| "), F.array_join(F.transform(F.sort_array(F.collect_list(
        F.struct("k", t.escape_table_value(F.col("text")).alias("v")))), lambda x: x["v"]), " | "), F.lit(" |")).alias("line"))
    rows = rows.join(heads, "table", "left")
    body = rows.groupBy("table").agg(
        F.max(F.when(F.col("r") == F.col("head"), F.col("line"))).alias("top"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(
            F.col("head").isNull() | (F.col("r") != F.col("head")), F.struct("r", "line")))), lambda x: x["line"]), "\n").alias("rest"))
    j = body.join(tables.select("table", "column_count"), "table")
    blank = F.concat(F.lit("|"), F.expr("repeat('  |', column_count)"))
    rule = F.concat(F.lit("|"), F.expr("repeat(' --- |', column_count)"))
    out = F.concat_ws("\n", F.coalesce("top", blank), rule, F.when(F.col("rest") != "", F.col("rest")))
    return j.select("table", out.alias("markdown"))


def document_markdown(blocks: DataFrame, base_depth: int = 0) -> DataFrame:
    """(doc, markdown): blocks in order, list items of one run on adjacent lines.

    ``blocks``: doc, order, kind (title, heading, paragraph, list_item, table, caption), level,
    text (tables: their markdown).
    """
    line = (F.when(F.col("kind") == "table", F.col("text"))
            .when(F.col("kind").isin("title", "heading"), F.concat(
                F.expr("repeat('#', CASE WHEN kind = 'title' THEN 1 ELSE least(6, greatest(1, coalesce(level, 2))) END)"), F.lit(" "), t.escape_inline(F.col("text"))))
            .when(F.col("kind") == "list_item", t.list_item(F.col("text"), F.greatest(F.lit(base_depth), F.coalesce(F.col("level"), F.lit(base_depth))), base_depth))
            .otherwise(t.escape_inline(F.col("text"))))
    w = Window.partitionBy("doc").orderBy("order")
    b = blocks.withColumn("line", line).withColumn("_item", F.col("kind") == "list_item")
    b = b.withColumn("_joins", F.col("_item") & F.coalesce(F.lag("_item").over(w), F.lit(False)))
    b = islands(b, ["doc"], ["order"], ~F.col("_joins"), "run")
    runs = b.groupBy("doc", "run").agg(F.array_join(F.transform(F.sort_array(
        F.collect_list(F.struct("order", "line"))), lambda x: x["line"]), "\n").alias("part"))
    return runs.groupBy("doc").agg(F.concat(F.array_join(F.transform(F.sort_array(
        F.collect_list(F.struct("run", "part"))), lambda x: x["part"]), "\n\n"), F.lit("\n")).alias("markdown"))


def fidelity(blocks: DataFrame, cover: DataFrame) -> DataFrame:
    """One report row a document: blocks by kind, coverage and status PASS, WARN or FAIL."""
    kinds = blocks.groupBy("doc").agg(
        *[F.count_if(F.col("kind") == k).alias(f"{k}s") for k in ("heading", "paragraph", "list_item", "table", "caption")],
        F.count_if("degraded").alias("degraded"))
    j = kinds.join(cover, "doc")
    lost = (F.col("unmatched") > 0) | (F.col("duplicated") > 0) | (F.col("unknown") > 0)
    return j.withColumn("status", F.when(lost, "FAIL").when(F.col("degraded") > 0, "WARN").otherwise("PASS"))


def invariant_findings(catalog: DataFrame, allocations: DataFrame, excluded: DataFrame, proofs: DataFrame,
                       order: DataFrame) -> DataFrame:
    """(doc, code, n): broken invariants of whole canonical documents.

    ``proofs``: doc, item of exclusions that are proven. ``order``: doc, position of blocks,
    which must be 0 .. n - 1.
    """
    def finding(rows: DataFrame, code: str) -> DataFrame:
        return rows.groupBy("doc").agg(F.count("*").alias("n")).select("doc", F.lit(code).alias("code"), "n")

    keys = ["doc", "item"]
    unknown = allocations.join(catalog, keys, "left_anti")
    twice = allocations.groupBy(*keys).count().where("count > 1")
    missing = catalog.join(allocations, keys, "left_anti").join(excluded, keys, "left_anti")
    unproven = excluded.join(proofs, keys, "left_anti")
    gaps = order.withColumn("want", F.row_number().over(Window.partitionBy("doc").orderBy("position")) - 1).where("want <> position")
    out = finding(unknown, "INVARIANT_EVIDENCE_REFERENCE")
    for rows, code in ((twice, "INVARIANT_ATOM_ALLOCATION_DUPLICATE"), (missing, "INVARIANT_ATOM_ALLOCATION_MISSING"),
                       (unproven, "INVARIANT_EXCLUSION_PROOF"), (gaps, "INVARIANT_READING_ORDER")):
        out = out.unionByName(finding(rows, code))
    return out


def first_failure(checks: DataFrame, keys: list[str], rank: str, code: str) -> DataFrame:
    """The failed check of lowest rank of each entity."""
    return checks.groupBy(*keys).agg(F.min_by(code, rank).alias("code"))
