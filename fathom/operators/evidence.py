"""Extracted characters to spans, groups, regions and hint blocks.

``chars``: doc, page, idx, text, obj (the text object a character came from), box. Every step
is a window or an aggregate by document and page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions import geometry as g
from fathom.functions import ids
from fathom.functions import text as t
from fathom.operators.sequences import equal_runs, islands


def _joined(order: str, value: str) -> Column:
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, value))), lambda x: x[value]), "")


def single_line_ends(chars: DataFrame) -> DataFrame:
    """Carriage returns become line feeds; a line feed after one is dropped, across objects too."""
    w = Window.partitionBy("doc", "page").orderBy("idx")
    after = F.coalesce(F.lag("text").over(w) == "\r", F.lit(False))
    c = chars.withColumn("_drop", after & (F.col("text") == "\n")).where("NOT _drop").drop("_drop")
    return c.withColumn("text", F.when(F.col("text") == "\r", "\n").otherwise(F.col("text")))


def object_spans(chars: DataFrame) -> DataFrame:
    """(doc, page, ordinal, span_id, text, box) of the runs of characters of one object.

    Ordinals number a document's spans in order. Pages of white space alone have none.
    """
    runs = equal_runs(chars, ["doc", "page"], ["idx"], "obj")
    # Runs are found on the raw characters: dropped ones must not join their neighbours.
    clean = single_line_ends(runs)
    visible = F.max(t.without_whitespace(F.col("text")) != "").over(Window.partitionBy("doc", "page"))
    clean = clean.withColumn("_seen", visible).where("_seen")
    spans = clean.groupBy("doc", "page", "run").agg(_joined("idx", "text").alias("text"), g.union(F.col("box")).alias("box"))
    w = Window.partitionBy("doc").orderBy("page", "run")
    spans = spans.where("text <> ''").withColumn("ordinal", F.row_number().over(w) - 1)
    return spans.select("doc", "page", "ordinal", ids.span_id(F.col("doc"), F.col("ordinal")).alias("span_id"), "text", "box")


def span_groups(spans: DataFrame) -> DataFrame:
    """(doc, page, member, spans, text, box): white-space spans join the visible one before them, leading ones the first."""
    w = Window.partitionBy("doc", "page").orderBy("ordinal")
    shown = t.without_whitespace(F.col("text")) != ""
    upto = F.sum(shown.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    s = spans.withColumn("member", F.greatest(F.lit(1), upto).cast("int"))
    return s.groupBy("doc", "page", "member").agg(F.count("*").alias("spans"), _joined("ordinal", "text").alias("text"), g.union(F.col("box")).alias("box"))


def atoms(chars: DataFrame) -> DataFrame:
    """(doc, page, ordinal, atom_id, kind, text, box): a row a character, line ends made single."""
    w = Window.partitionBy("doc").orderBy("page", "idx")
    kind = F.when(F.col("text") == "\n", "line_break").when(t.without_whitespace(F.col("text")) == "", "space").otherwise("character")
    c = single_line_ends(chars).withColumn("ordinal", (F.row_number().over(w) - 1).cast("long")).withColumn("kind", kind)
    return c.select("doc", "page", "ordinal", ids.content_id("atom", F.col("doc"), F.col("page"), F.col("ordinal"), F.col("text")).alias("atom_id"), "kind", "text", "box")


def embedded_regions(atom_rows: DataFrame) -> DataFrame:
    """Adds ``region``: lines end at breaks or where the baseline is left; lines without a visible
    character join the one before, leading ones have none."""
    keys = ["doc", "page"]
    w = Window.partitionBy(*keys).orderBy("ordinal")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    a = atom_rows.withColumn("_broken", F.coalesce(F.sum(F.when(F.col("kind") == "line_break", 1).otherwise(0)).over(before), F.lit(0)))
    since = Window.partitionBy(*keys, "_broken").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    a = a.withColumn("_last", F.last(F.when(F.col("kind") != "line_break", F.col("box")), ignorenulls=True).over(since))
    opens = F.coalesce(F.lag("kind").over(w) == "line_break", F.lit(False)) | (
        (F.col("kind") != "line_break") & F.col("_last").isNotNull() & ~g.same_baseline(F.col("_last"), F.col("box")))
    a = islands(a, keys, ["ordinal"], opens, "_line")
    shown = F.max((F.col("kind") == "character") & F.col("box").isNotNull()).over(Window.partitionBy(*keys, "_line"))
    a = a.withColumn("_shown", shown)
    own = F.last(F.when(F.col("_shown"), F.col("_line")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return a.withColumn("region", own).drop("_broken", "_last", "_line", "_shown")


def recognised_regions(spans: DataFrame) -> DataFrame:
    """(doc, region_id, hypothesis_id, text, confidence): one hypothesis for each visible recognised span."""
    s = spans.where("page IS NOT NULL AND box IS NOT NULL").where(t.without_whitespace(F.col("text")) != "")
    region = ids.content_id("region", F.col("doc"), F.lit("ocr"), F.col("page"), F.col("ordinal"))
    return s.select("doc", "page", "box", region.alias("region_id"), ids.content_id("hyp", F.col("doc"), region, ids.sha256_hex(F.col("text"))).alias("hypothesis_id"),
                    "text", F.lit(1.0).alias("confidence"))


def materialised_atoms(regions: DataFrame) -> DataFrame:
    """An atom for each character of a region's best hypothesis, the region's box repeated."""
    best = regions.groupBy("doc", "region_id").agg(
        F.max_by(F.struct("text", "box", "page"), F.struct("confidence", "hypothesis_id")).alias("b"))
    c = best.select("doc", "region_id", "b.page", "b.box", F.posexplode(F.split("b.text", "")).alias("place", "text"))
    return c.select("doc", "region_id", "page", "place", "text", "box", ids.content_id("atom", F.col("doc"), F.col("region_id"), F.col("place")).alias("atom_id"))


def evidence_mode(chars: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc, mode): embedded where every page has text, ocr where none has, else mixed."""
    has = chars.where(t.without_whitespace(F.col("text")) != "").select("doc", "page").distinct().withColumn("has", F.lit(True))
    j = pages.join(has, ["doc", "page"], "left")
    every, some = F.bool_and(F.coalesce("has", F.lit(False))), F.bool_or(F.coalesce("has", F.lit(False)))
    return j.groupBy("doc").agg(F.when(every, "embedded").when(some, "mixed").otherwise("ocr").alias("mode"))


HINT_KINDS = {"title": "title", "section_header": "heading", "list_item": "list_item", "table": "table"}


def hint_blocks(items: DataFrame) -> DataFrame:
    """(doc, order, kind, level, text, box) of layout items (doc, position, label, level, text, box)."""
    kind = None
    for label, name in HINT_KINDS.items():
        kind = F.when(F.col("label") == label, name) if kind is None else kind.when(F.col("label") == label, name)
    w = Window.partitionBy("doc").orderBy("position")
    level = F.when(kind.otherwise("paragraph") == "heading", F.least(F.lit(6), F.greatest(F.lit(1), F.coalesce("level", F.lit(1)) + 1)))
    return items.select("doc", (F.row_number().over(w) - 1).alias("order"), kind.otherwise("paragraph").alias("kind"), level.alias("level"), "text", "box")


def unique_cells(cells: DataFrame) -> DataFrame:
    """One cell for each four coordinates of a table, the first, in order of place."""
    at = ["table", "start_row", "start_column", "end_row", "end_column"]
    w = Window.partitionBy(*at).orderBy("cell")
    return cells.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def group_location(spans: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, page, box): where a set of spans lies; no page where they cross pages."""
    a = spans.groupBy(*keys).agg(F.count_distinct("page").alias("pages"), F.min("page").alias("page"), g.union(F.col("box")).alias("box"))
    return a.select(*keys, F.when(F.col("pages") <= 1, F.col("page")).alias("page"), F.when(F.col("pages") <= 1, F.col("box")).alias("box"))


def kinds_compatible(group_kind: Column, hint_kind: Column) -> Column:
    return F.when(group_kind.isin("table", "alt_text", "text_box"), False).when(group_kind == "caption", hint_kind == "paragraph").otherwise(True)


def table_column_count(rows: DataFrame, declared: DataFrame) -> DataFrame:
    """(table, columns, code): the widest row, or what is declared; declaring less is an error.

    ``rows``: table, row, before (skipped columns), span.
    """
    wide = rows.groupBy("table", "row").agg((F.max("before") + F.sum("span")).alias("n")).groupBy("table").agg(F.max("n").alias("widest"))
    j = wide.join(declared, "table", "left")
    return j.select("table", F.coalesce("declared", "widest").alias("columns"), F.when(F.col("declared") < F.col("widest"), "DOCX_TABLE_DECLARED_GRID_TOO_SMALL").alias("code"))


def list_metadata(paragraphs: DataFrame, formats: DataFrame) -> DataFrame:
    """(paragraph, kind, depth): list kind and depth of paragraphs (paragraph, num, level); number 0 is no list."""
    j = paragraphs.where("num IS NOT NULL AND num <> 0").join(formats, ["num", "level"], "left")
    return j.select("paragraph", F.when(F.col("format") == "bullet", "unordered").otherwise("ordered").alias("kind"), (F.col("level") + 1).alias("depth"))


def place_by_hint(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``position``: pieces (text, idx) in the order the hint has them, if they make up the hint exactly.

    ``hint`` is on every row. Otherwise the pieces keep their own order.
    """
    dense, target = t.without_whitespace(F.col("text")), t.without_whitespace(F.col("hint"))
    p = pieces.withColumn("_t", target).withColumn("_d", dense).withColumn("_at", F.expr("instr(_t, _d)"))
    w = Window.partitionBy(*keys)
    by_hint = F.row_number().over(w.orderBy("_at", "idx"))
    p = p.withColumn("_by_hint", by_hint).withColumn("_own", F.row_number().over(w.orderBy("idx")))
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_at", "idx", "_d")).over(w)), lambda x: x["_d"]), "")
    p = p.withColumn("_fits", (whole == F.col("_t")) & (F.min("_at").over(w) > 0))
    return p.withColumn("position", F.when(F.col("_fits"), F.col("_by_hint")).otherwise(F.col("_own"))).drop("_t", "_d", "_at", "_by_hint", "_own", "_fits")


def characters_by_hint(chars: DataFrame, hints: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, idx, place): each character's place in the hint, repeated ones first come, first served.

    ``chars``: keys, idx, text. ``hints``: keys, hint. Both sides are unrolled texts, so they merge at every size.
    """
    nth = F.row_number().over(Window.partitionBy(*keys, "text").orderBy("idx"))
    mine = chars.withColumn("nth", nth)
    theirs = hints.select(*keys, F.posexplode(F.split(t.without_whitespace(F.col("hint")), "")).alias("place", "text"))
    theirs = theirs.withColumn("nth", F.row_number().over(Window.partitionBy(*keys, "text").orderBy("place")))
    return mine.join(theirs.hint("merge"), [*keys, "text", "nth"]).select(*keys, "idx", "place")
