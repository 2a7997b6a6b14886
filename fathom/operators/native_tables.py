"""Tables that the source itself declares, and blocks that claim their text.

A declared table wins over every block that disagrees with it; its place becomes one lossless
block, and what such a block held elsewhere is left over for :func:`repair.degrade`. Places are ranks of a document's spans, so
regions meet blocks by equality and no ranges are compared.

Spans: doc, span, ordinal. Tables: doc, table, row_count, column_count, cells. Blocks: doc, order,
kind, row_count, column_count, cells, spans. Cells are arrays of structs that hold a grid place and ``spans``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.operators.sequences import merge_intervals

GRID = ["row_count", "column_count", "cells"]


@dataclass(frozen=True)
class Enforced:
    """Blocks (doc, order, kind, spans) after the declared tables won, in source order from 0, the
    exclusions (as given) that still hold, and the spans (as given) that are in neither."""

    blocks: DataFrame
    excluded: DataFrame
    leftover: DataFrame


def cell_spans(cells: Column) -> Column:
    """Spans of all cells in order, each once; none for null."""
    return F.coalesce(F.array_distinct(F.flatten(F.transform(cells, lambda c: c["spans"]))),
                      F.expr("cast(array() as array<string>)"))


def ranked(spans: DataFrame) -> DataFrame:
    """(doc, span, rank): spans by ordinal, from 1."""
    return spans.select("doc", "span", F.row_number().over(Window.partitionBy("doc").orderBy("ordinal", "span")).alias("rank"))


def table_places(tables: DataFrame, places: DataFrame) -> DataFrame:
    """(doc, table, first, last, crossing): ranks a table reaches over, and whether other text lies between.

    ``places``: see :func:`ranked`. Tables without spans have no place.
    """
    own = tables.select("doc", "table", F.explode(cell_spans(F.col("cells"))).alias("span")).join(places, ["doc", "span"])
    return own.groupBy("doc", "table").agg(F.min("rank").alias("first"), F.max("rank").alias("last"), F.count("*").alias("n")).select(
        "doc", "table", "first", "last", (F.col("last") - F.col("first") + 1 != F.col("n")).alias("crossing"))


def _claims(blocks: DataFrame) -> DataFrame:
    """Blocks with the spans they claim; a table's are those of its cells."""
    return blocks.withColumn("spans", F.when(F.col("kind") == "table", cell_spans(F.col("cells"))).otherwise(
        F.coalesce("spans", F.expr("cast(array() as array<string>)"))))


def _nth(df: DataFrame, by: str) -> DataFrame:
    return df.withColumn("n", F.row_number().over(Window.partitionBy("doc", "grid").orderBy(by)))


def _grid_key(df: DataFrame) -> DataFrame:
    return df.withColumn("grid", F.sha2(F.to_json(F.struct(*GRID)).cast("binary"), 256))


def enforce(tables: DataFrame, blocks: DataFrame, spans: DataFrame, excluded: DataFrame) -> Enforced:
    """Declared tables against blocks.

    A table stands if no other text lies within its place and exactly one block touches it, which is
    either a table of the same grid (cells equal one by one, in order) or a lossless block of the whole
    place. Otherwise all blocks that touch its place go, and a lossless block takes it; tables
    whose places overlap become one. A table without text needs a block of its own with its grid, or is
    put in at its own number. ``excluded``: doc, span, and more; those of a taken place go.
    """
    places = ranked(spans)
    at = table_places(tables, places)
    regions = merge_intervals(at, ["doc"], "first", "last")
    claims = _claims(blocks)
    located = claims.select("doc", "order", "kind", F.explode("spans").alias("span")).join(places, ["doc", "span"])
    cover = regions.select("doc", "first", "last", "members", F.explode(F.expr("sequence(first, last)")).alias("rank"))
    met = cover.join(located, ["doc", "rank"], "left")
    per = met.groupBy("doc", "first", "last", "members").agg(
        F.count_distinct("order").alias("touching"), F.min("order").alias("order"), F.min("kind").alias("kind"),
        F.count_distinct(F.when(F.col("order").isNotNull(), F.col("rank"))).alias("covered"))
    grids = _grid_key(tables).select("doc", "table", "grid").join(at.where("NOT crossing"), ["doc", "table"]).select(
        "doc", "first", "last", F.col("grid").alias("wanted"))
    offered = _grid_key(claims).select("doc", "order", "grid")
    judged = per.join(offered, ["doc", "order"], "left").join(grids.dropDuplicates(["doc", "first", "last"]), ["doc", "first", "last"], "left")
    whole = F.col("covered") == F.col("last") - F.col("first") + 1
    stands = (F.col("touching") == 1) & (((F.col("kind") == "lossless") & whole)
                                         | ((F.col("members") == 1) & (F.col("kind") == "table") & F.col("grid").eqNullSafe(F.col("wanted"))))
    taken = judged.where(~F.coalesce(stands, F.lit(False))).select("doc", "first", "last")
    ranks = taken.select("doc", "first", F.explode(F.expr("sequence(first, last)")).alias("rank"))
    gone = ranks.select("doc", "rank").join(located, ["doc", "rank"]).select("doc", "order").distinct()
    lossless = ranks.join(places, ["doc", "rank"]).groupBy("doc", "first").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "span"))), lambda x: x["span"]).alias("spans"))
    blank = _nth(_grid_key(tables.where(F.size(cell_spans(F.col("cells"))) == 0)), "table")
    empty = _nth(_grid_key(claims.where((F.col("kind") == "table") & (F.size("spans") == 0))), "order")
    added = blank.join(empty, ["doc", "grid", "n"], "left_anti")
    none = F.expr("cast(array() as array<string>)")
    firsts = located.groupBy("doc", "order").agg(F.min("rank").alias("first"))
    kept = claims.join(gone, ["doc", "order"], "left_anti").join(firsts, ["doc", "order"], "left").select(
        "doc", "kind", "spans", F.coalesce("first", F.col("order") + 1).alias("at"), F.lit(0).alias("late"), F.col("order").alias("old"))
    new = lossless.select("doc", F.lit("lossless").alias("kind"), "spans", F.col("first").alias("at"), F.lit(1).alias("late"), F.col("first").alias("old"))
    put = added.select("doc", F.lit("table").alias("kind"), none.alias("spans"), (F.col("table") + 1).alias("at"), F.lit(2).alias("late"), F.col("table").alias("old"))
    every = kept.unionByName(new).unionByName(put)
    order = F.row_number().over(Window.partitionBy("doc").orderBy("at", "late", "old")) - 1
    left = excluded.join(ranks.join(places, ["doc", "rank"]).select("doc", "span"), ["doc", "span"], "left_anti")
    done = every.select("doc", F.explode("spans").alias("span")).unionByName(left.select("doc", "span"))
    rest = spans.join(done, ["doc", "span"], "left_anti")
    return Enforced(every.select("doc", order.alias("order"), "kind", "spans"), left, rest)


def cell_text(spacing: Column, rendered: Column, source: Column) -> Column:
    """A cell's text: its spacing candidate's, else its hint's, else the source's own spacing."""
    return F.coalesce(spacing, rendered, source)


def whitespace_dispositions(atoms: DataFrame, boundaries: DataFrame, white: str) -> DataFrame:
    """(doc, atom, outcome, boundary_state, decision_id) of every white-space atom.

    ``atoms``: doc, atom, text, spaced (its region has a spacing candidate), decision_id.
    ``boundaries``: doc, atom, state. ``white``: the class of white-space characters. An atom that has
    a boundary is retained if the state is its own, otherwise normalised; without one it is
    layout only in a spaced region, otherwise retained.
    """
    own = F.when(F.col("text") == "\n", "hard_break").otherwise("space")
    j = atoms.where(F.col("text").rlike(f"^[{white}]+$")).join(boundaries.select("doc", "atom", "state"), ["doc", "atom"], "left")
    outcome = (F.when(F.col("state").isNull(), F.when(F.col("spaced"), "layout_only").otherwise("retained"))
               .when(F.col("state") == own, "retained").otherwise("normalized"))
    return j.select("doc", "atom", outcome.alias("outcome"), F.coalesce("state", own).alias("boundary_state"),
                    F.coalesce("decision_id", F.lit("decision_0000000000000000")).alias("decision_id"))


def block_evidence(blocks: DataFrame, sources: DataFrame, most: int = 500) -> DataFrame:
    """(source_hash, role, locator, excerpt): evidence of every block that holds atoms.

    ``blocks``: doc, region_id, page, order, text, atoms. ``sources``: doc, source_hash, role, path.
    """
    locator = F.struct(F.col("path").alias("document"), "region_id", "page", "order")
    return blocks.where(F.size("atoms") > 0).join(sources, "doc").select(
        "source_hash", "role", locator.alias("locator"), F.substring("text", 1, most).alias("excerpt"))


def span_evidence(spans: DataFrame, blocks: DataFrame, sources: DataFrame, most: int = 500) -> DataFrame:
    """(source_hash, role, locator, excerpt): evidence of every span that a block publishes.

    ``spans``: doc, span, ordinal, page, text. ``blocks``: doc, spans. A null page is left out of the locator.
    """
    published = blocks.select("doc", F.explode("spans").alias("span")).distinct()
    locator = F.struct(F.col("path").alias("document"), F.col("span").alias("span_id"), F.col("ordinal").alias("order"), "page")
    return spans.join(published, ["doc", "span"], "left_semi").join(sources, "doc").select(
        "source_hash", "role", F.to_json(locator).alias("locator"), F.substring("text", 1, most).alias("excerpt"))
