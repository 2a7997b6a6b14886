"""Checks of proposed repairs: whitespace candidates, page patches, structure plans.

Proposals come from outside as rows; each gets the first code it fails, or none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions import text as t
from fathom.operators.sequences import merge_intervals

LEAST_CONFIDENCE, MOST_GROWTH = 0.80, 2


def generated_code(anchor: Column, proposal: Column, mutable: Column | None = None) -> Column:
    """Why a generated spacing is refused, or null.

    The visible characters, hard line breaks and immutable boundaries stay; only spaces
    and line feeds are used; identifiers and other tokens of the anchor stay whole.
    ``mutable``: array of boundary indexes that may change; null: all.
    """
    before, after = t.spacing_states(anchor), t.spacing_states(proposal)
    hard = F.exists(t.changed_boundaries(before, after), lambda i: F.substring(before, 1, 0).isNull() | (
        (F.element_at(F.split(before, ""), i + 1) == "h") != (F.element_at(F.split(after, ""), i + 1) == "h")))
    other_white = t.WHITE.replace(r"\t-\r", r"\t\x0b-\r").replace(r"\x1c-\x20", r"\x1c-\x1f")
    lost = F.exists(t.protected_tokens(anchor), lambda token: ~F.contains(proposal, token))
    fixed = F.lit(False) if mutable is None else F.when(mutable.isNotNull(), F.exists(
        t.changed_boundaries(before, after), lambda i: ~F.array_contains(mutable, i))).otherwise(False)
    return (F.when(t.without_whitespace(anchor) != t.without_whitespace(proposal), "SPACING_REPAIR_CHARACTER_MISMATCH")
            .when(proposal.rlike(f"[{other_white}]"), "SPACING_REPAIR_CONTROL_SEPARATOR")
            .when(proposal.rlike(f"[{t.WHITE}]_|_[{t.WHITE}]"), "SPACING_REPAIR_IDENTIFIER_SPLIT")
            .when(lost, "SPACING_REPAIR_PROTECTED_TOKEN_SPLIT")
            .when(hard, "SPACING_REPAIR_HARD_LINE_BOUNDARY_MISMATCH")
            .when(fixed, "SPACING_REPAIR_IMMUTABLE_BOUNDARY_MISMATCH"))


def patch_code(original: Column, patched: Column, confidence: Column) -> Column:
    """Why a text patch is refused, or null: confidence, growth, line count, markup."""
    lines = F.regexp_count(original, F.lit("\n")) != F.regexp_count(patched, F.lit("\n"))
    return (F.when(original.isNull(), "SEMANTIC_OCR_CORRECTION_UNKNOWN_SPAN").when(confidence < LEAST_CONFIDENCE, "SEMANTIC_OCR_CORRECTION_CONFIDENCE_LOW")
            .when(F.char_length(patched) > F.greatest(F.lit(1), F.char_length(original)) * MOST_GROWTH, "SEMANTIC_OCR_CORRECTION_TEXT_GROWTH_EXCEEDED")
            .when(lines, "SEMANTIC_OCR_CORRECTION_LINE_BLOCK_CHANGE").when(t.has_raw_html(patched) & ~t.has_raw_html(original), "SEMANTIC_OCR_CORRECTION_TEXT_UNSAFE"))


def page_codes(patches: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc, page, code): the first failure of a page's patches rejects the page; null: accepted."""
    j = patches.join(spans.select("doc", "page", "span", "text"), ["doc", "page", "span"], "left")
    c = j.withColumn("code", patch_code(F.col("text"), F.col("patched"), F.col("confidence")))
    return c.groupBy("doc", "page").agg(F.min_by("code", F.when(F.col("code").isNotNull(), F.col("position"))).alias("code"))


def patched_spans(spans: DataFrame, patches: DataFrame) -> DataFrame:
    """(doc, page, span, text, text_hash): spans with the patches of accepted pages; a page with a refused
    patch keeps all its texts."""
    good = page_codes(patches, spans).where("code IS NULL").select("doc", "page")
    new = patches.join(good, ["doc", "page"], "left_semi").select("doc", "page", "span", "patched")
    j = spans.join(new, ["doc", "page", "span"], "left").withColumn("text", F.coalesce("patched", "text"))
    return j.select("doc", "page", "span", "text", F.sha2(F.col("text").cast("binary"), 256).alias("text_hash"))


def page_snapshots(spans: DataFrame, pages: DataFrame, identity: list[str]) -> DataFrame:
    """(doc, page, catalog_hash, request_hash): what a page's corrections were asked for.

    ``spans``: doc, page, span, position, text_hash. ``pages``: doc, page, image_hash and the ``identity``
    columns (source, prompt and schema hashes, provider, model). A page without spans has an empty catalogue.
    """
    row = F.struct("position", F.struct(F.col("span").alias("span_id"), "text_hash").alias("item"))
    listed = spans.groupBy("doc", "page").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    j = pages.join(listed, ["doc", "page"], "left")
    items = F.coalesce(F.to_json(F.transform("rows", lambda r: r["item"])), F.lit("[]"))
    c = j.withColumn("catalog_hash", F.sha2(items.cast("binary"), 256))
    request = F.to_json(F.struct("page", "image_hash", "catalog_hash", *identity))
    return c.select("doc", "page", "catalog_hash", F.sha2(request.cast("binary"), 256).alias("request_hash"))


def plan_codes(plan: DataFrame, context: DataFrame) -> DataFrame:
    """(doc, code): the first rule a structure plan breaks; null: valid.

    ``plan``: doc, block, order, span, confidence. ``context``: doc, span (unresolved ones). Rules in
    order: unknown, missing, duplicate, order, confidence.
    """
    known = context.withColumn("due", F.lit(True))
    j = plan.join(known, ["doc", "span"], "full_outer")
    counted = j.groupBy("doc", "span").agg(F.count("block").alias("n"), F.bool_or(F.col("due").isNotNull()).alias("due"))
    per = counted.groupBy("doc").agg(F.bool_or(~F.col("due")).alias("unknown"), F.bool_or(F.col("due") & (F.col("n") == 0)).alias("missing"),
                                     F.bool_or(F.col("n") > 1).alias("twice"))
    blocks = plan.groupBy("doc", "block").agg(F.min("order").alias("order"), F.min("confidence").alias("confidence"))
    w = Window.partitionBy("doc").orderBy("order", "block")
    o = blocks.withColumn("want", F.row_number().over(w) - 1).groupBy("doc").agg(
        F.bool_or(F.col("want") != F.col("order")).alias("disordered"), F.min("confidence").alias("confidence"))
    code = (F.when(F.col("unknown"), "SEMANTIC_REPAIR_UNKNOWN_SPAN").when(F.col("missing"), "SEMANTIC_REPAIR_MISSING_SPAN").when(F.col("twice"), "SEMANTIC_REPAIR_DUPLICATE_SPAN")
            .when(F.coalesce("disordered", F.lit(False)), "SEMANTIC_REPAIR_ORDER_INVALID").when(F.col("confidence") < LEAST_CONFIDENCE, "SEMANTIC_REPAIR_CONFIDENCE_LOW"))
    return per.join(o, "doc", "left").select("doc", code.alias("code"))


def evidence_batches(pages: DataFrame) -> DataFrame:
    """(doc, first, last, members): row ranges (doc, first, last) of pages, page-less runs and tables merged."""
    return merge_intervals(pages, ["doc"], "first", "last")


def degrade(unresolved: DataFrame) -> DataFrame:
    """(doc, run, first, last, text): leftover spans (doc, ordinal, text) as lossless paragraphs of adjacent spans."""
    w = Window.partitionBy("doc").orderBy("ordinal")
    r = unresolved.withColumn("run", F.col("ordinal") - F.row_number().over(w))
    return r.groupBy("doc", "run").agg(F.min("ordinal").alias("first"), F.max("ordinal").alias("last"), F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("ordinal", "text"))), lambda x: x["text"]), "").alias("text"))


def multiset_equal(a: Column, b: Column) -> Column:
    """Whether two texts have the same visible characters, whatever their order."""
    def sorted_chars(x):
        return F.array_sort(F.split(t.without_whitespace(x), ""))

    return sorted_chars(a) == sorted_chars(b)


def split_cells(chars: DataFrame, anchors: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, idx, anchor): each character (idx, center) at its nearest anchor (anchor, position), lower on ties.

    A cell's anchors are few, so they ride along as one array and no product is formed.
    """
    own = anchors.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("anchor", "position"))).alias("a"))
    j = chars.join(own, keys)
    gaps = F.transform("a", lambda x: F.abs(x["position"] - F.col("center")))
    return j.select(*keys, "idx", F.element_at("a", F.array_position(gaps, F.array_min(gaps)).cast("int"))["anchor"].alias("anchor"))


def structure_signature(cells: DataFrame) -> DataFrame:
    """(table, signature): a hash of a table's grid, whatever the order or text of its cells."""
    return cells.groupBy("table").agg(F.sha2(F.to_json(F.sort_array(F.collect_list(F.struct(
        "start_row", "start_column", "end_row", "end_column")))).cast("binary"), 256).alias("signature"))
