"""Candidates, their scores, and the deterministic part of the decision policy.

A candidate row: doc, region, kind, candidate_id, score, and features as a map. Scores are
sums of weighted features; the weights are fixed values of the rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions import text as t
from fathom.functions.ids import content_id
from fathom.operators.sequences import top_rows

# Limits and patterns of the rules.
MOST_CANDIDATES = 5
AUTO_SCORE, AUTO_MARGIN = 0.82, 0.12
LEAST_CONFIDENCE, CONSENSUS = 0.80, 2
HEADING_NUMBER = r"^\s*(\d+(?:\.\d+)*)(?:[.)]|\s)"
ORDERED_ITEM = r"^(\s*)(?:\d+[.)]|[a-zA-Z][.)])\s+"
UNORDERED_ITEM = r"^(\s*)[-*•▪◦]\s+"
CAPTION = r"(?i)^\s*(?:그림|표|사진|도표|figure|table)\s*\d+"
TERMINAL = r"[.!?。！？다요음임함됨)]$"


def block_features(text: Column, line_height: Column, typical_height: Column, hint: Column) -> dict[str, Column]:
    """The eleven features of a block, each 0 or 1."""
    end = t.trimmed(text)
    flags = {
        "numbered_heading": text.rlike(HEADING_NUMBER), "ordered_list": text.rlike(ORDERED_ITEM),
        "unordered_list": text.rlike(UNORDERED_ITEM), "caption_shape": text.rlike(CAPTION),
        "short_text": F.char_length(end) <= 48, "terminal_punctuation": end.rlike(TERMINAL),
        "large_geometry": (typical_height > 0) & (line_height >= typical_height * 1.25),
        "heading_hint": hint == "heading", "paragraph_hint": hint == "paragraph", "table_hint": hint == "table",
        "list_hint": hint == "list_item"}
    return {k: F.coalesce(v, F.lit(False)).cast("double") for k, v in flags.items()}


def block_candidates(blocks: DataFrame) -> DataFrame:
    """Scored alternatives of each block, at most five, best first.

    ``blocks``: doc, region, text, line_height, typical_height, hint. Returns doc, region, kind,
    score, rank.
    """
    f = block_features(F.col("text"), F.col("line_height"), F.col("typical_height"), F.col("hint"))
    listed = F.greatest(f["ordered_list"], f["unordered_list"])
    paragraph = (F.lit(0.78) + (1 - f["short_text"]) * 0.10 + f["terminal_punctuation"] * 0.08 + f["paragraph_hint"] * 0.04
                 - f["table_hint"] * 0.12 - f["heading_hint"] * 0.08)
    heading = (F.lit(0.44) + f["numbered_heading"] * 0.45 + f["large_geometry"] * 0.12 + f["heading_hint"] * 0.44
               + f["short_text"] * 0.04 - f["terminal_punctuation"] * 0.30)
    item = F.lit(0.72) + listed * 0.20 + f["list_hint"] * 0.04 - f["heading_hint"] * 0.20

    def option(kind: str, score: Column, when: Column | None) -> Column:
        row = F.struct(F.lit(kind).alias("kind"), F.round(F.least(F.lit(0.96) if kind != "table" else F.lit(0.98), score), 6).alias("score"))
        return row if when is None else F.when(when, row)

    options = F.array_compact(F.array(
        option("paragraph", paragraph, None),
        option("heading", heading, (f["numbered_heading"] + f["heading_hint"] + f["large_geometry"]) > 0),
        option("list_item", item, (listed + f["list_hint"]) > 0),
        option("caption", F.lit(0.90), f["caption_shape"] > 0),
        option("table", F.lit(0.98), f["table_hint"] > 0)))
    rows = blocks.select("doc", "region", F.explode(options).alias("o")).select("doc", "region", "o.kind", "o.score")
    return top_rows(rows, ["doc", "region"], [F.col("score").desc(), "kind"], MOST_CANDIDATES)


# Scores of spacing proposals by where they come from.
PROPOSAL_SCORES = {"source_spacing": 0.45, "geometry_spacing": 0.62, "punctuation_rules": 0.70, "dense_text": 0.20,
                   "language_spacing": 0.88}


def spacing_candidates(proposals: DataFrame) -> DataFrame:
    """Spacing candidates of each region, at most five, best first.

    ``proposals``: doc, region, source_text, feature, text. Equal texts are one candidate whose
    score is its best source's, 0.04 more for each further source, at most 0.99. Texts
    whose visible characters differ from the source's are left out.
    """
    scores = F.create_map(*[F.lit(x) for kv in PROPOSAL_SCORES.items() for x in kv])
    p = proposals.withColumn("text", t.canonical_whitespace(F.col("text"))).where("text <> ''")
    p = p.where(t.without_whitespace(F.col("text")) == t.without_whitespace(F.col("source_text")))
    c = p.groupBy("doc", "region", "text").agg(
        F.max(scores[F.col("feature")]).alias("best"), F.count_distinct("feature").alias("agree"),
        F.bool_or(F.col("feature") == "source_spacing").alias("from_source"))
    c = c.withColumn("score", F.round(F.least(F.lit(0.99), F.col("best") + (F.col("agree") - 1) * 0.04), 6))
    c = c.withColumn("candidate_id", content_id("candidate", F.col("region"), F.col("text")))
    return top_rows(c.drop("best", "agree"), ["doc", "region"], [F.col("score").desc(), "candidate_id"], MOST_CANDIDATES)


def language_cells(cells: DataFrame, proposals: DataFrame) -> DataFrame:
    """(table, cell, text, changed): cells with their language-repaired text.

    Only cells with a lone syllable are repaired, by the first proposal (table, cell, position,
    text) that has the same visible characters and differs.
    """
    p = proposals.select("table", "cell", "position", F.col("text").alias("proposed"))
    j = cells.join(p, ["table", "cell"], "left")
    fits = (t.without_whitespace(F.col("proposed")) == t.without_whitespace(F.col("text"))) & (F.col("proposed") != F.col("text")) & t.lone_syllable(F.col("text"))
    best = j.groupBy("table", "cell").agg(F.first("text").alias("text"), F.min_by("proposed", F.when(fits, F.col("position"))).alias("repaired"))
    return best.select("table", "cell", F.coalesce("repaired", "text").alias("text"), F.col("repaired").isNotNull().alias("changed"))


def fallback_candidates(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """The safest spacing candidate of a set: no defects, the source's spacing first, then score."""
    clean = candidates.where(F.size(t.spacing_defects(F.col("text"))) == 0)
    return top_rows(clean, keys, [F.col("from_source").desc(), F.col("score").desc(), F.col("candidate_id").desc()], 1).drop("rank")


def decide(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """The policy's deterministic outcome of every candidate set.

    ``candidates``: keys, candidate_id, score, proven (all invariants hold), signature, defects
    (a count). Proven tables of one signature win; then the best candidate if it is good
    enough, far enough ahead and without defects; otherwise the set is deferred with
    the best one as its fallback. Returns keys, outcome, candidate_id, confidence.
    """
    proven = candidates.where("proven").groupBy(*keys).agg(
        F.count_distinct("signature").alias("signatures"), F.max_by("candidate_id", F.struct("score", "candidate_id")).alias("proven_id"))
    w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "candidate_id")
    ranked = candidates.withColumn("_n", F.row_number().over(w)).withColumn(
        "_next", F.coalesce(F.lead("score").over(w), F.lit(0.0)))
    best = ranked.where("_n = 1").select(*keys, "candidate_id", "score", "_next", "defects")
    j = best.join(proven, keys, "left")
    shown = F.col("signatures") == 1
    sure = ((F.col("score") >= AUTO_SCORE) & (F.round(F.col("score") - F.col("_next"), 9) >= AUTO_MARGIN) & (F.col("defects") == 0))
    return j.select(*keys, F.when(shown | sure, "selected").otherwise("deferred").alias("outcome"),
                    F.when(shown, F.col("proven_id")).otherwise(F.col("candidate_id")).alias("candidate_id"),
                    F.when(shown, 1.0).otherwise(F.col("score")).alias("confidence"))


def trusted_matches(decisions: DataFrame, sets: DataFrame) -> DataFrame:
    """Cached decisions that still hold: equal on all identifying hashes and keys."""
    keys = ["request_hash", "source_hash", "evidence_hash", "candidate_set_id", "region", "provider", "model"]
    offered = sets.select(*keys, F.explode("candidate_ids").alias("candidate_id"))
    return decisions.where(F.col("confidence") >= LEAST_CONFIDENCE).join(offered, [*keys, "candidate_id"], "left_semi")


def selected_or_best(sets: DataFrame, decisions: DataFrame, keys: list[str]) -> DataFrame:
    """The decided candidate of each set; without a decision its best by score, then id."""
    best = sets.groupBy(*keys).agg(F.max_by("candidate_id", F.struct("score", "candidate_id")).alias("best_id"))
    return best.join(decisions.select(*keys, F.col("candidate_id").alias("chosen")), keys, "left").select(
        *keys, F.coalesce("chosen", "best_id").alias("candidate_id"))


def table_is_proven(features: Column) -> Column:
    """All three invariant features of a table candidate are 1."""
    names = ("atoms_complete", "cells_match", "grid_complete")
    out = F.lit(True)
    for n in names:
        out = out & (F.coalesce(features[n], F.lit(0.0)) == 1.0)
    return out
