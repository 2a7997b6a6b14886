"""Joins of boxes on pages.

A page's boxes are dealt into horizontal bands, so a crowded page is an equi-join on (page,
band) and not a product of all its boxes; a pair that shares several bands is taken in the
first of them only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions import geometry as g


def _banded(df: DataFrame, box: str, band_height: float, name: str) -> DataFrame:
    low = F.floor(F.col(f"{box}.bottom") / band_height).cast("long")
    high = F.floor(F.col(f"{box}.top") / band_height).cast("long")
    return df.withColumn(f"_{name}_low", low).withColumn("_band", F.explode(F.sequence(low, high)))


def touching_pairs(a: DataFrame, b: DataFrame, keys: list[str], a_box: str, b_box: str, band_height: float = 0.05) -> DataFrame:
    """Pairs of boxes whose open extents meet in both directions; a box without width or
    height meets the boxes that hold its place."""
    left = _banded(a, a_box, band_height, "a")
    right = _banded(b, b_box, band_height, "b")

    def meet(low: str, high: str) -> Column:
        x, y = F.col(a_box), F.col(b_box)
        open_ = (x[low] < y[high]) & (y[low] < x[high])
        flat = ((x[low] == x[high]) | (y[low] == y[high])) & (x[low] <= y[high]) & (y[low] <= x[high])
        both_flat = (x[low] == x[high]) & (y[low] == y[high])
        return F.when(both_flat, x[low] == y[low]).otherwise(open_ | flat)

    # A box has a row for each of its bands, so Spark would take either side for smaller than it is.
    joined = left.join(right.hint("merge"), [*keys, "_band"])
    return (joined.where(F.col("_band") == F.greatest("_a_low", "_b_low"))
            .where(meet("left", "right") & meet("bottom", "top")).drop("_band", "_a_low", "_b_low"))


def bounded_matches(queries: DataFrame, items: DataFrame, keys: list[str], query_id: str, item_id: str,
                    query_box: str, item_box: str, limit: int, band_height: float = 0.05) -> DataFrame:
    """At most ``limit`` meeting items of each query, the smallest ids."""
    pairs = touching_pairs(queries, items, keys, query_box, item_box, band_height)
    w = Window.partitionBy(*keys, query_id).orderBy(item_id)
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)


def best_overlap(subjects: DataFrame, others: DataFrame, keys: list[str], subject_id: str, other_id: str,
                 subject_box: str, other_box: str, lowest_id: bool = False, band_height: float = 0.05) -> DataFrame:
    """(keys, subject, other, overlap): the other that covers most of each subject.

    Ties go to the largest id, or the lowest with ``lowest_id`` (numeric ids).
    """
    pairs = touching_pairs(subjects, others, keys, subject_box, other_box, band_height)
    overlap = g.overlap_fraction(F.col(subject_box), F.col(other_box))
    tie = -F.col(other_id) if lowest_id else F.col(other_id)
    pairs = pairs.withColumn("_overlap", overlap)
    best = pairs.groupBy(*keys, subject_id).agg(
        F.max_by(other_id, F.struct("_overlap", tie.alias("tie"))).alias(other_id), F.max("_overlap").alias("overlap"))
    return best


def resolve_authority(recognised: DataFrame, embedded: DataFrame, keys: list[str], region_id: str, box: str,
                      duplicate: float = 0.60, supplement: float = 0.20) -> DataFrame:
    """What becomes of each recognised region beside embedded text of the same page.

    drop: covered by 60 % or more; review: by more than 20 %; materialise: otherwise.
    """
    others = embedded.select(*keys, F.col(region_id).alias("embedded_id"), F.col(box).alias("embedded_box"))
    best = best_overlap(recognised, others, keys, region_id, "embedded_id", box, "embedded_box")
    j = recognised.select(*keys, region_id).join(best, [*keys, region_id], "left")
    overlap = F.coalesce("overlap", F.lit(0.0))
    return j.select(*keys, region_id, "embedded_id", overlap.alias("overlap"),
                    F.when(overlap >= duplicate, "drop").when(overlap > supplement, "review").otherwise("materialise").alias("action"))


def claim_by_hints(lines: DataFrame, hints: DataFrame, keys: list[str], line_id: str, line_box: str, hint_box: str,
                   least: float = 0.50) -> DataFrame:
    """(keys, line, hint_order): the first hint (lowest order) that covers half of a line claims it."""
    pairs = touching_pairs(lines, hints, keys, line_box, hint_box)
    covered = pairs.where(g.overlap_fraction(F.col(line_box), F.col(hint_box)) >= least)
    return covered.groupBy(*keys, line_id).agg(F.min("hint_order").alias("hint_order"))


def assign_exactly_once(spans: DataFrame, cells: DataFrame, keys: list[str], span_id: str, table_id: str, cell_id: str,
                        span_box: str, cell_box: str) -> DataFrame:
    """(keys, table, accepted, spans): tables in which every span meets exactly one cell."""
    met = bounded_matches(spans, cells, keys, span_id, cell_id, span_box, cell_box, 2)
    counted = met.groupBy(*keys, table_id, span_id).agg(F.count("*").alias("n"))
    # A span that meets no cell rules its table out as well.
    per_span = spans.select(*keys, table_id, span_id).distinct().join(counted, [*keys, table_id, span_id], "left").withColumn(
        "n", F.coalesce("n", F.lit(0)))
    return per_span.groupBy(*keys, table_id).agg(F.bool_and(F.col("n") == 1).alias("accepted"), F.count("*").alias("spans"))


def without_overlap(blocks: DataFrame, others: DataFrame, keys: list[str], block_id: str, box: str) -> DataFrame:
    """Blocks that meet no other block (itself not counted)."""
    o = others.select(*keys, F.col(block_id).alias("other_id"), F.col(box).alias("other_box"))
    met = touching_pairs(blocks.select(*keys, block_id, box), o, keys, box, "other_box").where(F.col(block_id) != F.col("other_id"))
    return blocks.join(met.select(*keys, block_id).distinct().hint("merge"), [*keys, block_id], "left_anti")
