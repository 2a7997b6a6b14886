"""Window-shaped operators: islands, fills, interval merges, top rows, majorities.

Each partitions by its own entity key and orders by a total order, so one shuffle serves a
whole chain of them on the same key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _by(keys: list[str], order: list) -> Window:
    return Window.partitionBy(*keys).orderBy(*order)


def islands(df: DataFrame, keys: list[str], order: list, starts: Column, name: str = "island") -> DataFrame:
    """Numbers runs of rows; a row for which ``starts`` is true opens a new run (from 0)."""
    w = _by(keys, order)
    # row_number and the running sum share the window's sort.
    df = df.withColumn("_opens", F.when(F.coalesce(starts, F.lit(False)) & (F.row_number().over(w) > 1), 1).otherwise(0))
    return df.withColumn(name, F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_opens")


def equal_runs(df: DataFrame, keys: list[str], order: list, value: str, name: str = "run") -> DataFrame:
    """Numbers runs of equal neighbouring values; nulls equal each other."""
    w = _by(keys, order)
    marked = df.withColumn("_same", F.lag(value).over(w).eqNullSafe(F.col(value)) & (F.row_number().over(w) > 1))
    return islands(marked, keys, order, ~F.col("_same"), name).drop("_same")


def contiguous_runs(df: DataFrame, keys: list[str], ordinal: str, name: str = "run") -> DataFrame:
    """Rows of consecutive ordinals share a run, named by ordinal minus row number."""
    return df.withColumn(name, F.col(ordinal) - F.row_number().over(_by(keys, [ordinal])))


def fill_forward(df: DataFrame, keys: list[str], order: list, value: str, name: str) -> DataFrame:
    """The last non-null value so far, the first one for leading nulls."""
    w = _by(keys, order)
    back = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ahead = F.first(value, ignorenulls=True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return df.withColumn(name, F.coalesce(back, ahead))


def nearest_value(df: DataFrame, keys: list[str], order: str, value: str, name: str) -> DataFrame:
    """The nearest non-null value by ``order``; the earlier one on ties."""
    w = _by(keys, [order])
    had = F.when(F.col(value).isNotNull(), F.struct(F.col(order).alias("o"), F.col(value).alias("v")))
    back = F.last(had, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ahead = F.first(had, ignorenulls=True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    df = df.withColumn("_back", back).withColumn("_ahead", ahead)
    closer = F.col("_ahead.o") - F.col(order) < F.col(order) - F.col("_back.o")
    pick = F.when(F.col("_back").isNull() | closer, F.col("_ahead.v")).otherwise(F.col("_back.v"))
    return df.withColumn(name, pick).drop("_back", "_ahead")


def merge_intervals(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Overlapping or touching closed intervals merged: keys, start, end, members."""
    w = _by(keys, [start, end])
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("_reach", reach)
    numbered = islands(marked, keys, [start, end], F.col(start) > F.col("_reach"))
    return numbered.groupBy(*keys, "island").agg(
        F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("members")).drop("island")


def top_rows(df: DataFrame, keys: list[str], order: list, limit: int = 5, name: str = "rank") -> DataFrame:
    """The first ``limit`` rows of each group; Spark pushes the limit below the shuffle."""
    return df.withColumn(name, F.row_number().over(_by(keys, order))).where(F.col(name) <= limit)


def successor_edges(df: DataFrame, keys: list[str], order: list, ident: str, page: str, column: str) -> DataFrame:
    """(keys, before, after, reason) along an order: next_page, next_column or same_column."""
    w = _by(keys, order)
    e = df.select(*keys, F.col(ident).alias("before"), F.lead(ident).over(w).alias("after"),
                  F.when(F.lead(page).over(w) != F.col(page), "next_page")
                  .when(F.lead(column).over(w) != F.col(column), "next_column").otherwise("same_column").alias("reason"))
    return e.where("after IS NOT NULL")


def majority(votes: DataFrame, keys: list[str], choice: str, confidence: str, least: float = 0.8, consensus: int = 2) -> DataFrame:
    """(keys, choice, votes) where at least ``consensus`` confident votes agree; most votes win."""
    sure = votes.where(F.col(confidence) >= least).groupBy(*keys, choice).agg(F.count("*").alias("votes"))
    sure = sure.where(F.col("votes") >= consensus)
    return top_rows(sure, keys, [F.col("votes").desc(), choice], 1).drop("rank")


def adjacent_pairs(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Rows joined with the row of the next position of their entity, as a.* and b.*."""
    a, b = df.alias("a"), df.alias("b")
    cond = F.col(f"b.{position}") == F.col(f"a.{position}") + 1
    for k in keys:
        cond = cond & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    return a.join(b, cond)


def repeated_edges(regions: DataFrame, doc: str, page: str, edge: str, text: str, pages: str, ratio: float = 0.6) -> DataFrame:
    """(doc, edge, text) seen at an edge on at least ``ratio`` of a document's pages."""
    seen = regions.groupBy(doc, edge, text).agg(F.count_distinct(page).alias("seen"), F.max(pages).alias("pages"))
    return seen.where(F.col("seen") >= F.col("pages") * ratio)


def order_is_valid(orders: DataFrame, regions: DataFrame, edges: DataFrame, doc: str) -> DataFrame:
    """(doc, valid): whether an order names each region once and respects every edge."""
    extent = orders.groupBy(doc).agg(F.count("*").alias("n"), F.count_distinct("region").alias("d"),
                                     F.min("position").alias("low"), F.max("position").alias("high"))
    named = regions.groupBy(doc).agg(F.count("*").alias("regions"))
    strange = orders.join(regions, [doc, "region"], "left_anti").groupBy(doc).agg(F.count("*").alias("unknown"))
    at = orders.select(doc, "region", "position")
    broken = (edges.join(at.withColumnsRenamed({"region": "before", "position": "p"}), [doc, "before"])
              .join(at.withColumnsRenamed({"region": "after", "position": "q"}), [doc, "after"])
              .where("q <= p").groupBy(doc).agg(F.count("*").alias("broken")))
    j = named.join(extent, doc, "left").join(strange, doc, "left").join(broken, doc, "left")
    valid = (F.coalesce(F.col("n"), F.lit(0)) == F.col("regions")) & (F.col("d") == F.col("n")) & F.col("unknown").isNull() & F.col("broken").isNull()
    return j.select(doc, F.coalesce(valid, F.lit(False)).alias("valid"))


def next_free(df: DataFrame, keys: list[str], wanted: str, tie: str, name: str = "slot") -> DataFrame:
    """Slots for wanted orders: the wanted one for its first taker, the others behind the highest."""
    w = _by([*keys, wanted], [tie])
    marked = df.withColumn("_first", (F.row_number().over(w) == 1) & F.col(wanted).isNotNull())
    top = F.max(wanted).over(Window.partitionBy(*keys))
    behind = _by([*keys, "_first"], [wanted, tie])
    return marked.withColumn("_top", top).withColumn(
        name, F.when(F.col("_first"), F.col(wanted))
        .otherwise(F.coalesce(F.col("_top"), F.lit(0)) + F.row_number().over(behind))).drop("_first", "_top")
