"""Tables out of positioned lines, and tables that a structure hint proves.

Keys are doc and block (a table's number in its document). Cells: start_row, end_row,
start_column, end_column (ends exclusive), text, header. A document's lines of one table are bounded by
its pages, and its anchors ride along as one array.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathom.functions import text as t
from fathom.operators import canonical, layout, spatial
from fathom.operators.sequences import top_rows
from fathom.session import ship_package

KEYS = ["doc", "block"]
GRID = ["start_row", "end_row", "start_column", "end_column"]
# Scores of table candidates and how far a line may miss the next column.
GEOMETRY_SCORE, PROVEN_SCORE, FRAGMENTED_SCORE, SPAN_SLACK = 0.82, 1.0, 0.94, 0.02
MOST_CANDIDATES = 5


def _gathered(cells: DataFrame, *more: str) -> DataFrame:
    """(doc, block, cells, row_count, column_count, sound) of every table, in one aggregation.

    Sound: all cells have an extent, none starts before 0, none overlaps another, and the grid's limits hold.
    """
    g = cells.groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct(*GRID, *more))).alias("cells"), F.min(F.least("start_row", "start_column")).alias("_least"),
                                 F.min(F.least(F.col("end_row") - F.col("start_row"), F.col("end_column") - F.col("start_column"))).alias("_extent"),
                                 F.max("end_row").alias("row_count"), F.max("end_column").alias("column_count"))
    fits = ((F.col("_least") >= 0) & (F.col("_extent") > 0) & (F.col("row_count") <= canonical.MOST_ROWS) & (F.col("column_count") <= canonical.MOST_COLUMNS)
            & (F.col("row_count") * F.col("column_count") <= canonical.MOST_AREA))
    area = "aggregate(cells, 0L, (n, c) -> n + (c.end_row - c.start_row) * (c.end_column - c.start_column))"
    # Overlapping cells may unroll to more places than the grid has; their areas say so first.
    places = """size(array_distinct(flatten(transform(cells, c -> flatten(transform(sequence(c.start_row, c.end_row - 1), r ->
        transform(sequence(c.start_column, c.end_column - 1), k -> cast(r as long) * column_count + k)))))))"""
    sound = F.when(fits, F.expr(f"CASE WHEN {area} <= row_count * column_count THEN {area} = {places} ELSE false END")).otherwise(False)
    return g.withColumn("sound", sound).drop("_least", "_extent")


def sound_tables(cells: DataFrame) -> DataFrame:
    """(doc, block) whose cells fit their grid without overlap; gaps are filled, so they do no harm."""
    return _gathered(cells).where("sound").select(*KEYS)


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _anchors(lefts: pd.Series) -> pd.Series:
    return lefts.map(layout.anchor_positions)


def geometry_cells(lines: DataFrame) -> DataFrame:
    """Cells of tables by the places of their lines (doc, block, first, box, text).

    Lines whose heights overlap are a row; a line starts at the column anchor nearest to its left
    edge (the lower on ties) and spans all anchors left of its right edge. Lines of one place are one cell.
    """
    ship_package(lines.sparkSession)
    rows = layout.row_groups(lines, KEYS)
    line = F.struct(F.col("row_group").cast("int").alias("row"), (-F.col("box.top")).alias("t"), F.col("box.left").alias("l"), F.col("box.right").alias("r"),
                    "first", t.trimmed(F.col("text")).alias("v"))
    tables = rows.groupBy(*KEYS).agg(F.collect_list(line).alias("lines")).withColumn("at", _anchors(F.transform("lines", lambda x: x["l"])))
    spanned = F.expr(f"""transform(lines, x -> named_struct('line', x,
        'k', cast(array_position(transform(at, p -> abs(p - x.l)), array_min(transform(at, p -> abs(p - x.l)))) as int) - 1,
        'e', size(filter(at, p -> p < x.r - {SPAN_SLACK}))))""")
    each = tables.select(*KEYS, F.explode(spanned).alias("x")).select(*KEYS, "x.line.*", "x.k", "x.e")
    return each.groupBy(*KEYS, F.col("row").alias("start_row"), (F.col("row") + 1).alias("end_row"), F.col("k").alias("start_column"),
                        F.greatest(F.col("k") + 1, "e").alias("end_column")).agg(F.array_join(F.transform(
                            F.sort_array(F.collect_list(F.struct("t", "l", "first", "v"))), lambda x: x["v"]), "\n").alias("text")).withColumn(
                                "header", F.col("start_row") == 0)


def markdown(cells: DataFrame) -> DataFrame:
    """(doc, block, markdown) of sound tables; places without a cell are empty, spanned values repeat.

    The first row that holds a header cell heads the table; without one the head is blank.
    """
    c = cells.withColumn("shown", t.escape_table_value(F.coalesce("text", F.lit(""))))
    g = _gathered(c, "shown", "header").where("sound")
    rows = F.expr("""transform(sequence(0, row_count - 1), r -> concat('| ', array_join(transform(sequence(0, column_count - 1), k ->
        coalesce(get(filter(cells, c -> c.start_row <= r AND r < c.end_row AND c.start_column <= k AND k < c.end_column), 0).shown, '')), ' | '), ' |'))""")
    g = g.withColumn("rows", rows).withColumn("head", F.expr("array_min(transform(filter(cells, c -> c.header), c -> c.start_row))"))
    rest = F.expr("array_join(filter(rows, (x, i) -> head IS NULL OR i <> head), '\\n')")
    top = F.coalesce(F.expr("get(rows, head)"), F.concat(F.lit("|"), F.expr("repeat('  |', column_count)")))
    rule = F.concat(F.lit("|"), F.expr("repeat(' --- |', column_count)"))
    return g.select(*KEYS, F.concat_ws("\n", top, rule, F.when(rest != "", rest)).alias("markdown"))


def proven_tables(atoms: DataFrame, hints: DataFrame) -> DataFrame:
    """(doc, block, score) of hinted tables that their characters prove.

    ``atoms``: doc, block, ordinal, text, box. ``hints``: doc, block, cell (a number), grid places, box, text.
    Every visible character lies in some hinted cell (the one it shares most with, the first on ties), and each cell's
    characters are those of its text, whatever their order. The score is lower if a text has broken-up words.
    What is unrolled into characters or gathered from them is merged, never broadcast.
    """
    visible = atoms.where(F.length(t.without_whitespace(F.col("text"))) > 0).select(*KEYS, "ordinal", "text", "box")
    boxes = hints.where("box IS NOT NULL").select(*KEYS, "cell", F.col("box").alias("cell_box"))
    place = spatial.best_overlap(visible.where("box IS NOT NULL"), boxes, KEYS, "ordinal", "cell", "box", "cell_box", lowest_id=True).where("overlap > 0")
    placed = visible.drop("box").join(place.select(*KEYS, "ordinal", "cell").hint("merge"), [*KEYS, "ordinal"], "left")
    inside = placed.groupBy(*KEYS, "cell").agg(F.array_join(F.sort_array(F.collect_list("text")), "").alias("held"))
    lost = inside.where("cell IS NULL").select(*KEYS)
    j = hints.select(*KEYS, "cell", "text").join(inside.hint("merge"), [*KEYS, "cell"], "left")
    wanted = F.array_join(F.array_sort(F.split(t.without_whitespace(F.coalesce("text", F.lit(""))), "")), "")
    same = wanted == F.coalesce("held", F.lit(""))
    judged = j.groupBy(*KEYS).agg(F.bool_and(same).alias("same"), F.bool_or(F.coalesce(t.fragmented(F.col("text")), F.lit(False))).alias("broken"))
    fit = judged.where("same").join(lost, KEYS, "left_anti").join(sound_tables(hints), KEYS, "left_semi")
    return fit.select(*KEYS, F.when(F.col("broken"), FRAGMENTED_SCORE).otherwise(PROVEN_SCORE).alias("score"))


def table_candidates(geometry: DataFrame, proven: DataFrame) -> DataFrame:
    """(doc, block, kind, score, proven, rank): sound tables by their geometry, and proven ones, best first.

    ``geometry``: cells as of :func:`geometry_cells`. ``proven``: as of :func:`proven_tables`.
    """
    shaped = sound_tables(geometry).select(
        *KEYS, F.lit("geometry").alias("kind"), F.lit(GEOMETRY_SCORE).alias("score"), F.lit(False).alias("proven"))
    shown = proven.select(*KEYS, F.lit("hint").alias("kind"), "score", F.lit(True).alias("proven"))
    return top_rows(shaped.unionByName(shown), KEYS, [F.col("score").desc(), "kind"], MOST_CANDIDATES)

