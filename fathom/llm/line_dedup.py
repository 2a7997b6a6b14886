"""Line dedup by winnowing, with DataFrame operations only.

A document is its lines (split at \\n). Of every ``run_lines`` consecutive line
hashes the position of the smallest is a fingerprint, emitted once with the windows that
chose it; two equal runs of that length choose the same place, so they share one.
Fingerprints whose line occurs at two or more chosen positions are joined: the windows
around each (128 bits of their lines' hashes) with the first position (smallest doc_id,
then line) of the same window. Matches are extended both ways along their diagonal
(the same two documents and distance) as long as the next window matches too, and the
maximal runs that start later than their first are deleted.

Keys are aggregated map-side before every shuffle. Lines and windows that are very
frequent are too few to be large: they are broadcast, and their rows are not shuffled.

Edge cases: null text is one empty line; runs of blank lines only are never matched;
documents under ``run_lines`` lines stay whole, very long ones are cut in one pass over
their lines; overlapping matches are merged; rows with the same doc_id and text are
judged as one document and share its result; null doc_ids come last; extra columns pass
through; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, join_counted


def fingerprints(docs: DataFrame, run_lines: int = 3) -> DataFrame:
    """(doc, at, low, runs): each chosen position once, and the windows that chose it.

    doc is (last, id, hash), at the line from 0, low its line's hash; a run has its
    first line's number and two hashes of its lines.
    """
    lines = docs.select(
        F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"),
                 F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash")).alias("doc"),
        F.split(F.coalesce("text", F.lit("")), "\n").alias("lines")).where(F.size("lines") >= run_lines)
    lines = lines.select("doc", F.expr("transform(lines, l -> xxhash64(l))").alias("h"),
                         F.expr("transform(lines, l -> xxhash64(l, 7))").alias("g"),
                         F.expr("transform(lines, l -> trim(l) = '')").alias("blank"))
    low = f"array_min(slice(h, i + 1, {run_lines}))"
    windows = lines.select("doc", "h", F.expr(f"""transform(sequence(0, size(h) - {run_lines}), i -> named_struct(
        'start', i, 'at', cast(i + array_position(slice(h, i + 1, {run_lines}), {low}) - 1 as int),
        'a', xxhash64(slice(h, i + 1, {run_lines})), 'b', xxhash64(slice(g, i + 1, {run_lines})),
        'blank', forall(slice(blank, i + 1, {run_lines}), b -> b)))""").alias("w"))
    # The windows that chose a position start at most run_lines - 1 before it.
    chosen = windows.select("doc", F.explode(F.expr(f"""transform(array_distinct(transform(w, x -> x.at)), p -> named_struct(
        'at', p, 'low', h[p], 'runs', transform(filter(
          slice(w, greatest(p - {run_lines - 1}, 0) + 1, {run_lines}), x -> x.at = p AND NOT x.blank),
          x -> named_struct('start', x.start, 'a', x.a, 'b', x.b))))""")).alias("f"))
    return chosen.select("doc", "f.at", "f.low", "f.runs").where(F.size("runs") > 0)


def later_runs(docs: DataFrame, run_lines: int = 3, scratch: Scratch | None = None) -> DataFrame:
    """(where, first): every window that starts later than another one of the same lines.

    Both are positions: doc (last, id, hash) and at, the line from 0.
    """
    scratch = scratch or Scratch(docs.sparkSession, "lines")
    found = scratch.save(fingerprints(docs, run_lines), "fingerprints")
    shared = scratch.save(found.groupBy("low").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    total = shared.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    runs = join_counted(found, shared, ["low"], total).select("doc", F.explode("runs").alias("r"))
    runs = scratch.save(runs.select("r.a", "r.b", F.struct("doc", F.col("r.start").alias("at")).alias("where")), "windows")
    first = runs.groupBy("a", "b").agg(F.min("where").alias("first"), F.count("*").alias("n")).where("n > 1")
    first = scratch.save(first, "first")
    total = first.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    later = join_counted(runs, first, ["a", "b"], total)
    return later.where(F.col("where") > F.col("first")).select("where", "first")


def matched_runs(docs: DataFrame, run_lines: int = 3, scratch: Scratch | None = None) -> DataFrame:
    """(doc, id, start, lines, first_id, first_start): later runs extended both ways.

    A match of a window grows to the left and to the right on its diagonal (the same
    two documents and distance) while the next window matches there as well.
    """
    later = later_runs(docs, run_lines, scratch).select(
        "where.doc", "where.at", F.col("first.doc").alias("other"), F.col("first.at").alias("from"))
    diagonal = Window.partitionBy("doc", "other", "diagonal").orderBy("at")
    later = later.withColumn("diagonal", F.col("at") - F.col("from"))
    later = later.withColumn("island", F.col("at") - F.row_number().over(diagonal))
    return later.groupBy("doc", "other", "diagonal", "island").agg(
        F.min("at").alias("start"), (F.count("*") + run_lines - 1).cast("int").alias("lines"), F.min("from").alias("first_start")
    ).select("doc", F.col("doc.id").alias("id"), "start", "lines", F.col("other.id").alias("first_id"), "first_start")


def cuts(matches: DataFrame) -> DataFrame:
    """(doc, cuts): each document's matched runs as disjoint (start, end), in order."""
    ends = F.col("start") + F.col("lines")
    before = Window.partitionBy("doc").orderBy("start", "lines").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("doc").orderBy("start", "lines").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    new = F.coalesce(F.col("start") > F.max(ends).over(before), F.lit(True))
    islands = matches.withColumn("new", new.cast("int")).withColumn("island", F.sum("new").over(upto))
    islands = islands.groupBy("doc", "island").agg(F.min("start").alias("start"), F.max(ends).alias("end"))
    return islands.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"))


def delete_repeated_lines(docs: DataFrame, run_lines: int = 3) -> DataFrame:
    """``docs`` with its columns, text without later repeated runs, and two counts.

    Added: n_lines and n_removed. A document of repeated lines alone gets an empty text.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    gone = cuts(matched_runs(docs, run_lines, scratch)).select(
        F.col("doc.id").alias("_fathom_id"), F.col("doc.hash").alias("_fathom_hash"), F.col("cuts").alias("_fathom_cuts"))
    gone = scratch.save(gone, "cuts")
    scratch.drop("fingerprints", "shared", "windows", "first")
    text = F.coalesce("text", F.lit(""))
    # The cuts grow with the corpus: a merge at every size.
    joined = docs.join(gone.hint("merge"), docs["doc_id"].eqNullSafe(F.col("_fathom_id")) & (F.xxhash64(text) == F.col("_fathom_hash")), "left")
    lines = F.split(text, "\n")
    joined = joined.withColumn("_fathom_lines", lines)
    kept = F.when(F.col("_fathom_cuts").isNull(), text).otherwise(F.expr("""array_join(flatten(transform(
        sequence(0, size(_fathom_cuts)), i -> slice(_fathom_lines,
          CASE WHEN i = 0 THEN 1 ELSE _fathom_cuts[i - 1].end + 1 END,
          CASE WHEN i = size(_fathom_cuts) THEN size(_fathom_lines) ELSE _fathom_cuts[i].start END
            - CASE WHEN i = 0 THEN 0 ELSE _fathom_cuts[i - 1].end END))), '\\n')"""))
    removed = F.expr("aggregate(_fathom_cuts, 0, (n, c) -> n + c.end - c.start)")
    return joined.select(*[c for c in docs.columns if c not in ("text", "n_lines", "n_removed")], kept.alias("text"),
                         F.size("_fathom_lines").cast("long").alias("n_lines"),
                         F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = delete_repeated_lines(docs)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
w AS (SELECT doc_id, l, unnest(range(0, len(l) - 2)) AS pos FROM d),
r AS (SELECT doc_id, pos, md5(array_to_string(l[pos + 1:pos + 3], chr(10))) AS run FROM w
  WHERE NOT (trim(l[pos + 1], ' ') = '' AND trim(l[pos + 2], ' ') = '' AND trim(l[pos + 3], ' ') = '')),
x AS (SELECT doc_id, pos FROM (SELECT doc_id, pos,
  row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS n FROM r) WHERE n > 1),
g AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 3)) AS pos FROM x),
s AS (SELECT doc_id, list(pos) AS gone FROM g GROUP BY doc_id)
SELECT d.doc_id, len(l)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN l
    ELSE [l[i + 1] FOR i IN range(0, len(l)) IF NOT list_contains(gone, i)] END, chr(10))) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)
"""
