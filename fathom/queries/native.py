"""Declared tables against blocks, dispositions, evidence, patches and recovered decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions import geometry as g
from fathom.functions.text import WHITE
from fathom.operators import audits as a
from fathom.operators import native_tables as n
from fathom.operators import repair, tables

from .base import Registry, table

R = Registry()
QUERIES, ORACLE_SQL = R.queries, R.sql

CELL = "struct(cast({row} as int) AS start_row, {spans} AS spans, {header} AS header)"
NO_SPANS = "cast(array() as array<string>)"


def _turns(spark, sf):
    """A conversation as a document, its turns as spans s0, s1, ..."""
    c = table(spark, sf, "conversations")
    return c.select(F.col("conv_id").alias("doc"), F.col("turn").alias("ordinal"), F.concat(F.lit("s"), F.col("turn").cast("string")).alias("span"))


def _declared(spark, sf):
    """One table of two cells a document: turns 0 and 1, or, for every sixth, turn 0 twice removed from its neighbour;
    and, for every fourth, a table without text."""
    docs = _turns(spark, sf).groupBy("doc").agg(F.max("ordinal").alias("top"))
    far = "CASE WHEN doc % 6 = 4 THEN concat('s', cast(top as string)) ELSE 's1' END"
    cells = F.expr(f"array({CELL.format(row=0, spans="array('s0')", header='true')}, {CELL.format(row=1, spans=f'array({far})', header='false')})")
    first = docs.select("doc", F.lit(0).cast("long").alias("table"), F.lit(2).alias("row_count"), F.lit(1).alias("column_count"), cells.alias("cells"))
    blank = F.expr(f"array({CELL.format(row=0, spans=NO_SPANS, header='false')})")
    second = docs.where("doc % 4 = 0").select("doc", F.lit(100).cast("long").alias("table"), F.lit(1).alias("row_count"), F.lit(1).alias("column_count"), blank.alias("cells"))
    return first.unionByName(second)


def _blocks(spark, sf):
    """Turns 0 and 1 as: the declared table (0, 4), one with another header (1), a paragraph each (2), a lossless block
    (3), the table and a paragraph that claims its second turn too (5); a paragraph for every later turn; a blank
    table for every eighth document."""
    t = _turns(spark, sf)
    docs = t.groupBy("doc").agg(F.max("ordinal").alias("top"))
    none = F.expr(NO_SPANS)
    no_cells = F.expr("cast(null as array<struct<start_row:int,spans:array<string>,header:boolean>>)")
    no_count = F.lit(None).cast("int")
    cells = F.expr(f"array({CELL.format(row=0, spans="array('s0')", header='doc % 6 <> 1')}, {CELL.format(row=1, spans="array('s1')", header='false')})")
    grid = docs.where("doc % 6 IN (0, 1, 4, 5)").select("doc", F.lit(0).cast("long").alias("order"), F.lit("table").alias("kind"), F.lit(2).alias("row_count"),
                                                        F.lit(1).alias("column_count"), cells.alias("cells"), none.alias("spans"))
    single = t.where("ordinal >= 2 OR doc % 6 = 2 OR (doc % 6 = 5 AND ordinal = 1)").select(
        "doc", F.col("ordinal").alias("order"), F.lit("paragraph").alias("kind"), no_count.alias("row_count"), no_count.alias("column_count"),
        no_cells.alias("cells"), F.array("span").alias("spans"))
    whole = docs.where("doc % 6 = 3").select("doc", F.lit(0).cast("long").alias("order"), F.lit("lossless").alias("kind"), no_count.alias("row_count"),
                                             no_count.alias("column_count"), no_cells.alias("cells"), F.array(F.lit("s0"), F.lit("s1")).alias("spans"))
    blank = docs.where("doc % 8 = 0").select("doc", F.lit(100).cast("long").alias("order"), F.lit("table").alias("kind"), F.lit(1).alias("row_count"), F.lit(1).alias("column_count"),
                                             F.expr(f"array({CELL.format(row=0, spans=NO_SPANS, header='false')})").alias("cells"), none.alias("spans"))
    return grid.unionByName(single).unionByName(whole).unionByName(blank)


@R.add("""WITH d AS (SELECT conv_id AS doc, max(turn) AS top FROM conversations GROUP BY 1),
  b AS (SELECT doc, 0 AS pos, CASE WHEN doc % 6 = 0 OR (doc % 6 = 4 AND top = 1) THEN 'table' ELSE 'lossless' END AS kind,
      CASE WHEN doc % 6 = 4 THEN (SELECT string_agg('s' || turn, ',' ORDER BY turn) FROM conversations c WHERE c.conv_id = doc) ELSE 's0,s1' END AS spans FROM d
    UNION ALL SELECT conv_id, turn, 'paragraph', 's' || turn FROM conversations WHERE turn >= 2 AND conv_id % 6 <> 4
    UNION ALL SELECT doc, 101, 'table', '' FROM d WHERE doc % 4 = 0)
SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY pos) - 1 AS "order", kind, spans FROM b""")
def native_tables_enforced(spark, sf):
    """Blocks after declared tables won."""
    t = _turns(spark, sf)
    out = n.enforce(_declared(spark, sf), _blocks(spark, sf), t, t.limit(0).select("doc", "span")).blocks
    return out.select("doc", F.col("order").cast("long").alias("order"), "kind", F.array_join("spans", ",").alias("spans"))


@R.add("""SELECT conv_id AS doc, 's' || turn AS span FROM conversations JOIN (SELECT conv_id AS d, max(turn) AS top FROM conversations GROUP BY 1) ON d = conv_id
WHERE turn % 2 = 1 AND CASE WHEN conv_id % 6 = 4 THEN top = 1 ELSE turn >= 2 OR conv_id % 6 IN (0, 3) END""")
def native_exclusions_left(spark, sf):
    """Exclusions of every second span, but for those in places that lossless blocks took."""
    t = _turns(spark, sf)
    return n.enforce(_declared(spark, sf), _blocks(spark, sf), t, t.where("ordinal % 2 = 1").select("doc", "span")).excluded


@R.add("""SELECT conv_id AS doc, 0::BIGINT AS "table", 1 AS "first", CASE WHEN conv_id % 6 = 4 THEN max(turn) + 1 ELSE 2 END AS "last",
  conv_id % 6 = 4 AND max(turn) > 1 AS crossing FROM conversations GROUP BY conv_id""")
def native_table_places(spark, sf):
    """Where tables lie, and whether other text lies between."""
    p = n.table_places(_declared(spark, sf), n.ranked(_turns(spark, sf)))
    return p.withColumn("last", F.col("last").cast("long"))


@R.add("""SELECT event_id AS doc, event_id AS atom,
  CASE WHEN user_id % 3 = 2 THEN CASE WHEN event_id % 2 = 0 THEN 'layout_only' ELSE 'retained' END
    WHEN (user_id % 3 = 0) = (event_type = 'click') THEN 'retained' ELSE 'normalized' END AS outcome,
  CASE WHEN user_id % 3 = 0 THEN 'hard_break' WHEN user_id % 3 = 1 THEN 'space' WHEN event_type = 'click' THEN 'hard_break' ELSE 'space' END AS boundary_state,
  CASE WHEN event_id % 5 = 0 THEN 'decision_0000000000000000' ELSE 'd' || event_id END AS decision_id FROM events WHERE event_type <> 'error'""")
def whitespace_outcomes(spark, sf):
    """What becomes of white space; clicks are line feeds, errors are letters, all else spaces."""
    e = table(spark, sf, "events")
    atoms = e.select(F.col("event_id").alias("doc"), F.col("event_id").alias("atom"),
                     F.when(F.col("event_type") == "click", "\n").when(F.col("event_type") == "error", "x").otherwise(" ").alias("text"),
                     (F.col("event_id") % 2 == 0).alias("spaced"), F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("d"), F.col("event_id").cast("string"))).alias("decision_id"))
    bounds = e.where("user_id % 3 < 2").select(F.col("event_id").alias("doc"), F.col("event_id").alias("atom"),
                                                F.when(F.col("user_id") % 3 == 0, "hard_break").otherwise("space").alias("state"))
    return n.whitespace_dispositions(atoms, bounds, WHITE)


@R.add("""SELECT o_orderkey AS cell, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus WHEN o_orderkey % 3 = 1 THEN o_orderpriority
  ELSE o_orderkey::VARCHAR END AS text FROM orders""")
def cell_texts(spark, sf):
    """Cell texts by spacing, hint or source."""
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(k.alias("cell"), n.cell_text(
        F.when(k % 3 == 0, F.col("o_orderstatus")), F.when(k % 3 < 2, F.col("o_orderpriority")), k.cast("string")).alias("text"))


@R.add("""SELECT md5(source) AS source_hash, 'description' AS role, doc_id AS "order", substring(text, 1, 500) AS excerpt
FROM documents WHERE text IS NOT NULL AND source IS NOT NULL AND length(text) > 0""")
def block_evidence(spark, sf):
    """Evidence of every block; a document's text is a block of its source."""
    d = table(spark, sf, "documents").where("source IS NOT NULL AND text IS NOT NULL")
    blocks = d.select(F.col("source").alias("doc"), F.col("doc_id").cast("string").alias("region_id"), F.lit(1).alias("page"), F.col("doc_id").alias("order"), "text",
                      F.when(F.length("text") > 0, F.array(F.lit("a"))).otherwise(F.expr(NO_SPANS)).alias("atoms"))
    sources = d.select("source").distinct().select(F.col("source").alias("doc"), F.md5("source").alias("source_hash"), F.lit("description").alias("role"), F.col("source").alias("path"))
    return n.block_evidence(blocks, sources).select("source_hash", "role", F.col("locator.order").alias("order"), "excerpt")


@R.add("""SELECT 'h' || conv_id AS source_hash, role, '{"document":"p","span_id":"s' || turn || '","order":' || turn || CASE WHEN turn % 2 = 0 THEN ',"page":1}' ELSE '}' END AS locator,
  substring(text, 1, 500) AS excerpt FROM conversations WHERE turn % 3 <> 2""")
def span_evidence(spark, sf):
    """Evidence of the spans that blocks publish (two of three)."""
    c = table(spark, sf, "conversations")
    spans = c.select(F.col("conv_id").alias("doc"), F.concat(F.lit("s"), F.col("turn").cast("string")).alias("span"), F.col("turn").alias("ordinal"),
                     F.when(F.col("turn") % 2 == 0, 1).alias("page"), "text", F.col("role").alias("speaker"))
    blocks = spans.where("ordinal % 3 <> 2").select("doc", F.array("span").alias("spans"))
    sources = c.select(F.col("conv_id").alias("doc"), "role").distinct().select("doc", F.concat(F.lit("h"), F.col("doc").cast("string")).alias("source_hash"), "role", F.lit("p").alias("path"))
    each = spans.withColumn("doc", F.concat_ws(":", F.col("doc").cast("string"), "speaker"))
    own = blocks.join(spans.select("doc", F.col("speaker"), F.array("span").alias("spans")), ["doc", "spans"]).withColumn(
        "doc", F.concat_ws(":", F.col("doc").cast("string"), "speaker"))
    return n.span_evidence(each, own, sources.withColumn("doc", F.concat_ws(":", F.col("doc").cast("string"), "role")))


@R.add("""WITH p AS (SELECT conv_id, bool_and(turn % 5 <> 3) AS good FROM conversations GROUP BY 1)
SELECT conv_id AS doc, 's' || turn AS span, sha256(CASE WHEN good AND turn % 2 = 1 THEN replace(text, 'th', 'Th') ELSE text END) AS text_hash
FROM conversations JOIN p USING (conv_id)""")
def patched_texts(spark, sf):
    """Patches of every second span (and, of low confidence, every fifth), by page; a conversation is a page."""
    c = table(spark, sf, "conversations")
    span = F.concat(F.lit("s"), F.col("turn").cast("string")).alias("span")
    spans = c.select(F.col("conv_id").alias("doc"), F.lit(1).alias("page"), span, "text")
    patches = c.where("turn % 2 = 1 OR turn % 5 = 3").select(
        F.col("conv_id").alias("doc"), F.lit(1).alias("page"), span, F.col("turn").alias("position"), F.replace("text", F.lit("th"), F.lit("Th")).alias("patched"),
        F.when(F.col("turn") % 5 == 3, 0.5).otherwise(0.9).alias("confidence"))
    return repair.patched_spans(spans, patches).select("doc", "span", "text_hash")


@R.add("""WITH l AS (SELECT conv_id, '[' || string_agg('{"span_id":"s' || turn || '","text_hash":"' || md5(text) || '"}', ',' ORDER BY turn) || ']' AS items FROM conversations GROUP BY 1)
SELECT conv_id AS doc, sha256(items) AS catalog_hash, sha256('{"page":1,"image_hash":"i","catalog_hash":"' || sha256(items) || '","source_hash":"h' || conv_id || '","model":"m"}') AS request_hash FROM l""")
def page_snapshots(spark, sf):
    """Catalogue and request hashes of pages."""
    c = table(spark, sf, "conversations")
    spans = c.select(F.col("conv_id").alias("doc"), F.lit(1).alias("page"), F.concat(F.lit("s"), F.col("turn").cast("string")).alias("span"),
                     F.col("turn").alias("position"), F.md5("text").alias("text_hash"))
    pages = spans.select("doc", "page").distinct().select("doc", "page", F.lit("i").alias("image_hash"), F.concat(F.lit("h"), F.col("doc").cast("string")).alias("source_hash"), F.lit("m").alias("model"))
    return repair.page_snapshots(spans, pages, ["source_hash", "model"]).drop("page")


@R.add("""SELECT o_orderkey AS decision_id, o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0
  AND (o_orderkey % 2 = 0 OR o_orderkey % 3 <> 2) AS matches FROM orders""")
def recovery_audits(spark, sf):
    """Recovered decisions: even ones agree in the recovery, odd ones in a tiebreak, where every third has a third opinion."""
    key = F.col("o_orderkey")
    o = table(spark, sf, "orders").select("o_orderkey")
    even = key % 2 == 0
    t = o.withColumn("i", F.explode(F.when(even, F.sequence(F.lit(1), F.lit(3))).otherwise(F.sequence(F.lit(1), F.lit(4)))))
    i = F.col("i")
    chosen = F.when(even, "c0").when(i == 2, "c0").when(i == 3, "c1").when(key % 3 == 0, "c0").when(key % 3 == 1, "c1").otherwise("g")
    attempts = t.select(
        key.alias("decision_id"), i.cast("long").alias("position"), F.when((key % 11 == 0) & (i == 3), "primary").when(i <= 2, "primary").when(i == 3, "recovery").otherwise("tiebreak").alias("phase"),
        F.when(i == 1, "candidate_unknown").when(i == 2, F.when(key % 5 == 0, "accepted").otherwise("low_confidence")).otherwise("accepted").alias("status"),
        chosen.alias("candidate_id"), F.when(i == 2, F.when(key % 5 == 0, 0.9).otherwise(0.5)).otherwise(0.9).alias("confidence"),
        _no_codes().alias("codes"), F.lit(0).cast("long").alias("retries"), F.lit(0).cast("long").alias("repairs"),
        i.alias("index"), F.when(key % 7 == 0, F.lit("same")).otherwise(F.concat(F.lit("r"), i.cast("string"))).alias("request_hash"))
    consensus = F.when(even | (key % 3 == 0), "c0").when(key % 3 == 1, "c1").otherwise("g")
    decisions = o.select(
        key.alias("decision_id"), F.when(even, "same_candidate").otherwise("majority").alias("method"), consensus.alias("consensus_id"), F.lit(0.9).alias("confidence"),
        F.when(even, 1).otherwise(2).alias("recovery_count"), F.array(F.when(key % 13 == 0, "X").otherwise(a.RECOVERED_CODE)).alias("codes"),
        F.lit(0).cast("long").alias("retry_count"), F.lit(0).cast("long").alias("repair_count"))
    allowed = o.select(key.alias("decision_id"), F.explode(F.array(F.lit("c0"), F.lit("c1"), F.lit("g"))).alias("candidate_id"))
    return a.with_attempts(decisions, attempts, allowed).select("decision_id", a.recovery_matches(0.7).alias("matches"))


def _no_codes():
    return F.expr(NO_SPANS)


@R.add("""SELECT o_orderkey AS id, 'decision_' || substring(sha256('{"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '","note":null}'), 1, 16) AS decision_id FROM orders""")
def decision_ids(spark, sf):
    """Content ids of decisions; nulls count."""
    o = table(spark, sf, "orders").withColumn("note", F.lit(None).cast("string"))
    return o.select(F.col("o_orderkey").alias("id"), a.decision_id("o_custkey", "o_orderstatus", "note").alias("decision_id"))


@R.add("""WITH h AS (SELECT user_id, event_id, value, 'candidate_' || substring(sha256('["recognition","' || user_id || '","' || event_id || '","' || event_type || '","e"]'), 1, 16) AS id FROM events)
SELECT user_id AS region, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, id) AS "rank", id AS candidate_id, value AS score FROM h
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, id) <= 5""")
def recognition_candidates(spark, sf):
    """The five best readings of each region; an event is a reading of its user."""
    e = table(spark, sf, "events")
    regions = e.groupBy("user_id").agg(F.collect_list("event_id").alias("hypothesis_ids")).select(F.lit(1).alias("doc"), F.col("user_id").alias("region"), "hypothesis_ids")
    readings = e.select(F.lit(1).alias("doc"), F.col("event_id").alias("hypothesis"), F.col("event_type").alias("text"), F.lit("e").alias("engine"), F.col("value").alias("confidence"))
    return a.recognition_candidates(regions, readings).select("region", F.col("rank").cast("long").alias("rank"), "candidate_id", "score")


@R.add("SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0")
def reusable_plans(spark, sf):
    """Trusted plans that may be used again."""
    k = F.col("o_orderkey")
    o = table(spark, sf, "orders").select(k.alias("id"), F.concat(F.lit("s"), k.cast("string")).alias("source_hash"), F.array(F.col("o_custkey").cast("string")).alias("span_hashes"),
                                          F.lit("p1").alias("parser_version"), F.lit("q1").alias("prompt_version"), F.lit("z").alias("schema_hash"), F.col("o_orderpriority").alias("plan"))
    trusted = o.withColumn("plan_hash", F.when(F.col("id") % 3 == 0, "x").otherwise(F.sha2(F.col("plan").cast("binary"), 256)))
    contexts = o.withColumn("parser_version", F.when(F.col("id") % 5 == 0, "p2").otherwise(F.col("parser_version")))
    return a.reusable_plans(trusted, contexts, "plan").select("id")


@R.add("""SELECT 'p' || p_partkey AS product_key, CASE WHEN p_partkey % 7 NOT IN (0, 1, 2, 3) THEN 'cst_00000000-0000-7000-8000-000000000000' END AS changeset_id,
  CASE p_partkey % 7 WHEN 0 THEN 'RELEASE_PRODUCT_CONFIG_MISSING' WHEN 1 THEN 'RELEASE_PRODUCT_CONFIG_MISMATCH' WHEN 2 THEN 'CHANGESET_REFERENCE_INVALID' END AS code FROM part""")
def product_changesets(spark, sf):
    """Products against their configuration."""
    k = F.col("p_partkey")
    p = table(spark, sf, "part").select(F.concat(F.lit("p"), k.cast("string")).alias("product_key"), k.alias("product_id"), F.col("p_size").alias("version"))
    configs = p.where("product_id % 7 <> 0").withColumn("version", F.when(F.col("product_id") % 7 == 1, F.col("version") + 1).otherwise(F.col("version"))).withColumn(
        "changeset_id", F.when(F.col("product_id") % 7 == 2, "CST").when(F.col("product_id") % 7 == 3, "").otherwise("cst_00000000-0000-7000-8000-000000000000"))
    return a.product_changesets(p, configs)


@R.add("""WITH p AS (SELECT (p_partkey // 12)::VARCHAR AS doc, p_partkey % 12 // 3 AS r, p_partkey % 3 AS c, p_partkey // 3 % 5 = 0 AS wide, p_name FROM part),
  l AS (SELECT *, max(c) OVER (PARTITION BY doc) AS top FROM p WHERE NOT (wide AND c = 2))
SELECT doc, r::INT AS start_row, (r + 1)::INT AS end_row, c::INT AS start_column, (CASE WHEN wide AND c = 1 THEN top + 1 ELSE c + 1 END)::INT AS end_column, p_name AS text, r = 0 AS header FROM l""")
def geometry_tables(spark, sf):
    """Cells by the places of lines: tables of four rows and three columns; in every fifth row the second cell spans the third."""
    k = F.col("p_partkey")
    p = table(spark, sf, "part").select(F.expr("cast(p_partkey div 12 as string)").alias("doc"), F.lit(1).cast("long").alias("block"), k.alias("first"), F.col("p_name").alias("text"),
                                        F.expr("p_partkey % 12 div 3").alias("r"), (k % 3).alias("c"), F.expr("p_partkey div 3 % 5 = 0").alias("wide"))
    left, top = 0.1 + 0.3 * F.col("c"), 0.9 - 0.1 * F.col("r")
    right = F.when(F.col("wide") & (F.col("c") == 1), 0.85).otherwise(left + 0.1)
    lines = p.where("NOT (wide AND c = 2)").select("doc", "block", "first", "text", g.box(left, top - 0.05, right, top).alias("box"))
    return tables.geometry_cells(lines).drop("block")


@R.add("SELECT conv_id::VARCHAR AS doc, turn AS block FROM conversations WHERE conv_id % 3 <> 1")
def proven_table_hints(spark, sf):
    """Hinted tables of one cell a turn; the hints of every third conversation hold a character too much, others are reversed."""
    c = table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("doc"), F.col("turn").alias("block"), "text", "conv_id")
    chars = c.select("doc", "block", F.posexplode(F.split("text", "")).alias("ordinal", "text"))
    left = F.col("ordinal") * 0.01
    atoms = chars.withColumn("box", g.box(left, F.lit(0.5), left + 0.01, F.lit(0.52)))
    n = F.col("conv_id") % 3
    said = F.when(n == 0, F.reverse("text")).when(n == 1, F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    zero, one = F.lit(0), F.lit(1)
    hints = c.select("doc", "block", zero.alias("cell"), zero.alias("start_row"), one.alias("end_row"), zero.alias("start_column"), one.alias("end_column"),
                     g.box(F.lit(0.0), F.lit(0.4), F.lit(100000.0), F.lit(0.6)).alias("box"), said.alias("text"))
    return tables.proven_tables(atoms, hints).select("doc", "block")
