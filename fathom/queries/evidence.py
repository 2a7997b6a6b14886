"""Evidence, matching, repairs and reports over conversations, documents and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions import geometry as g
from fathom.operators import evidence as ev
from fathom.operators import matching, repair, reports

from .base import Registry, table

R = Registry()
QUERIES, ORACLE_SQL = R.queries, R.sql


def _chars(spark, sf):
    """A character a row of every conversation: a page a turn, an object every seven characters."""
    c = table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("doc"), (F.col("turn") + 1).cast("int").alias("page"),
                                                 F.posexplode(F.split(F.regexp_replace("text", "\n", "\r\n"), "")).alias("idx", "text"))
    left = F.col("idx") * 0.01
    return c.withColumn("obj", F.expr("idx div 7")).withColumn("box", g.box(left, F.lit(0.5), left + 0.01, F.lit(0.55)))


RAW = r"""r AS (SELECT conv_id, turn, replace(text, chr(10), chr(13) || chr(10)) AS x FROM conversations),
c AS (SELECT conv_id, turn, x, unnest(range(1, length(x) + 1)) AS i FROM r),
k AS (SELECT conv_id, turn, i, (i - 1) // 7 AS obj, CASE WHEN x[i] = chr(13) THEN chr(10) ELSE x[i] END AS ch FROM c WHERE NOT (x[i] = chr(10) AND i > 1 AND x[i - 1] = chr(13))),
s AS (SELECT conv_id, turn, obj, string_agg(ch, '' ORDER BY i) AS text FROM k GROUP BY 1, 2, 3),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, obj) - 1 AS ordinal FROM s)"""


@R.add(f"WITH {RAW} SELECT conv_id::VARCHAR AS doc, (turn + 1)::INT AS page, ordinal::INT AS ordinal, 'span_' || left(sha256(conv_id || ':' || ordinal), 16) AS span_id, text FROM n")
def object_spans(spark, sf):
    """Characters to spans by text object, line ends made single across objects."""
    return ev.object_spans(_chars(spark, sf)).select("doc", "page", F.col("ordinal").cast("int").alias("ordinal"), "span_id", "text")


@R.add(rf"""WITH {RAW}, m AS (SELECT *, greatest(1, sum((trim(replace(text, chr(10), ' ')) <> '')::INT) OVER (PARTITION BY conv_id, turn ORDER BY ordinal ROWS UNBOUNDED PRECEDING)) AS member FROM n)
SELECT conv_id::VARCHAR AS doc, (turn + 1)::INT AS page, member::INT AS member, count(*) AS spans, string_agg(text, '' ORDER BY ordinal) AS text FROM m GROUP BY 1, 2, 3""")
def span_groups(spark, sf):
    """White-space spans join the visible span before them."""
    return ev.span_groups(ev.object_spans(_chars(spark, sf))).select("doc", "page", "member", "spans", "text")


@R.add(f"""WITH {RAW}, a AS (SELECT conv_id, turn, i, ch, row_number() OVER (PARTITION BY conv_id ORDER BY turn, i) - 1 AS ordinal FROM k)
SELECT conv_id::VARCHAR AS doc, ordinal, CASE WHEN ch = chr(10) THEN 'line_break' WHEN ch = ' ' THEN 'space' ELSE 'character' END AS kind FROM a""")
def character_atoms(spark, sf):
    return ev.atoms(_chars(spark, sf)).select("doc", "ordinal", "kind")


@R.add(r"""SELECT conv_id::VARCHAR AS doc, (turn + 1)::INT AS page, len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) AS regions FROM conversations""")
def embedded_regions(spark, sf):
    """Line regions of every page."""
    rows = ev.embedded_regions(ev.atoms(_chars(spark, sf)))
    return rows.groupBy("doc", "page").agg(F.count_distinct("region").alias("regions"))


@R.add("""SELECT conv_id::VARCHAR AS doc, turn, text FROM conversations WHERE trim(replace(text, chr(10), ' ')) <> ''""")
def recognised_text(spark, sf):
    """Recognised spans to regions, hypotheses, and back to one atom a character."""
    spans = table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("doc"), (F.col("turn") + 1).alias("page"), F.col("turn").alias("ordinal"), "text",
                                                     g.box(F.lit(0), F.lit(0), F.lit(1), F.lit(1)).alias("box"))
    a = ev.materialised_atoms(ev.recognised_regions(spans))
    back = a.groupBy("doc", "page", "region_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "text"))), lambda x: x["text"]), "").alias("text"))
    return back.select("doc", (F.col("page") - 1).alias("turn"), "text")


@R.add("""SELECT conv_id::VARCHAR AS doc, CASE WHEN conv_id % 3 = 0 THEN 'embedded' WHEN conv_id % 3 = 1 AND count(*) > 1 THEN 'mixed' ELSE 'ocr' END AS mode FROM conversations GROUP BY conv_id""")
def evidence_modes(spark, sf):
    t = table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("doc"), F.col("turn").alias("page"), "text", "conv_id")
    chars = t.where("conv_id % 3 = 0 OR (conv_id % 3 = 1 AND page > 0)")
    return ev.evidence_mode(chars, t.select("doc", "page"))


@R.add("""SELECT conv_id::VARCHAR AS doc, turn AS "order", CASE turn % 4 WHEN 0 THEN 'heading' WHEN 1 THEN 'list_item' WHEN 2 THEN 'table' ELSE 'paragraph' END AS kind, CASE WHEN turn % 4 = 0 THEN least(6, greatest(1, turn + 1))::INT END AS level FROM conversations""")
def hint_blocks(spark, sf):
    n = F.col("turn") % 4
    items = table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("doc"), F.col("turn").alias("position"), F.when(n == 0, "section_header").when(n == 1, "list_item").when(n == 2, "table").otherwise("text").alias("label"),
                                                     F.col("turn").cast("int").alias("level"), "text", F.lit(None).cast("string").alias("box"))
    return ev.hint_blocks(items).select("doc", F.col("order").cast("long").alias("order"), "kind", "level")


@R.add("""SELECT conv_id, turn, turn + 1 AS position FROM conversations""")
def order_by_hint(spark, sf):
    """Words of a turn given backwards, put in the order the hint has them."""
    t = table(spark, sf, "conversations").select("conv_id", F.col("turn").alias("t"), "text")
    p = t.select(F.col("conv_id"), F.col("t").alias("turn"), F.concat(F.lit("<"), F.col("t").cast("string"), F.lit(">")).alias("text"), (-F.col("t")).alias("idx"))
    hint = p.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), " ").alias("hint"))
    return ev.place_by_hint(p.join(hint, "conv_id"), ["conv_id"]).select("conv_id", "turn", F.col("position").cast("long").alias("position"))


@R.add("""WITH c AS (SELECT conv_id, turn, unnest(range(1, length(text) + 1)) AS i, text FROM conversations), k AS (SELECT conv_id, turn, i, text[i] AS ch FROM c WHERE trim(replace(text[i], chr(10), ' ')) <> '')
SELECT conv_id, turn, count(*) AS placed FROM k GROUP BY 1, 2""")
def characters_by_hint(spark, sf):
    """Every visible character finds its own place in the hint."""
    t = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    chars = t.select("conv_id", "turn", F.posexplode(F.split(F.reverse("text"), "")).alias("idx", "text")).where(F.trim(F.regexp_replace("text", "\n", " ")) != "")
    out = ev.characters_by_hint(chars, t.select("conv_id", "turn", F.col("text").alias("hint")), ["conv_id", "turn"])
    return out.groupBy("conv_id", "turn").agg(F.count_distinct("place").alias("placed"))


@R.add("""SELECT p_brand AS brand, CASE WHEN count(DISTINCT p_size % 2) <= 1 THEN min(p_size % 2) END AS page FROM part GROUP BY 1""")
def group_locations(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_brand").alias("brand"), (F.col("p_size") % 2).alias("page"), g.box(F.lit(0), F.lit(0), F.lit(1), F.lit(1)).alias("box"))
    return ev.group_location(p, ["brand"]).select("brand", "page")


@R.add("""WITH w AS (SELECT user_id, event_id % 5 AS r, max(event_id % 3) + sum(event_id % 4 + 1) AS n FROM events GROUP BY 1, 2)
SELECT user_id AS "table", coalesce(CASE WHEN user_id % 2 = 0 THEN 10 END, max(n))::BIGINT AS columns, CASE WHEN user_id % 2 = 0 AND max(n) > 10 THEN 'DOCX_TABLE_DECLARED_GRID_TOO_SMALL' END AS code FROM w GROUP BY 1""")
def table_columns(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("table"), (F.col("event_id") % 5).alias("row"), (F.col("event_id") % 3).alias("before"), (F.col("event_id") % 4 + 1).alias("span"))
    declared = e.where("table % 2 = 0").select("table").distinct().withColumn("declared", F.lit(10))
    return ev.table_column_count(e, declared)


@R.add("""SELECT event_id AS paragraph, CASE WHEN event_id % 3 = 1 AND user_id % 2 = 1 THEN 'unordered' ELSE 'ordered' END AS kind, (user_id % 2 + 1)::BIGINT AS depth FROM events WHERE event_id % 3 <> 0""")
def list_metadata(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_id").alias("paragraph"), (F.col("event_id") % 3).alias("num"), (F.col("user_id") % 2).alias("level"))
    formats = spark.createDataFrame([(1, 0, "decimal"), (1, 1, "bullet"), (2, 0, "lowerLetter")], "num long, level long, format string")
    return ev.list_metadata(e, formats)


@R.add("""SELECT min(event_id) AS cell, user_id AS "table", event_id % 4 AS start_row FROM events GROUP BY user_id, event_id % 4""")
def unique_cells(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_id").alias("cell"), F.col("user_id").alias("table"), (F.col("event_id") % 4).alias("start_row"), F.lit(0).alias("start_column"),
                                          (F.col("event_id") % 4 + 1).alias("end_row"), F.lit(1).alias("end_column"))
    return ev.unique_cells(e).select("cell", "table", "start_row")


@R.add("""SELECT conv_id::VARCHAR AS doc, turn::INT AS hint, turn::INT AS first, turn::INT AS last, 1.0::DOUBLE AS score FROM conversations""")
def sequence_alignment(spark, sf):
    """Hints matched to runs of text groups in order; equal ones match perfectly."""
    def rows():
        return table(spark, sf, "conversations").select(
            F.col("conv_id").cast("string").alias("doc"), F.col("turn").cast("int").alias("position"), F.lit(1).alias("page"), F.lit("paragraph").alias("kind"),
            F.concat(F.col("turn").cast("string"), F.lit(":"), "text").alias("text"), F.lit(0.0).alias("left"),
            (1.0 - F.col("turn") * 0.02).alias("bottom"), F.lit(1.0).alias("right"), (1.015 - F.col("turn") * 0.02).alias("top"))

    return matching.match_groups(rows(), rows()).withColumn("score", F.round("score", 9))


@R.add("""SELECT conv_id::VARCHAR AS doc, 0 AS rank, turn::INT AS position, turn AS region FROM conversations""")
def topological_orders(spark, sf):
    """A chain has exactly one order."""
    def rows():
        return table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("doc"), (-F.col("turn")).alias("position"), F.col("turn").alias("region"))

    last = rows().groupBy("doc").agg(F.max("region").alias("last"))
    edges = rows().join(last, "doc").where("region < last").select("doc", F.col("region").alias("before"), (F.col("region") + 1).alias("after"))
    return matching.topological_orders(rows(), edges)


@R.add("""SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'SPACING_REPAIR_CHARACTER_MISMATCH' WHEN 1 THEN 'SPACING_REPAIR_CONTROL_SEPARATOR' WHEN 2 THEN 'SPACING_REPAIR_HARD_LINE_BOUNDARY_MISMATCH' END AS code FROM conversations""")
def generated_repairs(spark, sf):
    """Generated spacings against their anchors."""
    t = table(spark, sf, "conversations").select("conv_id", "turn", F.concat(F.lit("ab cd "), F.regexp_replace("text", "[\n0-9@/:_-]", " ")).alias("a"))
    n = F.col("turn") % 4
    made = (F.when(n == 0, F.concat("a", F.lit("!"))).when(n == 1, F.regexp_replace("a", "^ab cd", "ab\tcd")).when(n == 2, F.regexp_replace("a", "^ab cd", "ab\ncd")).otherwise(F.regexp_replace("a", "^ab cd", "abcd")))
    return t.select("conv_id", "turn", repair.generated_code(F.col("a"), made).alias("code"))


@R.add("""SELECT conv_id AS doc, CASE WHEN conv_id % 4 = 0 THEN 'SEMANTIC_OCR_CORRECTION_CONFIDENCE_LOW' WHEN conv_id % 4 = 1 THEN 'SEMANTIC_OCR_CORRECTION_TEXT_GROWTH_EXCEEDED' WHEN conv_id % 4 = 2 THEN 'SEMANTIC_OCR_CORRECTION_UNKNOWN_SPAN' END AS code FROM (SELECT DISTINCT conv_id FROM conversations)""")
def page_patches(spark, sf):
    """The first failing patch rejects its page."""
    t = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc"), F.lit(1).alias("page"), F.col("turn").alias("span"), "text")
    n, first = F.col("doc") % 4, F.col("span") == 0
    p = t.select("doc", "page", F.when((n == 2) & first, -1).otherwise(F.col("span")).alias("span"), F.when((n == 1) & first, F.repeat("text", F.lit(3))).otherwise(F.col("text")).alias("patched"),
                 F.when((n == 0) & first, 0.5).otherwise(0.9).alias("confidence"), F.col("span").alias("position"))
    return repair.page_codes(p, t).select("doc", "code")


@R.add("""SELECT conv_id AS doc, CASE conv_id % 5 WHEN 0 THEN 'SEMANTIC_REPAIR_MISSING_SPAN' WHEN 1 THEN 'SEMANTIC_REPAIR_UNKNOWN_SPAN' WHEN 2 THEN 'SEMANTIC_REPAIR_DUPLICATE_SPAN' WHEN 3 THEN 'SEMANTIC_REPAIR_CONFIDENCE_LOW' END AS code FROM (SELECT DISTINCT conv_id FROM conversations)""")
def structure_plans(spark, sf):
    """The first rule each repair plan breaks."""
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("span"))
    n = F.col("doc") % 5
    plan = c.select("doc", F.col("span").alias("block"), F.col("span").alias("order"), "span", F.when(n == 3, 0.1).otherwise(0.9).alias("confidence"))
    extra = plan.where("span = 0")
    plan = plan.unionByName(extra.where(n == 1).withColumn("span", F.lit(-7).cast("long"))).unionByName(extra.where(n == 2))
    context = c.unionByName(c.where((n == 0) & (F.col("span") == 0)).withColumn("span", F.lit(-9).cast("long")))
    return repair.plan_codes(plan, context)


@R.add("""WITH r AS (SELECT conv_id, turn, text, turn - row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM conversations WHERE turn % 3 <> 2)
SELECT conv_id AS doc, min(turn) AS first, max(turn) AS last, string_agg(text, '' ORDER BY turn) AS text FROM r GROUP BY conv_id, run""")
def lossless_leftovers(spark, sf):
    """Leftover spans become paragraphs of adjacent spans; no text is lost."""
    t = table(spark, sf, "conversations").where("turn % 3 <> 2").select(F.col("conv_id").alias("doc"), F.col("turn").alias("ordinal"), "text")
    return repair.degrade(t).select("doc", "first", "last", "text")


@R.add("""SELECT conv_id, turn, turn % 2 = 0 AS same FROM conversations""")
def character_multisets(spark, sf):
    t = table(spark, sf, "conversations")
    other = F.when(F.col("turn") % 2 == 0, F.reverse("text")).otherwise(F.concat("text", F.lit("#")))
    return t.select("conv_id", "turn", repair.multiset_equal(F.col("text"), other).alias("same"))


@R.add("""SELECT event_id AS idx, CASE WHEN abs(value / 100 - 0.2) <= abs(value / 100 - 0.8) THEN 0 ELSE 1 END AS anchor FROM events""")
def cell_splits(spark, sf):
    """Characters of a spanning cell go to their nearest anchor."""
    e = table(spark, sf, "events").select("user_id", F.col("event_id").alias("idx"), (F.col("value") / 100).alias("center"))
    anchors = e.select("user_id").distinct().withColumn("a", F.explode(F.array(F.struct(F.lit(0).alias("anchor"), F.lit(0.2).alias("position")), F.struct(F.lit(1).alias("anchor"), F.lit(0.8).alias("position"))))).select("user_id", "a.*")
    return repair.split_cells(e, anchors, ["user_id"]).select("idx", "anchor")


@R.add("""SELECT count(DISTINCT conv_id) AS tables, count(DISTINCT n) AS signatures FROM (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1)""")
def structure_signatures(spark, sf):
    """Tables of equal grids have equal signatures."""
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("table"), F.col("turn").alias("start_row"), F.lit(0).alias("start_column"), (F.col("turn") + 1).alias("end_row"), F.lit(1).alias("end_column"))
    s = repair.structure_signature(c)
    return s.agg(F.count_distinct("table").alias("tables"), F.count_distinct("signature").alias("signatures"))


@R.add("""WITH f AS (SELECT o_custkey AS product_id, CASE WHEN o_orderstatus = 'F' THEN 'HARD' ELSE 'SOFT' END AS code FROM orders WHERE o_orderkey % 3 = 0)
SELECT c_custkey AS product_id, count(code) FILTER (code = 'HARD') AS hard, count(code) FILTER (code = 'SOFT') AS soft,
  CASE WHEN count(code) FILTER (code = 'HARD') > 0 THEN 'FAIL' WHEN count(code) > 0 THEN 'WARN' ELSE 'PASS' END AS status FROM customer LEFT JOIN f ON product_id = c_custkey GROUP BY c_custkey""")
def product_status(spark, sf):
    """FAIL, WARN or PASS from all findings of a product."""
    o = table(spark, sf, "orders").where("o_orderkey % 3 = 0").select(F.col("o_custkey").alias("product_id"), F.when(F.col("o_orderstatus") == "F", "HARD").otherwise("SOFT").alias("code"))
    every = reports.findings(o.where("code = 'HARD'"), o.where("code = 'SOFT'").withColumn("path", F.lit("x")))
    return reports.product_status(every, table(spark, sf, "customer").select(F.col("c_custkey").alias("product_id")), ("HARD",))


@R.add("""SELECT conv_id AS doc, list(p ORDER BY p) AS missing FROM (SELECT conv_id, (turn + 1)::INT AS p FROM conversations WHERE turn % 3 = 1) GROUP BY 1""")
def page_audits(spark, sf):
    c = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc"), (F.col("turn") + 1).cast("int").alias("page"), "turn")
    return reports.audit_findings(c.where("turn % 3 <> 1"), c.groupBy("doc").agg(F.max("page").alias("pages")))


@R.add("""SELECT user_id AS doc, count(*) FILTER (value >= 20) AS selected, count(*) FILTER (value < 20) AS deferred, count(*) FILTER (event_type = 'view') AS cached,
  sum(CASE WHEN event_type = 'view' THEN 0 ELSE 1 + event_id % 2 + event_id % 3 END)::BIGINT AS calls, CASE WHEN count(*) FILTER (value < 20) = 0 THEN 'applied' WHEN count(*) FILTER (value >= 20) > 0 THEN 'partial' ELSE 'deferred' END AS outcome FROM events GROUP BY 1""")
def application_report(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("doc"), F.when(F.col("value") >= 20, "selected").otherwise("deferred").alias("outcome"),
                                          F.when(F.col("event_type") == "view", "cache").otherwise("model").alias("source"), (F.col("event_id") % 2).alias("retries"), (F.col("event_id") % 3).alias("repairs"))
    return reports.application_report(e)


@R.add("""SELECT user_id AS doc, event_type AS kind, count(DISTINCT event_id % 10) AS sets, count(*) AS candidates, max(value) AS best FROM events GROUP BY 1, 2""")
def candidate_summary(spark, sf):
    return reports.candidate_summary(table(spark, sf, "events").select(F.col("user_id").alias("doc"), F.col("event_type").alias("kind"), (F.col("event_id") % 10).alias("region"), F.col("value").alias("score")))


@R.add("""SELECT s_suppkey AS product_id, CASE WHEN s_suppkey % 4 = 0 THEN 'QUALITY_GATE_FAILED' WHEN s_suppkey % 4 = 1 THEN 'SEMANTIC_FIDELITY_GATE_FAILED' ELSE 'SEMANTIC_VALIDATION_NOT_VERIFIED' END AS code FROM supplier WHERE s_suppkey % 4 < 3""")
def release_gate(spark, sf):
    n = F.col("s_suppkey") % 4
    r = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("product_id"), F.when(n == 0, "FAIL").otherwise("PASS").alias("status"), F.when(n == 1, 0.9).otherwise(1.0).alias("coverage"), F.lit(0).alias("degraded"), (n != 2).alias("verified"))
    return reports.publishable(r)


@R.add("""SELECT s_suppkey AS product_id, 'RELEASE_ARTIFACT_MISSING' AS code FROM supplier WHERE s_suppkey % 3 = 0 UNION ALL SELECT s_suppkey, 'DIAGNOSTICS_INCOMPLETE' FROM supplier WHERE s_suppkey % 2 = 0""")
def release_artifacts(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("product_id"))
    names = F.explode(F.array(*[F.lit(x) for x in ("model.json", "report.json", "d1.json", "d2.json")]))
    present = s.select("product_id", names.alias("name")).where("NOT (product_id % 3 = 0 AND name = 'model.json') AND NOT (product_id % 2 = 0 AND name = 'd2.json')")
    return reports.missing_artifacts(present, s, ("model.json", "report.json"), ("d1.json", "d2.json"))


@R.add("""SELECT DISTINCT 'p' || s_suppkey AS product_id FROM supplier WHERE s_suppkey % 6 IN (0, 1, 2)""")
def products_to_release(spark, sf):
    s = table(spark, sf, "supplier")
    p, n = F.concat(F.lit("p"), F.col("s_suppkey").cast("string")), F.col("s_suppkey") % 6
    paths = s.where(n.isin(0, 1, 3)).select(p.alias("product_key"), F.lit("generated").alias("kind"))
    ready = s.where(n.isin(1, 2, 3, 4)).select(p.alias("product_id"), F.when(n.isin(1, 2), "release").when(n == 3, "deferred").otherwise("unknown").alias("state"))
    return reports.to_release(paths, ready)


@R.add("""SELECT 'v' || s_suppkey AS tag, CASE s_suppkey % 3 WHEN 0 THEN 'CREATE' WHEN 1 THEN 'KEEP' ELSE 'TAG_TARGET_CONFLICT' END AS code FROM supplier""")
def tag_targets(spark, sf):
    s = table(spark, sf, "supplier").select(F.concat(F.lit("v"), F.col("s_suppkey").cast("string")).alias("tag"), F.col("s_suppkey").alias("n"))
    return reports.tag_codes(s.withColumn("commit", F.lit("a")), s.where("n % 3 <> 0").select("tag", F.when(F.col("n") % 3 == 1, "a").otherwise("b").alias("commit")))


@R.add("""WITH v AS (SELECT source || ':' || lang AS identity, sha256(lang) AS h FROM documents WHERE doc_id % 2 = 0)
SELECT identity, min(h) AS markdown_hash FROM v GROUP BY 1 HAVING count(DISTINCT h) = 1""")
def replay_catalog(spark, sf):
    """Verified baselines of one source; identities with several contents have none."""
    d = table(spark, sf, "documents").select(F.concat("source", F.lit(":"), "lang").alias("identity"), F.lit("s").alias("source_hash"), F.col("lang").alias("markdown"),
                                        F.when(F.col("doc_id") % 2 == 0, F.sha2(F.col("lang").cast("binary"), 256)).otherwise("x").alias("markdown_hash"))
    return reports.replay_catalog(d, "s")
