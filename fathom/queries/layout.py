"""Layout, candidates, canonical documents and their invariants."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions import geometry as g
from fathom.operators import candidates as c
from fathom.operators import canonical as k
from fathom.operators import layout as lay
from fathom.operators import validation as v
from fathom.plans import reconstruct as rec

from .base import Registry, table

R = Registry()
QUERIES, ORACLE_SQL = R.queries, R.sql


def _atoms(spark, sf):
    """A character a row of every turn: a region a turn, ten turns a page, a line height of 0.08."""
    t = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    a = t.select(F.col("conv_id").cast("string").alias("doc"), (F.expr("turn div 10") + 1).cast("int").alias("page"), F.col("turn").alias("region"),
                 F.posexplode(F.split("text", "")).alias("i", "text"))
    left = F.col("i") * 0.01
    top = 0.98 - F.col("region") % 10 * 0.09
    kind = F.when(F.col("text") == "\n", "line_break").when(F.col("text") == " ", "space").otherwise("character")
    return a.select("doc", "page", "region", (F.col("region") * 1_000_000 + F.col("i")).cast("long").alias("ordinal"), kind.alias("kind"), "text",
                    g.box(left, top - 0.05, left + 0.01, top).alias("box"))


@R.add(r"""SELECT conv_id::VARCHAR AS doc, turn AS region, regexp_replace(regexp_replace(regexp_replace(text, '^[ \n]+|[ \n]+$', '', 'g'), ' *\n[ \n]*', chr(10), 'g'), ' +', ' ', 'g') AS text FROM conversations""")
def geometric_text(spark, sf):
    """Characters with spaces where the gap is wide enough."""
    return lay.geometric_text(_atoms(spark, sf))


@R.add(r"""WITH l AS (SELECT conv_id::VARCHAR AS doc, turn AS region, unnest(string_split(text, chr(10))) AS line FROM conversations) SELECT doc, region, count(*) FILTER (trim(line) <> '') AS lines FROM l GROUP BY 1, 2""")
def line_split_islands(spark, sf):
    """Lines of every region: breaks, baselines and gaps."""
    found = lay.lines(_atoms(spark, sf)).where(F.trim(F.regexp_replace("text", "\n", "")) != "")
    return found.groupBy("doc", "region").agg(F.count("*").alias("lines"))


@R.add("""SELECT conv_id::VARCHAR AS doc, sha256(string_agg(regexp_replace(text, '[ \\n]', '', 'g'), '' ORDER BY turn)) AS text FROM conversations GROUP BY 1""")
def authoritative_text(spark, sf):
    """No character is lost between atoms and text."""
    return lay.line_text(_atoms(spark, sf)).select("doc", F.sha2(F.col("text").cast("binary"), 256).alias("text"))


@R.add(None)
def layout_regions(spark, sf):
    """Lines to columns, regions, repeated edges: the whole layout plan."""
    rows = lay.regions(lay.with_columns(lay.lines(_atoms(spark, sf))))
    pages = rows.groupBy("doc").agg(F.max("page").alias("page_count"))
    return lay.mark_repeated_edges(rows, pages).select("doc", "page", "column", "block", "lines", "first", "edge")


@R.add(None)
def reconstructed_documents(spark, sf):
    """Characters to Markdown, in one plan."""
    return rec.reconstruct(_atoms(spark, sf)).markdown


@R.add("""SELECT conv_id::VARCHAR AS doc, 0::BIGINT AS lost FROM conversations GROUP BY 1""")
def reconstruction_losses(spark, sf):
    """Regions that a reconstruction loses, repeats or invents: none."""
    return rec.reconstruct(_atoms(spark, sf)).coverage.select("doc", (F.col("unmatched") + F.col("duplicated") + F.col("unknown")).alias("lost"))


@R.add(None)
def layout_edges(spark, sf):
    """Reading order edges and page continuations of the layout."""
    rows = lay.regions(lay.with_columns(lay.lines(_atoms(spark, sf))))
    return lay.reading_edges(rows)


@R.add("""WITH r AS (SELECT l_orderkey AS doc, l_linenumber AS page, l_partkey % 2 AS col, l_suppkey % 10 / 16.0 AS lft, (l_suppkey % 10 + 4 + l_partkey % 3) / 16.0 AS rgt,
  (l_partkey % 20 + 2) / 32.0 AS top, l_suppkey * 10 + l_linenumber AS first FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 1, l_partkey % 8 / 16.0, (l_partkey % 8 + 6) / 16.0, 0.03125, l_partkey * 10 + l_linenumber FROM lineitem),
o AS (SELECT *, row_number() OVER (PARTITION BY doc, page ORDER BY col, -top, lft, rgt, first) AS a, row_number() OVER (PARTITION BY doc, page ORDER BY col DESC, -top DESC, lft DESC, rgt DESC, first DESC) AS z FROM r)
SELECT b.doc::VARCHAR AS doc, b.page, b.first AS before, n.first AS after, greatest(0, least(b.rgt, n.rgt) - greatest(b.lft, n.lft)) / least(b.rgt - b.lft, n.rgt - n.lft)::DOUBLE AS overlap
FROM o b JOIN o n ON n.doc = b.doc AND n.page = b.page + 1 WHERE b.z = 1 AND n.a = 1 AND greatest(0, least(b.rgt, n.rgt) - greatest(b.lft, n.lft)) / least(b.rgt - b.lft, n.rgt - n.lft) >= 0.75""")
def layout_continuations(spark, sf):
    """The last region of a page and the first of the next one, where they lie under each other."""
    l = table(spark, sf, "lineitem")
    left, right = F.col("l_suppkey") % 10 / 16.0, (F.col("l_suppkey") % 10 + 4 + F.col("l_partkey") % 3) / 16.0
    top = (F.col("l_partkey") % 20 + 2) / 32.0
    name = [F.col("l_orderkey").cast("string").alias("doc"), F.col("l_linenumber").alias("page")]
    upper = l.select(*name, (F.col("l_partkey") % 2).cast("long").alias("column"), g.box(left, top - 1 / 32, right, top).alias("box"),
                     (F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("first"))
    low = F.col("l_partkey") % 8 / 16.0
    lower = l.select(*name, F.lit(1).cast("long").alias("column"), g.box(low, F.lit(0.0), low + 6 / 16, F.lit(0.03125)).alias("box"),
                     (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("first"))
    return lay.continuations(upper.unionByName(lower))


@R.add("""WITH x AS (SELECT l_orderkey, l_linenumber, l_suppkey % 20 / 20.0 AS b, l_suppkey % 20 / 20.0 + l_quantity / 500 AS t FROM lineitem),
f AS (SELECT *, min(b) OVER (PARTITION BY l_orderkey ORDER BY t DESC, b DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS floor FROM x)
SELECT l_orderkey, l_linenumber, sum(CASE WHEN t <= floor THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey ORDER BY t DESC, b DESC ROWS UNBOUNDED PRECEDING)::BIGINT AS row_group FROM f""")
def row_groups(spark, sf):
    """Cells whose vertical extents overlap, directly or through others."""
    b = F.col("l_suppkey") % 20 / 20.0
    x = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", g.box(F.lit(0), b, F.lit(1), b + F.col("l_quantity") / 500).alias("box"))
    return lay.row_groups(x, ["l_orderkey"]).select("l_orderkey", "l_linenumber", "row_group")


@R.add(None)
def column_anchors(spark, sf):
    """Left edges clustered by a running median."""
    x = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("doc"), (F.col("l_orderkey") % 100).alias("block"), (F.col("l_suppkey") / 1000).alias("left"))
    return lay.column_anchors(x)


BLOCK = rf"""t AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS region FROM documents),
b AS (SELECT doc_id, region, CASE (doc_id + region) % 5 WHEN 0 THEN '1.2 ' WHEN 1 THEN '- ' WHEN 2 THEN 'Table 3 ' ELSE '' END || line AS x, 0.02 * (1 + doc_id % 3) AS h,
  CASE (doc_id + region) % 7 WHEN 0 THEN 'heading' WHEN 1 THEN 'table' WHEN 2 THEN 'list_item' WHEN 3 THEN 'paragraph' END AS hint FROM t),
f AS (SELECT *, regexp_matches(x, '^\s*(\d+(?:\.\d+)*)(?:[.)]|\s)')::INT AS nh, regexp_matches(x, '^(\s*)(?:\d+[.)]|[a-zA-Z][.)])\s+')::INT AS ol, regexp_matches(x, '^(\s*)[-*•▪◦]\s+')::INT AS ul,
  regexp_matches(x, '(?i)^\s*(?:그림|표|사진|도표|figure|table)\s*\d+')::INT AS cap, (length(trim(x)) <= 48)::INT AS sh, regexp_matches(trim(x), '[.!?。！？다요음임함됨)]$')::INT AS term, (h >= 0.03 * 1.25)::INT AS big,
  (coalesce(hint, '') = 'heading')::INT AS hh, (coalesce(hint, '') = 'paragraph')::INT AS hp, (coalesce(hint, '') = 'table')::INT AS ht, (coalesce(hint, '') = 'list_item')::INT AS hl FROM b),
o AS (SELECT doc_id, region, 'paragraph' AS kind, least(0.96, 0.78 + (1 - sh) * 0.10 + term * 0.08 + hp * 0.04 - ht * 0.12 - hh * 0.08) AS score FROM f
 UNION ALL SELECT doc_id, region, 'heading', least(0.96, 0.44 + nh * 0.45 + big * 0.12 + hh * 0.44 + sh * 0.04 - term * 0.30) FROM f WHERE nh + hh + big > 0
 UNION ALL SELECT doc_id, region, 'list_item', least(0.96, 0.72 + greatest(ol, ul) * 0.20 + hl * 0.04 - hh * 0.20) FROM f WHERE greatest(ol, ul) + hl > 0
 UNION ALL SELECT doc_id, region, 'caption', 0.90 FROM f WHERE cap > 0 UNION ALL SELECT doc_id, region, 'table', 0.98 FROM f WHERE ht > 0)"""


def _blocks(spark, sf):
    """A block for every line of every document."""
    d = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("region", "line"))
    at = (F.col("doc_id") + F.col("region")) % 5
    lead = F.when(at == 0, "1.2 ").when(at == 1, "- ").when(at == 2, "Table 3 ").otherwise("")
    n = (F.col("doc_id") + F.col("region")) % 7
    hint = F.when(n == 0, "heading").when(n == 1, "table").when(n == 2, "list_item").when(n == 3, "paragraph")
    return d.select(F.col("doc_id").alias("doc"), "region", F.concat(lead, "line").alias("text"),
                    (F.lit(0.02) * (1 + F.col("doc_id") % 3)).alias("line_height"), F.lit(0.03).alias("typical_height"), hint.alias("hint"))


@R.add(f"WITH {BLOCK} SELECT doc_id AS doc, region::INT AS region, kind, round(score, 6)::DOUBLE AS score, (row_number() OVER (PARTITION BY doc_id, region ORDER BY round(score, 6) DESC, kind))::INT AS rank FROM o")
def block_candidates(spark, sf):
    """Scored alternatives of every line of every document."""
    return c.block_candidates(_blocks(spark, sf)).select("doc", "region", "kind", "score", "rank")


@R.add(f"""WITH {BLOCK}, r AS (SELECT doc_id, region, kind, round(score, 6)::DOUBLE AS score, row_number() OVER w AS n, coalesce(lead(round(score, 6)::DOUBLE) OVER w, 0) AS nxt FROM o WINDOW w AS (PARTITION BY doc_id, region ORDER BY round(score, 6) DESC, kind))
SELECT doc_id AS doc, region::INT AS region, CASE WHEN score >= 0.82 AND round(score - nxt, 9) >= 0.12 THEN 'selected' ELSE 'deferred' END AS outcome, kind AS candidate_id, score AS confidence FROM r WHERE n = 1""")
def decision_policy(spark, sf):
    """Automatic acceptance by score and margin."""
    x = c.block_candidates(_blocks(spark, sf)).select("doc", "region", F.col("kind").alias("candidate_id"), "score", F.lit(False).alias("proven"),
                                                     F.lit(None).cast("string").alias("signature"), F.lit(0).alias("defects"))
    return c.decide(x, ["doc", "region"])


@R.add("""WITH p AS (SELECT conv_id, turn, text AS src, f, CASE f WHEN 'source_spacing' THEN text WHEN 'punctuation_rules' THEN regexp_replace(text, ' ([,.])', '\\1', 'g') WHEN 'geometry_spacing' THEN replace(text, ',', ', ') ELSE replace(text, ' ', '') END AS x
  FROM conversations, (VALUES ('source_spacing'), ('punctuation_rules'), ('geometry_spacing'), ('dense_text')) AS v(f)),
n AS (SELECT *, array_to_string(list_filter([trim(regexp_replace(l, '[\\t\\x20\\x0b\\x0c]+', ' ', 'g')) FOR l IN string_split(x, chr(10))], lambda l: l <> ''), chr(10)) AS t FROM p),
a AS (SELECT conv_id, turn, t, max(CASE f WHEN 'source_spacing' THEN 0.45 WHEN 'geometry_spacing' THEN 0.62 WHEN 'punctuation_rules' THEN 0.70 ELSE 0.20 END) AS best, count(DISTINCT f) AS agree FROM n WHERE t <> '' GROUP BY 1, 2, 3)
SELECT conv_id AS doc, turn AS region, t AS text, round(least(0.99, best + (agree - 1) * 0.04), 6)::DOUBLE AS score FROM a""")
def spacing_candidates(spark, sf):
    """Proposals that agree are one candidate of a higher score."""
    t = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("region"), F.col("text").alias("source_text"))
    p = t.select("*", F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), x.alias("text")) for f, x in (
        ("source_spacing", F.col("source_text")), ("punctuation_rules", F.regexp_replace("source_text", " ([,.])", "$1")),
        ("geometry_spacing", F.regexp_replace("source_text", ",", ", ")), ("dense_text", F.regexp_replace("source_text", " ", "")))])).alias("p"))
    return c.spacing_candidates(p.select("doc", "region", "source_text", "p.feature", "p.text")).select("doc", "region", "text", "score")


@R.add("""WITH s AS (SELECT user_id, max_by(event_id, (value, event_id)) AS best FROM events GROUP BY 1), d AS (SELECT user_id, min(event_id) AS chosen FROM events WHERE event_type = 'click' GROUP BY 1)
SELECT s.user_id, coalesce(chosen, best) AS candidate_id FROM s LEFT JOIN d USING (user_id)""")
def selected_or_best(spark, sf):
    e = table(spark, sf, "events").select("user_id", F.col("event_id").alias("candidate_id"), F.col("value").alias("score"), "event_type")
    d = e.where("event_type = 'click'").groupBy("user_id").agg(F.min("candidate_id").alias("candidate_id"))
    return c.selected_or_best(e, d, ["user_id"])


@R.add("""SELECT conv_id AS doc, turn AS region FROM conversations WHERE turn % 3 <> 0 AND length(text) % 2 = 0""")
def trusted_decisions(spark, sf):
    """Cached decisions that match a set on seven keys and are among its candidates."""
    t = table(spark, sf, "conversations")
    base = [F.md5("text").alias("request_hash"), F.col("conv_id").cast("string").alias("source_hash"), F.lit("e").alias("evidence_hash"),
            F.col("turn").cast("string").alias("candidate_set_id"), F.col("turn").alias("region"), F.lit("p").alias("provider"), F.lit("m").alias("model")]
    sets = t.select(*base, F.array(F.lit("a"), F.lit("b")).alias("candidate_ids"))
    cached = t.select(F.col("conv_id").alias("doc"), *base, F.when(F.col("turn") % 3 == 0, "c").otherwise("a").alias("candidate_id"),
                      F.when(F.length("text") % 2 == 0, 0.9).otherwise(0.5).alias("confidence"))
    return c.trusted_matches(cached, sets).select("doc", "region")


def _accounts(spark, sf):
    t = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("item"))
    catalog = t
    excluded = t.where("item % 4 = 3")
    owned = t.where("item % 4 <> 3 AND (doc + item) % 5 <> 0").withColumn("owner", F.lit(1)).unionByName(t.where("item = 1 AND doc % 2 = 0").withColumn("owner", F.lit(2))).unionByName(
        t.where("item = 0 AND doc % 3 = 0").select("doc", (F.col("item") + 1000).alias("item"), F.lit(3).alias("owner")))
    return catalog, owned, excluded


ACCOUNTS = """c AS (SELECT conv_id AS doc, turn AS item FROM conversations), x AS (SELECT * FROM c WHERE item % 4 = 3),
a AS (SELECT * FROM c WHERE item % 4 <> 3 AND (doc + item) % 5 <> 0 UNION ALL SELECT * FROM c WHERE item = 1 AND doc % 2 = 0 UNION ALL SELECT doc, 1000 FROM c WHERE item = 0 AND doc % 3 = 0),
n AS (SELECT doc, item, count(*) AS n FROM a GROUP BY 1, 2)"""


@R.add(f"""WITH {ACCOUNTS}, j AS (SELECT coalesce(c.doc, n.doc) AS doc, c.item IS NOT NULL AS known, coalesce(n, 0) AS n, x.item IS NOT NULL AS out FROM c FULL JOIN n ON c.doc = n.doc AND c.item = n.item LEFT JOIN x ON x.doc = c.doc AND x.item = c.item),
g AS (SELECT doc, count(*) FILTER (known) AS items, count(*) FILTER (known AND out) AS excluded, count(*) FILTER (NOT known) AS unknown, count(*) FILTER (known AND (n > 1 OR (n = 1 AND out))) AS duplicated,
  count(*) FILTER (known AND NOT out AND n = 0) AS unmatched FROM j GROUP BY 1)
SELECT *, CASE WHEN items > excluded THEN round((items - excluded - unmatched) / (items - excluded)::DOUBLE, 6) ELSE 1.0 END AS ratio FROM g""")
def span_coverage_exact_once(spark, sf):
    return k.coverage(*_accounts(spark, sf))


@R.add(f"""WITH {ACCOUNTS}, o AS (SELECT doc, item AS position, row_number() OVER (PARTITION BY doc ORDER BY item) - 1 AS want FROM c WHERE item <> 2)
SELECT doc, 'INVARIANT_EVIDENCE_REFERENCE' AS code, count(*) AS n FROM a WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.doc = a.doc AND c.item = a.item) GROUP BY 1
UNION ALL SELECT doc, 'INVARIANT_ATOM_ALLOCATION_DUPLICATE', count(*) FROM n WHERE n > 1 GROUP BY 1
UNION ALL SELECT doc, 'INVARIANT_ATOM_ALLOCATION_MISSING', count(*) FROM c WHERE item % 4 <> 3 AND NOT EXISTS (SELECT 1 FROM a WHERE c.doc = a.doc AND c.item = a.item) GROUP BY 1
UNION ALL SELECT doc, 'INVARIANT_EXCLUSION_PROOF', count(*) FROM x WHERE item > 3 GROUP BY 1
UNION ALL SELECT doc, 'INVARIANT_READING_ORDER', count(*) FROM o WHERE position <> want GROUP BY 1""")
def canonical_invariants(spark, sf):
    catalog, owned, excluded = _accounts(spark, sf)
    order = catalog.where("item <> 2").select("doc", F.col("item").alias("position"))
    return k.invariant_findings(catalog, owned, excluded, excluded.where("item <= 3").select("doc", "item"), order)


def _cells(spark, sf, broken: bool = True):
    """A table for every conversation: a row for each turn, two columns, broken in some ways if wanted."""
    t = table(spark, sf, "conversations").select(F.col("conv_id").alias("table"), F.col("turn").cast("int").alias("r"), "role", "text")
    tables = t.groupBy("table").agg((F.max("r") + 1).alias("row_count")).withColumn("column_count", F.lit(2))
    first = F.col("r") == 0
    cells = t.withColumn("k", F.explode(F.array(F.lit(0), F.lit(1)))).select(
        "table", (F.col("r") * 2 + F.col("k")).alias("cell"), F.col("r").alias("start_row"),
        (F.col("r") + F.when(F.lit(broken) & (F.col("table") % 7 == 0) & first, 2).otherwise(1)).alias("end_row"), F.col("k").alias("start_column"),
        (F.col("k") + F.when(F.lit(broken) & (F.col("table") % 5 == 0) & first & (F.col("k") == 1), 2).otherwise(1)).alias("end_column"),
        F.when(F.col("k") == 0, F.col("role")).otherwise(F.concat(F.length("text").cast("string"), F.lit("|x"))).alias("text"), first.alias("header"))
    return cells.where("NOT (table % 3 = 0 AND cell = 1)") if broken else cells, tables


@R.add("""WITH l AS (SELECT conv_id AS t, count(*) AS n FROM conversations GROUP BY 1)
SELECT t AS "table", CASE WHEN t % 7 = 0 AND n = 1 OR t % 5 = 0 AND t % 3 <> 0 THEN 'TABLE_CELL_OUT_OF_BOUNDS' WHEN t % 7 = 0 THEN 'TABLE_GRID_OVERLAP' ELSE 'TABLE_GRID_NOT_PARTITIONED' END AS code
FROM l WHERE t % 7 = 0 OR (t % 5 = 0 AND t % 3 <> 0) OR t % 3 = 0""")
def grid_partition_check(spark, sf):
    return k.grid_findings(*_cells(spark, sf))


@R.add("""SELECT conv_id AS "table", turn::INT AS r, 1 AS k FROM conversations WHERE turn % 3 = conv_id % 3""")
def grid_completion(spark, sf):
    """Places that no cell covers."""
    cells, tables = _cells(spark, sf, broken=False)
    return k.complete_grid(cells.where("NOT (start_column = 1 AND start_row % 3 = table % 3)"), tables)


@R.add("""WITH l AS (SELECT conv_id AS t, turn AS n, '| ' || role || ' | ' || length(text) || '\\|x |' AS line FROM conversations)
SELECT t AS "table", max(CASE WHEN n = 0 THEN line END) || chr(10) || '| --- | --- |' || coalesce(chr(10) || string_agg(CASE WHEN n > 0 THEN line END, chr(10) ORDER BY n), '') AS markdown FROM l GROUP BY 1""")
def table_markdown(spark, sf):
    return k.table_markdown(*_cells(spark, sf, broken=False))


@R.add(r"""WITH b AS (SELECT conv_id, turn, regexp_replace(replace(text, chr(10), ' '), '([!-/:-@\[-`\{-~])', '\\\1', 'g') AS x, turn % 4 IN (1, 2) AS li FROM conversations),
l AS (SELECT conv_id, turn, li, coalesce(lag(li) OVER (PARTITION BY conv_id ORDER BY turn), false) AS before, CASE turn % 4 WHEN 0 THEN '## ' || x WHEN 3 THEN x ELSE '- ' || x END AS line FROM b)
SELECT conv_id AS doc, string_agg(CASE WHEN turn = 0 THEN '' WHEN li AND before THEN chr(10) ELSE chr(10) || chr(10) END || line, '' ORDER BY turn) || chr(10) AS markdown FROM l GROUP BY 1""")
def canonical_markdown(spark, sf):
    """Headings, list runs and paragraphs of every conversation."""
    n = F.col("turn") % 4
    b = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("order"),
                                                 F.when(n == 0, "heading").when(n == 3, "paragraph").otherwise("list_item").alias("kind"),
                                                 F.when(n == 0, 2).otherwise(0).alias("level"), F.regexp_replace("text", "\n", " ").alias("text"))
    return k.document_markdown(b)


@R.add(f"""WITH {ACCOUNTS}, u AS (SELECT doc, count(*) AS n FROM c WHERE item % 4 <> 3 AND NOT EXISTS (SELECT 1 FROM a WHERE c.doc = a.doc AND c.item = a.item) GROUP BY 1),
d AS (SELECT doc, count(*) AS n FROM n WHERE n > 1 OR item = 1000 GROUP BY 1)
SELECT doc, count(*) FILTER (item % 4 = 0) AS headings, count(*) FILTER (item % 4 <> 0) AS paragraphs, CASE WHEN max(u.n) > 0 OR max(d.n) > 0 THEN 'FAIL' WHEN count(*) FILTER (item % 6 = 5) > 0 THEN 'WARN' ELSE 'PASS' END AS status
FROM c LEFT JOIN u USING (doc) LEFT JOIN d USING (doc) GROUP BY 1""")
def fidelity_report(spark, sf):
    catalog, owned, excluded = _accounts(spark, sf)
    blocks = catalog.select("doc", F.when(F.col("item") % 4 == 0, "heading").otherwise("paragraph").alias("kind"), (F.col("item") % 6 == 5).alias("degraded"))
    return k.fidelity(blocks, k.coverage(catalog, owned, excluded)).select("doc", "headings", "paragraphs", "status")


@R.add("""SELECT user_id, min_by('E' || (event_id % 9), event_id) AS code FROM events WHERE value > 10 GROUP BY 1""")
def first_failure(spark, sf):
    e = table(spark, sf, "events").where("value > 10").select("user_id", "event_id", F.concat(F.lit("E"), (F.col("event_id") % 9).cast("string")).alias("code"))
    return k.first_failure(e, ["user_id"], "event_id", "code")


@R.add("""WITH a AS (SELECT conv_id AS doc, turn AS atom, turn % 7 AS ordinal, turn // 2 + 1 AS page FROM conversations), p AS (SELECT doc, max(page) - doc % 2 AS pc FROM a GROUP BY 1)
SELECT doc, 'ATOM_ORDINAL_DUPLICATE' AS code, count(*) AS n FROM (SELECT doc, ordinal FROM a GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1
UNION ALL SELECT doc, 'ATOM_PAGE_OUT_OF_RANGE', count(*) FROM a JOIN p USING (doc) WHERE page > pc GROUP BY 1
UNION ALL SELECT doc, 'REGION_ATOM_UNKNOWN', 1 FROM a WHERE atom = 0 GROUP BY 1
UNION ALL SELECT doc, 'ATOM_OWNED_TWICE', count(*) FROM a WHERE atom % 3 = 1 GROUP BY 1
UNION ALL SELECT doc, 'ATOM_NOT_OWNED', count(*) FROM a WHERE atom % 3 = 2 GROUP BY 1""")
def evidence_integrity(spark, sf):
    a = table(spark, sf, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("atom"), (F.col("turn") % 7).alias("ordinal"), (F.expr("turn div 2") + 1).alias("page"))
    pages = a.groupBy("doc").agg(F.max("page").alias("m")).select("doc", (F.col("m") - F.col("doc") % 2).alias("page_count"))
    own = a.where("atom % 3 <> 2").select("doc", F.lit(1).alias("region"), "atom").unionByName(a.where("atom % 3 = 1").select("doc", F.lit(2).alias("region"), "atom")).unionByName(
        a.where("atom = 0").select("doc", F.lit(1).alias("region"), F.lit(-1).cast("long").alias("atom")))
    return v.evidence_findings(a, own, pages)


@R.add("""WITH b AS (SELECT user_id AS candidate, event_id AS place, event_id % 17 AS idx, event_type, lag(event_id % 17) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events)
SELECT DISTINCT candidate, code FROM (SELECT candidate, 'CANDIDATE_MUTABLE_HARD_BOUNDARY' AS code FROM b WHERE event_type = 'click' AND place % 2 = 0 UNION ALL SELECT candidate, 'CANDIDATE_BOUNDARY_SEQUENCE_INVALID' FROM b WHERE idx <= before)""")
def boundary_checks(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("candidate"), F.col("event_id").alias("place"), (F.col("event_id") % 17).alias("idx"),
                                          F.when(F.col("event_type") == "click", "hard_break").otherwise("space").alias("state"), (F.col("event_id") % 2 == 0).alias("mutable"))
    return v.boundary_findings(e)


@R.add("""SELECT o_orderkey, CASE WHEN o_custkey % 5 = 0 THEN 'FAIL' WHEN o_custkey % 3 = 0 THEN 'WARN' ELSE 'PASS' END AS status FROM orders""")
def fidelity_status(spark, sf):
    zero = F.lit(0)
    return table(spark, sf, "orders").select("o_orderkey", v.fidelity_status((F.col("o_custkey") % 5 == 0).cast("int"), zero, (F.col("o_custkey") % 3 == 0).cast("int"), zero, zero).alias("status"))


@R.add("""SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'SEMANTIC_REPAIR_UNKNOWN_SPAN' WHEN value > 50 THEN 'SEMANTIC_REPAIR_ORDER_INVALID' END AS code FROM events""")
def plan_checks(spark, sf):
    """The first failed check of an ordered set."""
    return table(spark, sf, "events").select("event_id", v.plan_code({"SEMANTIC_REPAIR_UNKNOWN_SPAN": F.col("user_id") % 2 == 0, "SEMANTIC_REPAIR_ORDER_INVALID": F.col("value") > 50}).alias("code"))
