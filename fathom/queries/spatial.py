"""Box joins over boxes made from parts and line items, by pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions import geometry as g
from fathom.operators import spatial as sp

from .base import Registry, table

R = Registry()
QUERIES, ORACLE_SQL = R.queries, R.sql

# A box for every part: a page of a book of fifty, a place and an extent by key and size.
BOX = """p_partkey AS id, (p_partkey // 50)::VARCHAR AS doc, (p_partkey % 5)::INT AS page, (p_partkey * 37 % 100) / 100.0 AS l, (p_partkey * 53 % 100) / 100.0 AS b,
  (p_partkey * 37 % 100) / 100.0 + p_size / 60.0 AS r, (p_partkey * 53 % 100) / 100.0 + (p_size % 7) / 12.0 AS t"""
BOXES = f"x AS (SELECT l::DOUBLE AS l, b::DOUBLE AS b, r::DOUBLE AS r, t::DOUBLE AS t, id, doc, page FROM (SELECT {BOX} FROM part))"
MEET = """(CASE WHEN q.l = q.r AND i.l = i.r THEN q.l = i.l WHEN q.l = q.r OR i.l = i.r THEN q.l <= i.r AND i.l <= q.r ELSE q.l < i.r AND i.l < q.r END)
  AND (CASE WHEN q.b = q.t AND i.b = i.t THEN q.b = i.b WHEN q.b = q.t OR i.b = i.t THEN q.b <= i.t AND i.b <= q.t ELSE q.b < i.t AND i.b < q.t END)"""
COVER = "CASE WHEN (q.r - q.l) * (q.t - q.b) > 0 THEN greatest(0, least(q.r, i.r) - greatest(q.l, i.l)) * greatest(0, least(q.t, i.t) - greatest(q.b, i.b)) / ((q.r - q.l) * (q.t - q.b)) ELSE 0 END"
PAIRS = f"m AS (SELECT q.doc, q.page, q.id AS q_id, i.id AS i_id, {COVER} AS cover FROM x q JOIN x i ON q.doc = i.doc AND q.page = i.page AND q.id % 2 = 0 AND i.id % 2 = 1 WHERE {MEET})"


def _boxes(spark, sf):
    p = table(spark, sf, "part")
    l, b = (F.col("p_partkey") * 37 % 100) / 100.0, (F.col("p_partkey") * 53 % 100) / 100.0
    return p.select(F.col("p_partkey").alias("id"), F.expr("cast(p_partkey div 50 as string)").alias("doc"), (F.col("p_partkey") % 5).cast("int").alias("page"),
                    g.box(l, b, l + F.col("p_size") / 60.0, b + F.col("p_size") % 7 / 12.0).alias("box"))


def _sides(spark, sf):
    x = _boxes(spark, sf)
    q = x.where("id % 2 = 0").select("doc", "page", F.col("id").alias("q_id"), F.col("box").alias("q_box"))
    i = x.where("id % 2 = 1").select("doc", "page", F.col("id").alias("i_id"), F.col("box").alias("i_box"))
    return q, i


@R.add(f"""WITH {BOXES}, {PAIRS} SELECT doc, page, q_id, i_id, rank FROM (SELECT *, (row_number() OVER (PARTITION BY doc, page, q_id ORDER BY i_id))::INT AS rank FROM m) WHERE rank <= 3""")
def rect_intersection_limit(spark, sf):
    """At most three meeting boxes of each query box."""
    q, i = _sides(spark, sf)
    return sp.bounded_matches(q, i, ["doc", "page"], "q_id", "i_id", "q_box", "i_box", 3).select("doc", "page", "q_id", "i_id", "rank")


@R.add(f"""WITH {BOXES}, {PAIRS} SELECT doc, page, q_id, i_id, round(cover, 9) AS overlap FROM (SELECT *, row_number() OVER (PARTITION BY doc, page, q_id ORDER BY cover DESC, i_id DESC) AS n FROM m) WHERE n = 1""")
def rect_best_overlap(spark, sf):
    """The box that covers most of each query box; the largest id on ties."""
    q, i = _sides(spark, sf)
    return sp.best_overlap(q, i, ["doc", "page"], "q_id", "i_id", "q_box", "i_box").select("doc", "page", "q_id", "i_id", F.round("overlap", 9).alias("overlap"))


@R.add(f"""WITH {BOXES}, {PAIRS}, o AS (SELECT q_id, max(cover) AS cover FROM m GROUP BY 1)
SELECT id, CASE WHEN coalesce(cover, 0) >= 0.6 THEN 'drop' WHEN coalesce(cover, 0) > 0.2 THEN 'review' ELSE 'materialise' END AS action FROM x LEFT JOIN o ON q_id = id WHERE id % 2 = 0""")
def evidence_authority(spark, sf):
    """Recognised regions beside embedded ones of the same page."""
    x = _boxes(spark, sf)
    return sp.resolve_authority(x.where("id % 2 = 0"), x.where("id % 2 = 1"), ["doc", "page"], "id", "box").select("id", "action")


@R.add(f"""WITH {BOXES}, {PAIRS} SELECT doc, page, q_id, min(i_id) AS hint_order FROM m WHERE cover >= 0.5 GROUP BY 1, 2, 3""")
def hint_claims(spark, sf):
    """The first hint that covers half of a line claims it."""
    q, i = _sides(spark, sf)
    return sp.claim_by_hints(q, i.withColumnRenamed("i_id", "hint_order"), ["doc", "page"], "q_id", "q_box", "i_box")


@R.add(f"""WITH {BOXES}, {PAIRS}, h AS (SELECT doc, page, q_id, least(2, count(*)) AS n FROM m GROUP BY 1, 2, 3),
s AS (SELECT q.doc, q.page, q.q_id % 4 AS tab, q.q_id, coalesce(h.n, 0) AS n FROM (SELECT doc, page, id AS q_id FROM x WHERE id % 2 = 0) q LEFT JOIN h USING (doc, page, q_id))
SELECT doc, page, tab, bool_and(n = 1) AS accepted, count(*) AS spans FROM s GROUP BY 1, 2, 3""")
def exactly_one_cell(spark, sf):
    """Tables in which every span meets exactly one cell."""
    q, i = _sides(spark, sf)
    return sp.assign_exactly_once(q.withColumn("tab", F.col("q_id") % 4), i, ["doc", "page"], "q_id", "tab", "i_id", "q_box", "i_box")


@R.add(f"""WITH {BOXES} SELECT doc, page, id FROM x q WHERE NOT EXISTS (SELECT 1 FROM x i WHERE i.doc = q.doc AND i.page = q.page AND i.id <> q.id AND {MEET})""")
def without_overlap(spark, sf):
    x = _boxes(spark, sf)
    return sp.without_overlap(x, x, ["doc", "page"], "id", "box").select("doc", "page", "id")


@R.add(f"""WITH {BOXES}, z AS (SELECT q.*, i.l AS l2, i.b AS b2, i.r AS r2, i.t AS t2 FROM x q JOIN x i ON i.id = q.id + 1)
SELECT id, (least(t - b, t2 - b2) <= 0 OR greatest(0, least(t, t2) - greatest(b, b2)) / least(t - b, t2 - b2) >= 0.35) AS baseline,
  round(CASE WHEN least(r - l, r2 - l2) > 0 THEN greatest(0, least(r, r2) - greatest(l, l2)) / least(r - l, r2 - l2) ELSE 0 END, 9) AS across,
  round(pow((l + r) / 2 - (l2 + r2) / 2, 2) + pow((b + t) / 2 - (b2 + t2) / 2, 2), 9) AS distance,
  round(CASE WHEN least((r - l) * (t - b), (r2 - l2) * (t2 - b2)) > 0 THEN greatest(0, least(r, r2) - greatest(l, l2)) * greatest(0, least(t, t2) - greatest(b, b2)) / least((r - l) * (t - b), (r2 - l2) * (t2 - b2))
    ELSE (l = l2 AND b = b2 AND r = r2 AND t = t2)::INT END, 9) AS score FROM z""")
def box_measures(spark, sf):
    """Baselines, overlaps and distances of a part's box and the next one's."""
    x = _boxes(spark, sf).select("id", "box")
    j = x.join(x.select((F.col("id") - 1).alias("id"), F.col("box").alias("other")), "id")
    a, b = F.col("box"), F.col("other")
    return j.select("id", g.same_baseline(a, b).alias("baseline"), F.round(g.horizontal_overlap(a, b), 9).alias("across"),
                    F.round(g.center_distance(a, b), 9).alias("distance"), F.round(g.overlap_score(a, b), 9).alias("score"))


@R.add(f"""WITH {BOXES} SELECT id, round(least(1, greatest(0, l / 2)), 9) AS l, round(least(1, greatest(0, t / 2)), 9) AS t,
  (SELECT list_position(a, list_min(a)) - 1 FROM (SELECT [abs(0.1 - l), abs(0.5 - l), abs(0.9 - l)] AS a))::INT AS anchor FROM x""")
def page_fractions(spark, sf):
    """Boxes as fractions of a page twice as large, and the nearest of three anchors."""
    x = _boxes(spark, sf)
    page = g.box(F.lit(0), F.lit(0), F.lit(2), F.lit(2))
    anchors = F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))
    return x.select("id", g.page_fraction(F.col("box"), page).alias("f"), g.nearest_anchor(F.col("box.left"), anchors).alias("anchor")).select(
        "id", F.round("f.left", 9).alias("l"), F.round("f.top", 9).alias("t"), "anchor")


@R.add(f"""WITH {BOXES} SELECT doc, page, round(min(l), 9) AS l, round(min(b), 9) AS b, round(max(r), 9) AS r, round(max(t), 9) AS t FROM x GROUP BY 1, 2""")
def box_unions(spark, sf):
    return _boxes(spark, sf).groupBy("doc", "page").agg(g.union(F.col("box")).alias("u")).select(
        "doc", "page", *[F.round(f"u.{side}", 9).alias(side[0]) for side in ("left", "bottom", "right", "top")])
