"""Window-shaped operators over events, orders and conversations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fathom.operators import sequences as s
from fathom.operators.validation import continuation_valid

from .base import Registry, table

R = Registry()
QUERIES, ORACLE_SQL = R.queries, R.sql


@R.add("""WITH e AS (SELECT user_id, event_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
SELECT user_id, event_id, sum(CASE WHEN before IS NOT NULL AND ts - before > INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS island FROM e""")
def sequence_islands(spark, sf):
    """Runs of a user's events without a gap of six hours."""
    e = table(spark, sf, "events").select("user_id", "event_id", "ts")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = e.withColumn("before", F.lag("ts").over(w))
    return s.islands(e, ["user_id"], ["ts", "event_id"], F.col("ts") - F.col("before") > F.expr("INTERVAL 6 HOURS")).select("user_id", "event_id", "island")


@R.add("""WITH e AS (SELECT user_id, event_id, ts, event_type, lag(event_type) OVER w AS b, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, event_id, sum(CASE WHEN n > 1 AND b IS DISTINCT FROM event_type THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS run FROM e""")
def sequence_equal_runs(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    return s.equal_runs(e, ["user_id"], ["ts", "event_id"], "event_type").select("user_id", "event_id", "run")


@R.add("""SELECT l_orderkey, l_linenumber, (l_linenumber - row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber))::INT AS run FROM lineitem WHERE l_quantity > 10""")
def sequence_contiguous(spark, sf):
    l = table(spark, sf, "lineitem").where("l_quantity > 10").select("l_orderkey", "l_linenumber")
    return s.contiguous_runs(l, ["l_orderkey"], "l_linenumber")


FILL = "CASE WHEN event_type = 'click' THEN value END"


@R.add(f"""WITH e AS (SELECT user_id, event_id, ts, {FILL} AS v FROM events)
SELECT user_id, event_id, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING),
  first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS filled FROM e""")
def sequence_fill(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "ts", F.expr(FILL).alias("v"))
    return s.fill_forward(e, ["user_id"], ["ts", "event_id"], "v", "filled").select("user_id", "event_id", "filled")


@R.add(f"""WITH e AS (SELECT user_id, event_id, {FILL} AS v FROM events),
w AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS b,
  first_value(CASE WHEN v IS NOT NULL THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a FROM e)
SELECT w.user_id, w.event_id, x.v AS nearest FROM w LEFT JOIN e x ON x.event_id = CASE WHEN b IS NULL OR a - w.event_id < w.event_id - b THEN a ELSE b END""")
def sequence_nearest(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", F.expr(FILL).alias("v"))
    return s.nearest_value(e, ["user_id"], "event_id", "v", "nearest").select("user_id", "event_id", "nearest")


@R.add("""WITH l AS (SELECT l_orderkey, l_shipdate AS a, l_shipdate + INTERVAL 20 DAY AS b FROM lineitem),
m AS (SELECT *, max(b) OVER (PARTITION BY l_orderkey ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM l),
i AS (SELECT *, sum(CASE WHEN a > reach THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS island FROM m)
SELECT l_orderkey, min(a) AS a, max(b) AS b, count(*) AS members FROM i GROUP BY l_orderkey, island""")
def interval_merge(spark, sf):
    """Shipping windows of an order merged where they meet."""
    l = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_shipdate").alias("a"), (F.col("l_shipdate") + F.expr("INTERVAL 20 DAYS")).alias("b"))
    return s.merge_intervals(l, ["l_orderkey"], "a", "b")


@R.add("""SELECT event_type, event_id, value, rank FROM (SELECT *, (row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id))::INT AS rank FROM events) WHERE rank <= 5""")
def top5_candidates(spark, sf):
    e = table(spark, sf, "events").select("event_type", "event_id", "value")
    return s.top_rows(e, ["event_type"], [F.col("value").desc(), "event_id"])


@R.add("""SELECT conv_id, before, after, CASE WHEN p2 <> p THEN 'next_page' WHEN c2 <> c THEN 'next_column' ELSE 'same_column' END AS reason FROM (SELECT conv_id, turn AS before, lead(turn) OVER w AS after,
  turn // 4 AS p, lead(turn // 4) OVER w AS p2, turn // 2 AS c, lead(turn // 2) OVER w AS c2 FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE after IS NOT NULL""")
def reading_edges(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.expr("turn div 4").alias("p"), F.expr("turn div 2").alias("c"))
    return s.successor_edges(c, ["conv_id"], ["turn"], "turn", "p", "c")


@R.add("""WITH v AS (SELECT user_id, event_type, count(*) AS votes FROM events WHERE value >= 20 GROUP BY 1, 2 HAVING count(*) >= 2)
SELECT user_id, event_type, votes FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY votes DESC, event_type) AS n FROM v) WHERE n = 1""")
def majority_vote(spark, sf):
    return s.majority(table(spark, sf, "events"), ["user_id"], "event_type", "value", least=20.0)


@R.add("""SELECT a.conv_id, a.turn, a.role AS role, b.role AS next_role FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""")
def adjacent_pairs(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return s.adjacent_pairs(c, ["conv_id"], "turn").select(F.col("a.conv_id").alias("conv_id"), F.col("a.turn").alias("turn"), F.col("a.role").alias("role"), F.col("b.role").alias("next_role"))


@R.add("""WITH l AS (SELECT source, doc_id, string_split(text, chr(10)) AS x FROM documents), e AS (SELECT source, doc_id, 'top' AS edge, x[1] AS line FROM l UNION ALL SELECT source, doc_id, 'bottom', x[len(x)] FROM l),
n AS (SELECT source, count(*) AS pages FROM documents GROUP BY 1)
SELECT source, edge, line, count(DISTINCT doc_id) AS seen, max(pages) AS pages FROM e JOIN n USING (source) GROUP BY 1, 2, 3 HAVING count(DISTINCT doc_id) >= max(pages) * 0.03""")
def repeated_edge_lines(spark, sf):
    """First or last lines seen in 3 % of a source's documents."""
    d = table(spark, sf, "documents").select("source", "doc_id", F.split("text", "\n").alias("x"))
    n = d.groupBy("source").agg(F.count("*").alias("pages"))
    e = d.select("source", "doc_id", F.lit("top").alias("edge"), F.col("x")[0].alias("line")).unionByName(
        d.select("source", "doc_id", F.lit("bottom").alias("edge"), F.element_at("x", -1).alias("line")))
    return s.repeated_edges(e.join(n, "source"), "source", "doc_id", "edge", "line", "pages", 0.03)


@R.add("""SELECT conv_id AS doc, conv_id % 3 = 0 AND count(*) > 0 AS valid FROM conversations GROUP BY 1""")
def order_validity(spark, sf):
    """Whether an order names each turn once and respects succession: 1 in 3 is left intact."""
    c = table(spark, sf, "conversations")
    regions = c.select(F.col("conv_id").alias("doc"), F.col("turn").alias("region"))
    edges = c.select(F.col("conv_id").alias("doc"), F.col("turn").alias("before"), (F.col("turn") + 1).alias("after")).join(
        regions.select("doc", F.col("region").alias("after")), ["doc", "after"], "left_semi")
    first = F.col("doc") % 3
    orders = regions.withColumn("position", F.when(first == 1, -F.col("region")).otherwise(F.col("region"))).where(
        (first != 2) | (F.col("region") > 0))
    # A lone turn can't be out of order, so a stranger joins the second third.
    strange = regions.where((first == 1) & (F.col("region") == 0)).select("doc", F.lit(-99).cast("long").alias("region"), F.lit(999).cast("long").alias("position"))
    return s.order_is_valid(orders.unionByName(strange), regions, edges, "doc")


@R.add("""WITH x AS (SELECT l_orderkey, l_linenumber, l_suppkey % 3 AS w, row_number() OVER (PARTITION BY l_orderkey, l_suppkey % 3 ORDER BY l_linenumber) = 1 AS f FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN f THEN w ELSE max(w) OVER (PARTITION BY l_orderkey) + row_number() OVER (PARTITION BY l_orderkey, f ORDER BY w, l_linenumber) END AS slot FROM x""")
def next_free_slot(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 3).alias("w"))
    return s.next_free(l, ["l_orderkey"], "w", "l_linenumber").select("l_orderkey", "l_linenumber", "slot")


@R.add("""SELECT l_orderkey, l_linenumber, l_linenumber % 2 = 1 AND l_quantity % 3 = 0 AND l_discount * 10 >= 0.75 AS valid FROM lineitem""")
def continuation_checks(spark, sf):
    l = table(spark, sf, "lineitem")
    return l.select("l_orderkey", "l_linenumber", continuation_valid(F.col("l_discount") * 10, F.col("l_linenumber") % 2, F.col("l_quantity") % 3).alias("valid"))
