"""Audits of decisions, redaction, merged plans, table text, permissions and evidence keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.operators import audits as a

from .base import Registry, table

R = Registry()
QUERIES, ORACLE_SQL = R.queries, R.sql


def _name(x):
    return F.concat(F.lit("c"), x.cast("string"))


def _allowed(o):
    return o.select(F.col("o_orderkey").alias("decision_id"), F.explode(F.array(F.lit("c0"), F.lit("c1"), F.lit("g"))).alias("candidate_id"))


def _codes(when, code):
    return F.when(when, F.array(F.lit(code))).otherwise(F.expr("cast(array() as array<string>)"))


@R.add("""SELECT o_orderkey AS decision_id, o_orderkey % 17 <> 0 AND o_orderkey % 11 <> 0 AND (o_orderkey % 4 = 0 OR o_orderkey % 7 <> 0) AND o_orderkey % 5 <> 0
  AND o_orderkey % 3 <> 2 AND o_orderkey % 6 >= 2 AND o_orderkey % 13 <> 0 AND o_orderkey % 19 <> 0 AS matches FROM orders""")
def primary_audits(spark, sf):
    """Model decisions against their attempts; an order is a decision with one to four attempts."""
    key = F.col("o_orderkey")
    o = table(spark, sf, "orders").select("o_orderkey").withColumn("n", 1 + key % 4)
    score = 0.5 + (key % 6) / 10.0
    t = o.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    last = F.col("i") == F.col("n")
    attempts = t.select(
        key.alias("decision_id"), F.col("i").alias("position"), F.when((key % 11 == 0) & (F.col("i") == 1), "generation").otherwise("primary").alias("phase"),
        F.when(last, F.when(key % 5 == 0, "low_confidence").otherwise("accepted")).otherwise(F.when(key % 7 == 0, "accepted").otherwise("candidate_unknown")).alias("status"),
        _name(key % 3).alias("candidate_id"), score.alias("confidence"), _codes(last & (key % 13 == 0), "X").alias("codes"), (F.col("i") % 2).alias("retries"),
        (F.col("i") % 3 == 0).cast("long").alias("repairs"))
    decisions = o.select(
        key.alias("decision_id"), F.when(key % 17 == 0, "deterministic").when(key % 2 == 0, "model").otherwise("cache").alias("source"), _name(key % 3).alias("selected_id"),
        score.alias("confidence"), _codes(F.lit(False), "X").alias("codes"), (F.expr("(n + 1) div 2") + (key % 19 == 0).cast("long")).alias("retry_count"),
        F.expr("n div 3").alias("repair_count"))
    return a.with_attempts(decisions, attempts, _allowed(o)).select("decision_id", a.primary_matches(0.7).alias("matches"))


@R.add("""SELECT o_orderkey AS decision_id, o_orderkey % 17 <> 0 AND (o_orderkey % 2 = 0 OR o_orderkey % 7 <> 0) AND (o_orderkey % 5 <> 0 OR o_orderkey % 6 >= 2)
  AND o_orderkey % 13 <> 0 AND o_orderkey % 3 <> 0 AS matches FROM orders""")
def generated_audits(spark, sf):
    """Generated repairs against their attempts: one or two primary ones, a generation, a verification."""
    key = F.col("o_orderkey")
    o = table(spark, sf, "orders").select("o_orderkey").withColumn("n", 3 + key % 2)
    low, i = key % 6 < 2, F.col("i")
    t = o.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    before, made, seen = i == F.col("n") - 2, i == F.col("n") - 1, i == F.col("n")
    attempts = t.select(
        key.alias("decision_id"), i.alias("position"), F.when(made, "generation").when(seen, "verification").otherwise("primary").alias("phase"),
        F.when(before, F.when(low & (key % 5 != 0), "low_confidence").otherwise("accepted")).when(made | seen | (key % 7 == 0), "accepted").otherwise("candidate_unknown").alias("status"),
        F.when(made | seen, "g").otherwise("c1").alias("candidate_id"),
        F.when(made, 0.7 + (key % 4) / 10.0).when(seen, F.lit(0.9)).otherwise(0.5 + (key % 6) / 10.0).alias("confidence"),
        F.when(before & (key % 13 == 0), F.array(F.lit("X"))).otherwise(_codes(before & low, a.LOW_CODE)).alias("codes"), F.lit(1).cast("long").alias("retries"), F.lit(0).cast("long").alias("repairs"))
    decisions = o.select(
        key.alias("decision_id"), F.when(key % 17 == 0, "model").when(key % 2 == 0, "generated").otherwise("cache").alias("source"), F.lit("g").alias("generated_id"),
        F.when(key % 3 == 0, F.lit(0.1)).otherwise(F.least(0.7 + (key % 4) / 10.0, F.lit(0.9))).alias("confidence"), F.array(F.lit(a.REPAIRED_CODE)).alias("codes"),
        F.col("n").alias("retry_count"), F.lit(0).cast("long").alias("repair_count"))
    return a.with_attempts(decisions, attempts, _allowed(o)).select("decision_id", a.generated_matches(0.7).alias("matches"))


@R.add("SELECT conv_id, turn, role, sha256(text) AS text_hash FROM conversations")
def redacted_decisions(spark, sf):
    """Hashes in place of texts."""
    return a.redact(table(spark, sf, "conversations").select("conv_id", "turn", "role", "text"), ["text"])


@R.add("""SELECT (p_partkey // 50)::VARCHAR AS doc, p_partkey AS block_id, (row_number() OVER (PARTITION BY p_partkey // 50 ORDER BY p_partkey * 7 % 20, p_partkey) - 1)::INT AS "order" FROM part""")
def merged_plans(spark, sf):
    """Blocks of the batch plans of a document, by their first span."""
    p = table(spark, sf, "part").select(F.expr("cast(p_partkey div 50 as string)").alias("doc"), F.col("p_partkey").alias("block_id"))
    first = F.concat(F.lit("s"), F.col("block_id").cast("string"))
    spans = p.select("doc", first.alias("span_id"), (F.col("block_id") * 7 % 20).alias("position"))
    return a.merge_plans(p.withColumn("span_ids", F.array(first, F.lit("other"))), spans)


@R.add("""WITH l AS (SELECT conv_id AS t, turn AS n, CASE WHEN turn % 3 = 2 THEN '' ELSE role END || chr(9) || length(text) AS line FROM conversations)
SELECT t AS "table", string_agg(line, chr(10) ORDER BY n) AS text FROM l GROUP BY 1""")
def table_plain_texts(spark, sf):
    """A row for every turn; every third one lacks its first cell."""
    t = table(spark, sf, "conversations").select(F.col("conv_id").alias("table"), F.col("turn").cast("int").alias("start_row"), "role", "text")
    tables = t.groupBy("table").agg((F.max("start_row") + 1).alias("row_count")).withColumn("column_count", F.lit(2))
    cells = t.where("start_row % 3 <> 2").select("table", "start_row", F.lit(0).alias("start_column"), F.col("role").alias("text")).unionByName(
        t.select("table", "start_row", F.lit(1).alias("start_column"), F.length("text").cast("string").alias("text")))
    return a.table_text(cells, tables)


@R.add("""SELECT event_id, event_id % 6 IN (0, 2, 3) AS allowed FROM events""")
def writeback_paths(spark, sf):
    """Paths a release may write."""
    n, own = F.col("event_id") % 6, F.concat(F.lit("products/p"), F.col("user_id").cast("string"))
    path = (F.when(n == 0, "registry/tables.json").when(n == 1, "registry").when(n == 2, F.concat(own, F.lit("/product.yaml"))).when(n == 3, F.concat(own, F.lit("/quality/a.json")))
            .when(n == 4, "products/other/generated/a.json").otherwise(F.concat(own, F.lit("/generated/../x"))))
    return table(spark, sf, "events").select("event_id", a.writeback_allowed(path, F.concat(F.lit("p"), F.col("user_id").cast("string"))).alias("allowed"))


@R.add("""SELECT event_id, CASE WHEN event_type <> 'click' THEN 'LABEL_NOT_APPROVAL' WHEN user_id % 4 IN (0, 1) THEN 'AUTHORIZED' ELSE 'INSUFFICIENT_APPROVER_PERMISSION' END AS code FROM events""")
def label_codes(spark, sf):
    """Whether a label approves."""
    n = F.col("user_id") % 4
    who = F.when(n == 0, "Admin").when(n == 1, "write").when(n == 2, "read")
    label = F.when(F.col("event_type") == "click", "approved").otherwise(F.col("event_type"))
    return table(spark, sf, "events").select("event_id", a.label_code(who, label, "approved").alias("code"))


@R.add("""SELECT conv_id, turn, 'product-evidence-' || lpad((row_number() OVER (PARTITION BY conv_id ORDER BY turn))::VARCHAR, 6, '0') AS evidence_id,
  CASE WHEN turn % 2 = 0 THEN '{"turn":"' || turn || '"}' ELSE '{"role":"' || role || '","turn":"' || turn || '"}' END AS locator FROM conversations""")
def evidence_keys(spark, sf):
    """Evidence ids by place, and the locator that two evidences are compared by."""
    turn = F.col("turn").cast("string")
    e = a.evidence_ids(table(spark, sf, "conversations"), "conv_id", "turn")
    locator = F.create_map(F.lit("turn"), turn, F.lit("role"), F.when(F.col("turn") % 2 == 1, F.col("role")))
    key = a.evidence_key(F.md5("text"), F.col("role"), locator, F.col("text"))
    return e.select("conv_id", "turn", "evidence_id", key["locator"].alias("locator"))
