"""Identity, registry, versions and findings over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions import versions
from fathom.operators import identity, registry, validation
from fathom.sources import forms

from .base import Registry, table

R = Registry()
QUERIES, ORACLE_SQL = R.queries, R.sql

TABLES = [("p1", "t_cust", "pg", "shop", "sales", "customer"), ("p1", "t_ord", "pg", "shop", "sales", "orders"),
          ("p1", "t_item", "pg", "shop", "sales", "lineitem"), ("p1", "t_ord2", "pg", "shop", "archive", "orders"),
          ("p2", "u_ord", "pg", "shop", "sales", "orders"), ("p2", "u_cust", "pg", "shop", "sales", "customer")]
COLUMNS = [("p1", "t_cust", "c1", "c_custkey", None), ("p1", "t_ord", "c2", "o_orderkey", None),
           ("p1", "t_ord", "c3", "o_custkey", "Customer.C_CUSTKEY"), ("p1", "t_item", "c4", "l_orderkey", "orders.o_orderkey"),
           ("p1", "t_item", "c5", "l_orderkey2", "shop.sales.orders.O_ORDERKEY"), ("p1", "t_item", "c6", "l_x", "pg|shop|sales|orders.o_orderkey"),
           ("p1", "t_item", "c7", "l_bad", "nodot"), ("p1", "t_item", "c8", "l_gone", "supplier.s_suppkey"),
           ("p1", "t_item", "c9", "l_gone2", "customer.nothing"), ("p2", "u_ord", "d1", "o_custkey", "customer.c_custkey"),
           ("p2", "u_cust", "d2", "c_custkey", None)]
RESOLVED = [("c3", "t_cust", "c1", "orders_o_custkey_to_customer_c_custkey", "RESOLVED"), ("c4", None, None, None, "FOREIGN_KEY_TARGET_AMBIGUOUS"),
            ("c5", "t_ord", "c2", "lineitem_l_orderkey2_to_orders_o_orderkey", "RESOLVED"),
            ("c6", "t_ord", "c2", "lineitem_l_x_to_orders_o_orderkey", "RESOLVED"), ("c7", None, None, None, "FOREIGN_KEY_FORMAT_INVALID"),
            ("c8", None, None, None, "FOREIGN_KEY_TARGET_NOT_FOUND"), ("c9", None, None, None, "FOREIGN_KEY_TARGET_NOT_FOUND"),
            ("d1", "u_cust", "d2", "orders_o_custkey_to_customer_c_custkey", "RESOLVED")]


def _values(rows, names: str) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        return str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"

    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(lit(v) for v in r) + ')' for r in rows)}) AS t({names})"


@R.add(_values(RESOLVED, "column_id, target_table_id, target_column_id, relationship, code"))
def fk_resolution(spark, sf):
    """Declared foreign keys of two products, by all three forms of a table name."""
    tables = spark.createDataFrame(TABLES, "product_id string, table_id string, source_system string, catalog string, schema_name string, table_name string")
    columns = spark.createDataFrame(COLUMNS, "product_id string, table_id string, column_id string, column_name string, foreign_key string")
    return identity.resolve_foreign_keys(tables, columns).select("column_id", "target_table_id", "target_column_id", "relationship", "code")


@R.add("""SELECT 'orders' AS child, count(*) AS orphans FROM orders WHERE o_custkey % 7 = 0 OR o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0)
UNION ALL SELECT 'lineitem', count(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderkey % 5 <> 0)""")
def fk_orphans(spark, sf):
    """Rows whose key no parent has, with some parents taken away."""
    orders, items = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    a = validation.orphans(orders, table(spark, sf, "customer").where("c_custkey % 7 <> 0"), [("o_custkey", "c_custkey")])
    b = validation.orphans(items, orders.where("o_orderkey % 5 <> 0"), [("l_orderkey", "o_orderkey")])
    return a.agg(F.lit("orders").alias("child"), F.count("*").alias("orphans")).unionByName(
        b.agg(F.lit("lineitem").alias("child"), F.count("*").alias("orphans")))


@R.add("""WITH e AS (SELECT p_brand, 'col_' || p_partkey AS column_id, p_name AS name, 'alias ' || p_partkey AS alias,
  CASE WHEN p_size % 9 = 0 THEN 'RETIRED' ELSE 'ACTIVE' END AS status FROM part WHERE p_partkey % 3 <> 0),
k AS (SELECT p_brand, lower(name) AS key, column_id, status FROM e UNION SELECT p_brand, lower(alias), column_id, status FROM e),
f AS (SELECT p_brand, key, column_id, status FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, key ORDER BY column_id) AS n FROM k) WHERE n = 1),
c AS (SELECT p_brand, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE 'Alias ' || p_partkey END AS name FROM part WHERE p_partkey % 5 <> 0),
m AS (SELECT c.p_brand, c.name, f.column_id, CASE WHEN f.column_id IS NULL THEN 'NEW' WHEN status = 'RETIRED' THEN 'RETIRED_COLUMN_REUSE' ELSE 'KEPT' END AS code
  FROM c LEFT JOIN f ON c.p_brand = f.p_brand AND lower(c.name) = f.key)
SELECT * FROM m UNION ALL SELECT p_brand, name, column_id, 'RETIRED' FROM e WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.p_brand = e.p_brand AND m.column_id = e.column_id)""")
def column_identity(spark, sf):
    """Names matched to existing ones or their aliases, within a brand."""
    p = table(spark, sf, "part")
    existing = p.where("p_partkey % 3 <> 0").select(
        "p_brand", F.concat(F.lit("col_"), F.col("p_partkey").cast("string")).alias("column_id"), F.col("p_name").alias("name"),
        F.array(F.concat(F.lit("alias "), F.col("p_partkey").cast("string"))).alias("aliases"),
        F.when(F.col("p_size") % 9 == 0, "RETIRED").otherwise("ACTIVE").alias("status"))
    wanted = p.where("p_partkey % 5 <> 0").select("p_brand", F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(
        F.concat(F.lit("Alias "), F.col("p_partkey").cast("string"))).alias("name"))
    return identity.match_named(wanted, existing, ["p_brand"], "column_id").select("p_brand", "name", "column_id", "code")


def _products(spark, sf):
    p = table(spark, sf, "part")
    key = F.col("p_partkey").cast("string")
    existing = p.where("p_partkey % 2 = 0").select(
        F.concat(F.lit("prd_"), key).alias("product_id"), F.concat(F.lit("key-"), key).alias("product_key"),
        F.when(F.col("p_size") % 10 == 0, "RETIRED").otherwise("ACTIVE").alias("status"), F.md5(F.concat(F.lit("c"), key)).alias("canonical_hash"),
        F.array(F.concat(F.lit("old-"), key)).alias("aliases"))
    n = F.col("p_partkey") % 12
    new = F.concat(F.lit("new_"), key)
    candidates = p.select(
        F.col("p_partkey").alias("candidate_id"), F.when(n.isin(0, 2, 4), F.concat(F.lit("prd_"), key)).otherwise(new).alias("product_id"),
        F.when(n.isin(0, 2, 6), F.concat(F.lit("key-"), key)).when(n == 8, F.concat(F.lit("old-"), key)).otherwise(F.concat(F.lit("fresh-"), key)).alias("product_key"),
        F.lit("ACTIVE").alias("status"), F.when(n.isin(0, 10), F.md5(F.concat(F.lit("c"), key))).otherwise(F.md5(new)).alias("canonical_hash"),
        F.when(n.isin(0, 2, 4, 5), "update").otherwise("create").alias("operation"))
    return candidates, existing


PRODUCTS_SQL = """WITH e AS (SELECT 'prd_' || p_partkey AS product_id, 'key-' || p_partkey AS product_key, CASE WHEN p_size % 10 = 0 THEN 'RETIRED' ELSE 'ACTIVE' END AS status,
  md5('c' || p_partkey) AS canonical_hash, 'old-' || p_partkey AS alias FROM part WHERE p_partkey % 2 = 0),
c AS (SELECT p_partkey AS candidate_id, CASE WHEN n IN (0, 2, 4) THEN 'prd_' || p_partkey ELSE 'new_' || p_partkey END AS product_id,
  CASE WHEN n IN (0, 2, 6) THEN 'key-' || p_partkey WHEN n = 8 THEN 'old-' || p_partkey ELSE 'fresh-' || p_partkey END AS product_key,
  CASE WHEN n IN (0, 10) THEN md5('c' || p_partkey) ELSE md5('new_' || p_partkey) END AS canonical_hash,
  CASE WHEN n IN (0, 2, 4, 5) THEN 'update' ELSE 'create' END AS operation FROM (SELECT *, p_partkey % 12 AS n FROM part)),
j AS (SELECT c.*, i.product_id AS known, i.product_key AS known_key, i.status AS known_status, i.canonical_hash AS known_hash, k.product_id AS k_id, a.product_id AS a_id, h.product_id AS h_id
  FROM c LEFT JOIN e i ON i.product_id = c.product_id LEFT JOIN e k ON k.product_key = c.product_key LEFT JOIN e a ON a.alias = c.product_key LEFT JOIN e h ON h.canonical_hash = c.canonical_hash),
x AS (SELECT *, CASE WHEN operation <> 'create' THEN CASE WHEN known IS NULL THEN 'PRODUCT_ID_NOT_FOUND' WHEN known_status = 'RETIRED' THEN 'RETIRED_ID_REUSE'
    WHEN product_key <> known_key THEN 'PRODUCT_ID_KEY_CONFLICT' WHEN canonical_hash = known_hash THEN 'PRODUCT_NO_CHANGE' ELSE 'PRODUCT_UPDATE' END
  WHEN known IS NOT NULL THEN 'PRODUCT_ID_CONFLICT' WHEN k_id IS NOT NULL THEN 'PRODUCT_KEY_CONFLICT' WHEN a_id IS NOT NULL THEN 'PRODUCT_ALIAS_CONFLICT'
  WHEN h_id IS NOT NULL THEN 'PRODUCT_CONTENT_DUPLICATE' ELSE 'PRODUCT_CREATE' END AS code FROM j)
SELECT candidate_id, code, CASE code WHEN 'PRODUCT_NO_CHANGE' THEN 'NO_CHANGE' WHEN 'PRODUCT_UPDATE' THEN 'UPDATE' WHEN 'PRODUCT_CREATE' THEN 'CREATE' ELSE 'BLOCK' END AS decision,
  CASE code WHEN 'PRODUCT_KEY_CONFLICT' THEN k_id WHEN 'PRODUCT_ALIAS_CONFLICT' THEN a_id WHEN 'PRODUCT_CONTENT_DUPLICATE' THEN h_id ELSE known END AS target_id FROM x"""


@R.add(PRODUCTS_SQL)
def product_duplicates(spark, sf):
    """Every candidate product against a registry of the same size: four joins, one cascade."""
    return identity.classify_products(*_products(spark, sf))


@R.add("""WITH e AS (SELECT 'tbl_' || p_partkey AS table_id, 'loc' || p_partkey AS locator, CASE WHEN p_size % 10 = 0 THEN 'RETIRED' ELSE 'ACTIVE' END AS status,
  md5('c' || p_partkey) AS ch, md5(p_brand) AS sh FROM part WHERE p_partkey % 2 = 0),
c AS (SELECT p_partkey AS candidate_id, CASE WHEN n < 3 THEN 'tbl_' ELSE 'new_' END || p_partkey AS table_id, CASE WHEN n IN (0, 1, 3) THEN 'loc' ELSE 'other' END || p_partkey AS locator,
  CASE WHEN n = 0 THEN md5('c' || p_partkey) ELSE md5('x' || p_partkey) END AS ch, CASE WHEN n = 4 THEN md5(p_brand) ELSE md5('s' || p_partkey) END AS sh FROM (SELECT *, (p_partkey // 2) % 6 AS n FROM part)),
s AS (SELECT sh, count(DISTINCT table_id) AS clones FROM e GROUP BY sh),
j AS (SELECT c.*, i.table_id AS known, i.locator AS kl, i.status AS ks, i.ch AS kh, l.table_id AS l_id, l.status AS ls, s.clones FROM c LEFT JOIN e i ON i.table_id = c.table_id
  LEFT JOIN e l ON l.locator = c.locator LEFT JOIN s ON s.sh = c.sh),
x AS (SELECT *, CASE WHEN known IS NOT NULL AND ks = 'RETIRED' THEN 'RETIRED_ID_REUSE' WHEN known IS NOT NULL AND kl <> locator THEN 'TABLE_ID_LOCATOR_CONFLICT' WHEN kh = ch THEN 'TABLE_NO_CHANGE'
  WHEN known IS NOT NULL THEN 'TABLE_UPDATE' WHEN ls = 'RETIRED' THEN 'RETIRED_ID_REUSE' WHEN l_id IS NOT NULL THEN 'TABLE_LOCATOR_REUSE' WHEN clones IS NOT NULL THEN 'POSSIBLE_CLONE' ELSE 'TABLE_CREATE' END AS code FROM j)
SELECT candidate_id, code, CASE code WHEN 'TABLE_NO_CHANGE' THEN 'NO_CHANGE' WHEN 'TABLE_UPDATE' THEN 'UPDATE' WHEN 'TABLE_CREATE' THEN 'CREATE' WHEN 'TABLE_LOCATOR_REUSE' THEN 'REUSE'
  WHEN 'POSSIBLE_CLONE' THEN 'WARN' ELSE 'BLOCK' END AS decision, coalesce(known, CASE WHEN code IN ('RETIRED_ID_REUSE', 'TABLE_LOCATOR_REUSE') THEN l_id END) AS target_id,
  CASE WHEN code = 'POSSIBLE_CLONE' THEN clones ELSE 0 END::BIGINT AS clones FROM x""")
def table_duplicates(spark, sf):
    p = table(spark, sf, "part")
    key = F.col("p_partkey").cast("string")
    existing = p.where("p_partkey % 2 = 0").select(
        F.concat(F.lit("tbl_"), key).alias("table_id"), F.concat(F.lit("loc"), key).alias("locator"),
        F.when(F.col("p_size") % 10 == 0, "RETIRED").otherwise("ACTIVE").alias("status"), F.md5(F.concat(F.lit("c"), key)).alias("canonical_hash"),
        F.md5("p_brand").alias("schema_hash"))
    n = F.expr("(p_partkey div 2) % 6")
    candidates = p.select(
        F.col("p_partkey").alias("candidate_id"), F.concat(F.when(n < 3, "tbl_").otherwise("new_"), key).alias("table_id"),
        F.concat(F.when(n.isin(0, 1, 3), "loc").otherwise("other"), key).alias("locator"), F.lit("ACTIVE").alias("status"),
        F.md5(F.concat(F.when(n == 0, "c").otherwise("x"), key)).alias("canonical_hash"),
        F.when(n == 4, F.md5("p_brand")).otherwise(F.md5(F.concat(F.lit("s"), key))).alias("schema_hash"))
    return identity.classify_tables(candidates, existing).select(
        "candidate_id", "decision", "code", "target_id", "clones")


@R.add("""WITH l AS (SELECT DISTINCT l_partkey, l_suppkey, l_linenumber FROM lineitem), e AS (SELECT * FROM l WHERE l_linenumber < 3)
SELECT l.l_partkey, l.l_suppkey, l.l_linenumber, e.l_partkey IS NULL AS is_new, CASE WHEN e.l_partkey IS NULL THEN 'new' ELSE 'lnk_' || l.l_partkey || '_' || l.l_suppkey || '_' || l.l_linenumber END AS link_id
FROM l LEFT JOIN e USING (l_partkey, l_suppkey, l_linenumber)""")
def mapping_reuse(spark, sf):
    """Link ids kept on (product, table, usage); new ones for the rest."""
    l = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("product_id"), F.col("l_partkey").alias("table_id"), F.col("l_linenumber").alias("usage")).distinct()
    known = l.where("usage < 3").withColumn("link_id", F.concat_ws("_", F.lit("lnk"), "table_id", "product_id", "usage"))
    return identity.reuse_links(l, known, F.lit("new")).select(
        F.col("table_id").alias("l_partkey"), F.col("product_id").alias("l_suppkey"), F.col("usage").alias("l_linenumber"), "is_new", "link_id")


@R.add("""SELECT l_partkey AS table_id, list_sort(list(DISTINCT l_suppkey)) AS required_product_ids, count(DISTINCT l_suppkey) > 1 AS shared FROM lineitem GROUP BY 1""")
def impact_shared(spark, sf):
    """Products that use each table."""
    return registry.impact(table(spark, sf, "lineitem").select(F.col("l_partkey").alias("table_id"), F.col("l_suppkey").alias("product_id")))


@R.add("""SELECT l_orderkey AS changeset_id, CASE WHEN count(DISTINCT l_suppkey) = count(DISTINCT CASE WHEN l_returnflag <> 'R' THEN l_suppkey END) THEN 'ready' ELSE 'blocked' END AS status
FROM lineitem GROUP BY 1""")
def changeset_status(spark, sf):
    """A changeset is ready when the ready products are the required ones."""
    sets = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("changeset_id")).agg(
        F.sort_array(F.collect_set("l_suppkey")).alias("required_product_ids"),
        F.collect_set(F.when(F.col("l_returnflag") != "R", F.col("l_suppkey"))).alias("ready_product_ids"))
    return registry.changeset_status(sets).select("changeset_id", "status")


VERSION_INPUT = """SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN (o_orderkey % 1000)::INT END AS cur, o_custkey % 2 = 0 AS chg,
  CASE WHEN o_orderkey % 4 <> 0 AND o_orderkey % 7 <> 0 THEN (o_orderkey % 1000)::INT END AS base, CASE WHEN o_orderkey % 3 <> 0 THEN (o_orderkey % 1000 + o_custkey % 3)::INT END AS prop FROM orders"""


@R.add(f"""WITH v AS ({VERSION_INPUT}), e AS (SELECT *, CASE WHEN cur IS NULL THEN 1 WHEN NOT chg THEN cur WHEN cur < 999 THEN cur + 1 END AS expected,
  coalesce(cur NOT BETWEEN 1 AND 999, false) OR coalesce(base NOT BETWEEN 1 AND 999, false) OR coalesce(prop NOT BETWEEN 1 AND 999, false) AS bad FROM v),
c AS (SELECT *, CASE WHEN bad THEN 'INVALID_VERSION' WHEN base IS DISTINCT FROM cur THEN 'VERSION_STALE'
  WHEN cur IS NULL THEN CASE WHEN prop IS NULL OR prop = 1 THEN 'NEW_V1' ELSE 'VERSION_GAP' END
  WHEN NOT chg THEN CASE WHEN prop IS NULL OR prop = cur THEN 'NO_CHANGE' ELSE 'VERSION_NO_CHANGE' END
  WHEN expected IS NULL THEN 'VERSION_LIMIT_REACHED' WHEN prop IS NULL OR prop = expected THEN 'ADVANCE' WHEN prop <= cur THEN 'VERSION_COLLISION' ELSE 'VERSION_GAP' END AS code FROM e)
SELECT o_orderkey, code, CASE WHEN code IN ('NEW_V1', 'NO_CHANGE', 'ADVANCE') THEN 'ALLOW' ELSE 'BLOCK' END AS outcome, CASE WHEN code <> 'INVALID_VERSION' THEN expected END AS expected FROM c""")
def version_plan(spark, sf):
    """The version planner over states derived from orders."""
    o = table(spark, sf, "orders")
    cur = F.when(F.col("o_orderkey") % 4 != 0, (F.col("o_orderkey") % 1000).cast("int"))
    base = F.when((F.col("o_orderkey") % 4 != 0) & (F.col("o_orderkey") % 7 != 0), (F.col("o_orderkey") % 1000).cast("int"))
    prop = F.when(F.col("o_orderkey") % 3 != 0, (F.col("o_orderkey") % 1000 + F.col("o_custkey") % 3).cast("int"))
    return o.select("o_orderkey", versions.plan_version(cur, F.col("o_custkey") % 2 == 0, base, prop).alias("p")).select(
        "o_orderkey", "p.outcome", "p.code", "p.expected")


@R.add("""WITH d AS (SELECT source, doc_id, CASE WHEN quality = 1 THEN lang END AS description FROM documents LEFT JOIN labels USING (doc_id))
SELECT source AS product_id, round(avg((coalesce(length(trim(description)), 0) > 0)::INT::DOUBLE), 4) AS score,
  count(*) FILTER (coalesce(length(trim(description)), 0) = 0) AS missing FROM d GROUP BY 1""")
def completeness_score(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return registry.completeness(d.select(F.col("source").alias("product_id"), F.when(F.col("quality") == 1, F.col("lang")).alias("description")))


@R.add("""WITH r AS (SELECT 'prd' || c_custkey AS product_id, 'k' || c_custkey AS product_key, 'k' || (c_custkey + 1) AS alias, CASE WHEN c_nationkey = 3 THEN 'RETIRED' ELSE 'ACTIVE' END AS status FROM customer WHERE c_custkey % 2 = 0),
w AS (SELECT 'prd' || c_custkey AS product_id, 'k' || c_custkey AS product_key FROM customer)
SELECT w.product_id, 'RETIRED_ID_REUSE' AS code FROM w JOIN r USING (product_id) WHERE r.status = 'RETIRED'
UNION ALL SELECT DISTINCT w.product_id, 'PRODUCT_KEY_CONFLICT' FROM w JOIN (SELECT product_id, product_key AS n FROM r UNION ALL SELECT product_id, alias FROM r) r ON r.n = w.product_key AND r.product_id <> w.product_id""")
def product_write_checks(spark, sf):
    c, key = table(spark, sf, "customer"), F.col("c_custkey")
    writes = c.select(F.concat(F.lit("prd"), key.cast("string")).alias("product_id"), F.concat(F.lit("k"), key.cast("string")).alias("product_key"), F.lit("ACTIVE").alias("status"))
    known = c.where("c_custkey % 2 = 0").select(
        F.concat(F.lit("prd"), key.cast("string")).alias("product_id"), F.concat(F.lit("k"), key.cast("string")).alias("product_key"),
        F.array(F.concat(F.lit("k"), (key + 1).cast("string"))).alias("aliases"), F.when(F.col("c_nationkey") == 3, "RETIRED").otherwise("ACTIVE").alias("status"))
    return registry.product_write_findings(writes, known)


@R.add("""WITH r AS (SELECT 't' || s_suppkey AS table_id, 'l' || (s_suppkey // 2) AS locator, CASE WHEN s_nationkey < 5 THEN 'RETIRED' ELSE 'ACTIVE' END AS status FROM supplier),
w AS (SELECT 't' || s_suppkey AS table_id, 'l' || (s_suppkey // 2) AS locator FROM supplier WHERE s_suppkey % 3 = 0)
SELECT w.table_id, 'RETIRED_ID_REUSE' AS code FROM w JOIN r USING (table_id) WHERE status = 'RETIRED'
UNION ALL SELECT DISTINCT w.table_id, 'TABLE_LOCATOR_CONFLICT' FROM w JOIN r USING (locator) WHERE r.table_id <> w.table_id""")
def table_write_checks(spark, sf):
    s, key = table(spark, sf, "supplier"), F.col("s_suppkey")
    known = s.select(F.concat(F.lit("t"), key.cast("string")).alias("table_id"), F.concat(F.lit("l"), F.expr("cast(s_suppkey div 2 as string)")).alias("locator"),
                     F.when(F.col("s_nationkey") < 5, "RETIRED").otherwise("ACTIVE").alias("status"))
    writes = s.where("s_suppkey % 3 = 0").select(F.concat(F.lit("t"), key.cast("string")).alias("table_id"), F.concat(F.lit("l"), F.expr("cast(s_suppkey div 2 as string)")).alias("locator"),
                                                 F.lit("ACTIVE").alias("status"))
    return registry.table_write_findings(writes, known)


@R.add("""SELECT l_orderkey || '-' || l_linenumber AS link_id, CASE WHEN l_suppkey % 10 = 0 THEN 'MAPPING_PRODUCT_NOT_FOUND' WHEN l_partkey % 11 = 0 THEN 'MAPPING_TABLE_NOT_FOUND' ELSE 'MAPPING_TABLE_VERSION_MISMATCH' END AS code
FROM lineitem WHERE l_suppkey % 10 = 0 OR l_partkey % 11 = 0 OR l_linenumber = 7""")
def mapping_checks(spark, sf):
    l = table(spark, sf, "lineitem")
    parts = table(spark, sf, "part").where("p_partkey % 11 <> 0").select(F.col("p_partkey").alias("table_id"), F.col("p_size").alias("version"))
    size = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size")
    links = l.join(size, "l_partkey").select(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("link_id"), F.col("l_suppkey").alias("product_id"),
                                             F.col("l_partkey").alias("table_id"), (F.col("p_size") + F.when(F.col("l_linenumber") == 7, 1).otherwise(0)).alias("table_version"))
    products = table(spark, sf, "supplier").where("s_suppkey % 10 <> 0").select(F.col("s_suppkey").alias("product_id"))
    return registry.mapping_findings(links, products, parts)


@R.add("""SELECT 'product-keys' AS index, c_name AS key, 'prd' || c_custkey AS id FROM customer UNION ALL SELECT 'table-locators', s_name, 'tbl' || s_suppkey FROM supplier""")
def registry_indexes(spark, sf):
    p = table(spark, sf, "customer").select(F.col("c_name").alias("product_key"), F.concat(F.lit("prd"), F.col("c_custkey").cast("string")).alias("product_id"))
    t = table(spark, sf, "supplier").select(F.col("s_name").alias("locator"), F.concat(F.lit("tbl"), F.col("s_suppkey").cast("string")).alias("table_id"))
    return registry.indexes(p, t)


@R.add("""WITH sh AS (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1),
c AS (SELECT DISTINCT l_suppkey AS product_id, l_partkey AS table_id, CASE WHEN l_linenumber % 3 <> 0 THEN l_linenumber % 5 END AS cs, CASE WHEN l_linenumber < 5 THEN l_linenumber END AS pr FROM lineitem WHERE l_partkey IN (SELECT * FROM sh)),
f AS (SELECT product_id, table_id, unnest(list_filter([CASE WHEN cs IS NULL THEN 'SHARED_TABLE_CHANGESET_REQUIRED' WHEN cs = 4 THEN 'CHANGESET_NOT_FOUND' END,
  CASE WHEN cs < 4 AND product_id % 4 <> cs THEN 'CHANGESET_PRODUCT_NOT_REQUIRED' END, CASE WHEN cs < 4 AND table_id % 4 <> cs THEN 'CHANGESET_TABLE_NOT_INCLUDED' END,
  CASE WHEN cs < 4 AND coalesce(pr, 0) < 1 THEN 'CHANGESET_PR_NUMBER_REQUIRED' END], lambda x: x IS NOT NULL)) AS code FROM c)
SELECT DISTINCT product_id, table_id, code FROM f""")
def shared_table_checks(spark, sf):
    l = table(spark, sf, "lineitem")
    n = F.col("l_linenumber")
    changes = l.select(F.col("l_suppkey").alias("product_id"), F.col("l_partkey").alias("table_id"), F.when(n % 3 != 0, n % 5).alias("changeset_id"),
                       F.when(n < 5, n).alias("pr_number")).distinct()
    maps = l.select(F.col("l_partkey").alias("table_id"), F.col("l_suppkey").alias("product_id"))
    included = maps.select((F.col("table_id") % 4).alias("changeset_id"), "table_id")
    required = maps.select((F.col("product_id") % 4).alias("changeset_id"), "product_id")
    # A changeset is known if it has members of both kinds.
    sets = included.select("changeset_id").distinct().join(required.select("changeset_id").distinct(), "changeset_id").withColumn("asks", F.lit(True))
    return registry.shared_table_findings_by_member(changes, maps, sets, included, required)


@R.add("""SELECT l_orderkey AS changeset_id, l_suppkey AS product_id, CASE WHEN l_suppkey % 10 = 0 THEN 'unknown' WHEN l_linenumber < 3 THEN 'conflict' WHEN l_linenumber > 3 THEN 'deferred' ELSE 'release' END AS state FROM lineitem""")
def changeset_expansion(spark, sf):
    ready = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("changeset_id"), F.col("l_suppkey").alias("product_id"), F.col("l_linenumber").alias("version"))
    now = table(spark, sf, "supplier").where("s_suppkey % 10 <> 0").select(F.col("s_suppkey").alias("product_id"), F.lit(3).alias("version"))
    return registry.expand_changeset(ready, now)


@R.add("""SELECT s_suppkey AS product_id, 'product/' || s_suppkey || '/v' || (s_nationkey + 1) AS tag, 'RELEASE' AS code FROM supplier
UNION ALL SELECT DISTINCT l_suppkey, 'table/' || l_partkey || '/v' || l_linenumber, CASE WHEN p_size = l_linenumber THEN 'RELEASE' ELSE 'RELEASE_TABLE_VERSION_MISMATCH' END
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN part ON p_partkey = l_partkey""")
def release_plan(spark, sf):
    products = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("product_id"), (F.col("s_nationkey") + 1).alias("version"))
    links = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("product_id"), F.col("l_partkey").alias("table_id"), F.col("l_linenumber").alias("table_version"))
    tables = table(spark, sf, "part").select(F.col("p_partkey").alias("table_id"), F.col("p_size").alias("version"))
    return registry.release_plan(products, links, tables)


@R.add("""SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'removed' WHEN o_orderkey % 10 = 1 THEN 'created' WHEN o_orderkey % 10 = 2 THEN 'updated' ELSE 'unchanged' END AS change FROM orders""")
def version_diff(spark, sf):
    """Two versions of a table, row by row."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    after = o.where("o_orderkey % 10 <> 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 10 == 2, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return registry.diff(o.where("o_orderkey % 10 <> 1"), after, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])


@R.add("""SELECT 'f' || o_orderkey AS path, CASE WHEN o_orderkey % 5 = 0 THEN 'RELEASE_ARTIFACT_MISSING' WHEN o_orderkey % 5 = 1 THEN 'QUALITY_ARTIFACT_HASH_SET_MISMATCH' ELSE 'RELEASE_ARTIFACT_HASH_MISMATCH' END AS code FROM orders WHERE o_orderkey % 5 < 3""")
def release_hashes(spark, sf):
    o = table(spark, sf, "orders")
    path = F.concat(F.lit("f"), F.col("o_orderkey").cast("string"))
    declared = o.where("o_orderkey % 5 <> 1").select(path.alias("path"), F.md5(path).alias("sha256"))
    present = o.where("o_orderkey % 5 <> 0").select(path.alias("path"), F.when(F.col("o_orderkey") % 5 == 2, "x").otherwise(F.md5(path)).alias("sha256"))
    return registry.hash_set_findings(declared, present)


PATHS = "CASE doc_id % 6 WHEN 0 THEN 'products/' || source || '/sources/a.xlsx' WHEN 1 THEN 'products/' || source || '/generated/b.json' WHEN 2 THEN 'products/' || source || '/product.yaml' WHEN 3 THEN 'registry/x.json' WHEN 4 THEN 'src/' || lang || '.py' ELSE 'products/' || source || '/notes' END"


@R.add(f"""SELECT doc_id, {PATHS} AS path, CASE doc_id % 6 WHEN 0 THEN 'source' WHEN 1 THEN 'generated' WHEN 2 THEN 'config' WHEN 3 THEN 'registry' WHEN 4 THEN 'code' ELSE 'product' END AS kind,
  CASE WHEN doc_id % 6 NOT IN (3, 4) THEN source END AS product_key FROM documents""")
def changed_paths(spark, sf):
    p = table(spark, sf, "documents").select("doc_id", F.expr(PATHS).alias("path"))
    kinds = registry.classify_paths(p.select("path").distinct())
    return p.join(kinds, "path").select("doc_id", "path", "kind", "product_key")


@R.add("""SELECT c_nationkey, lower(left(c_name, 12)) AS name, count(*) AS n FROM customer GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_names(spark, sf):
    return registry.duplicate_names(table(spark, sf, "customer").select("c_nationkey", F.substring("c_name", 1, 12).alias("c_name")), ["c_nationkey"], "c_name")


@R.add("""SELECT source AS identity, count(DISTINCT lang) AS contents FROM documents GROUP BY 1 HAVING count(DISTINCT lang) > 1""")
def replay_conflicts(spark, sf):
    return registry.replay_conflicts(table(spark, sf, "documents").select(F.col("source").alias("identity"), F.col("lang").alias("content")))


@R.add("""SELECT conv_id, code, value FROM (SELECT conv_id, 'DUPLICATE_NAME' AS code, lower(role) AS value FROM conversations GROUP BY 1, 3 HAVING count(*) > 1
UNION ALL SELECT conv_id, 'DUPLICATE_ID', (turn % 3)::VARCHAR FROM conversations GROUP BY 1, 3 HAVING count(*) > 1)""")
def unique_names(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "role", (F.col("turn") % 3).cast("string").alias("id"))
    return validation.unique_findings(c, ["conv_id"], "role", "id")


@R.add(r"""SELECT user_id, regexp_full_match('prd_018cc251-f400-7' || left(md5(user_id::VARCHAR), 3) || '-8' || left(md5(user_id::VARCHAR), 3) || '-' || left(md5(user_id::VARCHAR), 12), 'prd_[0-9a-f-]{36}') AS ok,
  CASE user_id % 3 WHEN 0 THEN 'LOCATOR_PART_EMPTY' WHEN 1 THEN 'LOCATOR_PART_SEPARATOR' END AS code, user_id BETWEEN 1 AND 999 AS version_ok FROM (SELECT DISTINCT user_id FROM events)""")
def identifier_checks(spark, sf):
    u = table(spark, sf, "events").select("user_id").distinct()
    h = F.md5(F.col("user_id").cast("string"))
    ident = F.concat(F.lit("prd_018cc251-f400-7"), F.substring(h, 1, 3), F.lit("-8"), F.substring(h, 1, 3), F.lit("-"), F.substring(h, 1, 12))
    part = F.when(F.col("user_id") % 3 == 0, " ").when(F.col("user_id") % 3 == 1, "a|b").otherwise("fine")
    return u.select("user_id", validation.valid_entity_id(ident, "prd").alias("ok"), validation.locator_part_code(part).alias("code"),
                    validation.valid_version(F.col("user_id")).alias("version_ok"))


FORM = "concat('### Product key', chr(10), source, chr(10), chr(10), '### Notes', chr(10), '_No response_', chr(10), '### File', chr(10), '[a.xlsx](https://example.com/', doc_id, ')', CASE WHEN doc_id % 4 = 0 THEN concat(chr(10), '### Notes', chr(10), 'again') ELSE '' END)"


@R.add("""SELECT doc_id AS form_id, position, heading, value FROM (SELECT doc_id, 0 AS position, 'Product key' AS heading, source AS value FROM documents UNION ALL SELECT doc_id, 1, 'Notes', '' FROM documents
UNION ALL SELECT doc_id, 2, 'File', '[a.xlsx](https://example.com/' || doc_id || ')' FROM documents UNION ALL SELECT doc_id, 3, 'Notes', 'again' FROM documents WHERE doc_id % 4 = 0)""")
def form_fields(spark, sf):
    return forms.form_fields(table(spark, sf, "documents").select(F.col("doc_id").alias("form_id"), F.expr(FORM).alias("body")))


@R.add("""SELECT doc_id AS form_id, 'DUPLICATE_ISSUE_FIELD' AS code, 'Notes' AS heading FROM documents WHERE doc_id % 4 = 0
UNION ALL SELECT doc_id, 'MISSING_ISSUE_FIELD', 'Notes' FROM documents WHERE doc_id % 4 <> 0 UNION ALL SELECT doc_id, 'MISSING_ISSUE_FIELD', 'Owner' FROM documents""")
def form_checks(spark, sf):
    fields = forms.form_fields(table(spark, sf, "documents").select(F.col("doc_id").alias("form_id"), F.expr(FORM).alias("body")))
    return forms.form_findings(fields, ["Product key", "Notes", "Owner"])


@R.add("""SELECT doc_id AS form_id, 'File' AS heading, 'a.xlsx' AS name, 'https://example.com/' || doc_id AS url FROM documents""")
def form_attachments(spark, sf):
    return forms.attachments(forms.form_fields(table(spark, sf, "documents").select(F.col("doc_id").alias("form_id"), F.expr(FORM).alias("body"))))
