"""Metric expressions over datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.operators import metrics as m

from .base import Registry, table

R = Registry()
QUERIES, ORACLE_SQL = R.queries, R.sql


def _compiled(spark: SparkSession, metrics: list[tuple[str, str, str]], **datasets: DataFrame) -> dict[str, str]:
    ready, _ = m.compile_metrics(spark, metrics, datasets)
    (only,) = ready.values()
    return only


def _doubles(df: DataFrame, names: list[str], digits: int = 4) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in names], *[F.round(F.col(n).cast("double"), digits).alias(n) for n in names])


@R.add("""SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue,
  count(*) AS line_count, round(avg(l_quantity), 4) AS mean_quantity FROM lineitem GROUP BY 1, 2""")
def metric_revenue_by_flag(spark, sf):
    """Three metrics of one dataset by two dimensions: one scan, one shuffle."""
    items = table(spark, sf, "lineitem")
    sql = _compiled(spark, [("revenue", "lineitem", "SUM(L_EXTENDEDPRICE * (1 - l_discount))"), ("line_count", "lineitem", "COUNT(*)"),
                            ("mean_quantity", "lineitem", "AVG(lineitem.l_quantity)")], lineitem=items)
    out = m.run_metrics(items, "lineitem", sql, ["l_returnflag", "l_linestatus"])
    return _doubles(_doubles(out, ["revenue"], 2), ["mean_quantity"])


@R.add("""SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers,
  round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END), 2) AS finished,
  round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) / nullif(count(*), 0), 2) AS finished_mean
  FROM orders GROUP BY 1""")
def metric_case_distinct_ratio(spark, sf):
    """Distinct counts, conditional sums and guarded ratios."""
    orders = table(spark, sf, "orders")
    sql = _compiled(spark, [("customers", "orders", "COUNT(DISTINCT o_custkey)"),
                            ("finished", "orders", "SUM(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END)"),
                            ("finished_mean", "orders", "ROUND(SUM(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) / NULLIF(COUNT(*), 0), 2)")],
                    orders=orders)
    return _doubles(m.run_metrics(orders, "orders", sql, ["o_orderpriority"]), ["finished", "finished_mean"], 2)


@R.add("""SELECT round(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)::DOUBLE / nullif(count(user_id), 0), 6) AS click_rate,
  round(count(user_id)::DOUBLE / count(DISTINCT user_id), 6) AS events_a_user FROM events""")
def metric_integer_division(spark, sf):
    """Integer numerators are divided as DECIMAL(38, 12)."""
    events = table(spark, sf, "events")
    sql = _compiled(spark, [("click_rate", "events", "SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) / NULLIF(COUNT(user_id), 0)"),
                            ("events_a_user", "events", "COUNT(user_id) / COUNT(DISTINCT user_id)")], events=events)
    return _doubles(m.run_metrics(events, "events", sql), ["click_rate", "events_a_user"], 6)


@R.add("""SELECT r_name, n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS lines
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def metric_by_related_dimension(spark, sf):
    """A metric by dimensions four many-to-one relationships away."""
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    df = m.with_dimension(items, table(spark, sf, "orders"), [("l_orderkey", "o_orderkey")], ["o_custkey"])
    df = m.with_dimension(df, table(spark, sf, "customer"), [("o_custkey", "c_custkey")], ["c_nationkey"])
    df = m.with_dimension(df, table(spark, sf, "nation"), [("c_nationkey", "n_nationkey")], ["n_name", "n_regionkey"])
    df = m.with_dimension(df, table(spark, sf, "region"), [("n_regionkey", "r_regionkey")], ["r_name"])
    sql = _compiled(spark, [("revenue", "sales", "SUM(l_extendedprice * (1 - l_discount))"), ("lines", "sales", "COUNT(*)")], sales=df)
    return _doubles(m.run_metrics(df, "sales", sql, ["r_name", "n_name"]), ["revenue"], 2)


CHECKED = [
    ("COUNT(DISTINCT l_partkey)", "OK"), ("COUNT(*)", "OK"), ("ROUND(SUM(l_quantity) / NULLIF(COUNT(*), 0), 2)", "OK"),
    ("COUNT(missing_column)", "LLM_METRIC_REFERENCE_UNKNOWN"), ("SUM(orders.o_totalprice)", "LLM_METRIC_REFERENCE_UNKNOWN"),
    ("SUM(a.lineitem.l_tax)", "LLM_METRIC_REFERENCE_UNKNOWN"), ("COUNT(l_tax); COUNT(l_tax)", "LLM_METRIC_SQL_UNSAFE"),
    ("SELECT COUNT(*) FROM lineitem", "LLM_METRIC_SQL_UNSAFE"), ("1 + (SELECT 1)", "LLM_METRIC_SQL_UNSAFE"), ("SUM(", "LLM_METRIC_SQL_INVALID"),
    ("EXPLODE(SPLIT(l_returnflag, ','))", "LLM_METRIC_SQL_UNSAFE"), ("JAVA_METHOD('java.lang.System', 'exit', 0)", "LLM_METRIC_SQL_UNSAFE"),
    ("SUM(l_tax) OVER (PARTITION BY l_returnflag)", "LLM_METRIC_SQL_UNSAFE"), ("EXISTS (SELECT 1)", "LLM_METRIC_SQL_UNSAFE"),
]


@R.add("SELECT * FROM (VALUES " + ", ".join(f"('{e.replace(chr(39), chr(39) * 2)}', '{c}')" for e, c in CHECKED) + ") AS t(expression, code)")
def metric_guard(spark, sf):
    """Which expressions may run."""
    dataset = m.Dataset.of("lineitem", table(spark, sf, "lineitem"))
    rows = []
    for text, _ in CHECKED:
        try:
            m.qualify(spark, text, dataset)
            rows.append((text, "OK"))
        except m.MetricError as e:
            rows.append((text, e.code))
    return spark.createDataFrame(rows, "expression string, code string")


@R.add("""SELECT * FROM (VALUES ('both', 'METRIC_MULTI_DATASET_UNSUPPORTED'), ('ghost', 'LLM_METRIC_DATASET_UNKNOWN')) AS t(metric, code)""")
def metric_exclusions(spark, sf):
    """Metrics over several datasets are left out with a warning."""
    _, warned = m.compile_metrics(spark, [
        ("both", "orders, lineitem", "SUM(o_totalprice)"), ("ghost", "nowhere", "COUNT(*)"), ("fine", "orders", "COUNT(*)")],
        {"orders": table(spark, sf, "orders"), "lineitem": table(spark, sf, "lineitem")})
    return spark.createDataFrame(warned, "metric string, code string")
