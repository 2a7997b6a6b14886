"""Metric expressions: checked, qualified, typed, and run as Spark aggregates.

A metric is one scalar SQL expression over one dataset. Catalyst's parser reads it and the
tree is checked on the driver: only scalar nodes pass; subqueries, windows, generators and
reflection don't. Column references become canonical ``dataset.column``, and integer
numerators of divisions are cast to DECIMAL(38, 12). Execution is ``DataFrame.agg``, so all of
Catalyst's planning applies; several metrics of a dataset share one scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ALLOWED_FUNCTIONS = frozenset(
    "abs avg ceil ceiling coalesce count date_trunc floor greatest if ifnull least length lower max mean median min "
    "mod nullif nvl percentile power round sign sqrt stddev stddev_pop stddev_samp substring sum trim upper "
    "var_pop var_samp variance year month day".split())
DENIED_NODES = frozenset(
    "ScalarSubquery Exists InSubquery ListQuery LateralSubquery WindowExpression UnresolvedWindowExpression "
    "LambdaFunction UnresolvedNamedLambdaVariable Alias UnresolvedAlias UnresolvedStar "
    "UnresolvedTableValuedFunction FunctionTableSubqueryArgumentExpression".split())
INTEGRAL = ("tinyint", "smallint", "int", "bigint")


class MetricError(ValueError):
    """A metric that may not run; ``code`` says why."""

    def __init__(self, code: str, detail: str = ""):
        super().__init__(f"{code}: {detail}" if detail else code)
        self.code = code


@dataclass(frozen=True)
class Dataset:
    """A named table; columns in canonical case."""

    name: str
    columns: dict[str, str]  # lower-case name: canonical name
    types: dict[str, str]  # lower-case name: Spark type

    @classmethod
    def of(cls, name: str, df: DataFrame) -> Dataset:
        return cls(name, {c.lower(): c for c in df.columns}, {c.lower(): t for c, t in df.dtypes})


def dataset_catalog(datasets: list[Dataset]) -> dict[str, Dataset]:
    out: dict[str, Dataset] = {}
    for d in datasets:
        if d.name.lower() in out:
            raise MetricError("METRIC_DATASET_NAME_AMBIGUOUS", d.name)
        out[d.name.lower()] = d
    return out


def _class(node) -> str:
    return node.getClass().getSimpleName()


def _children(node) -> list:
    found = node.children()
    return [found.apply(i) for i in range(found.size())]


def parse_metric(spark: SparkSession, text: str):
    """The expression tree of one scalar expression."""
    try:
        node = spark._jsparkSession.sessionState().sqlParser().parseExpression(text)
    except (ParseException, Py4JJavaError) as e:
        first = text.lstrip().split(None, 1)[0].upper() if text.strip() else ""
        if ";" in text or first in {"SELECT", "WITH", "INSERT", "UPDATE", "DELETE", "DROP", "CREATE", "ALTER"}:
            raise MetricError("LLM_METRIC_SQL_UNSAFE", text) from e
        raise MetricError("LLM_METRIC_SQL_INVALID", text) from e
    _check(node, text)
    return node


def _check(node, text: str) -> None:
    kind = _class(node)
    if kind in DENIED_NODES:
        raise MetricError("LLM_METRIC_SQL_UNSAFE", text)
    if kind == "UnresolvedFunction":
        name = node.nameParts().mkString(".").lower()
        if name not in ALLOWED_FUNCTIONS:
            raise MetricError("LLM_METRIC_SQL_UNSAFE", name)
    for child in _children(node):
        _check(child, text)


def references(node) -> list[list[str]]:
    """Name parts of every column reference."""
    if _class(node) == "UnresolvedAttribute":
        parts = node.nameParts()
        return [[parts.apply(i) for i in range(parts.size())]]
    return [r for child in _children(node) for r in references(child)]


def _quoted(name: str) -> str:
    return name if name.isidentifier() else "`" + name.replace("`", "``") + "`"


def qualify(spark: SparkSession, text: str, dataset: Dataset) -> str:
    """The expression in canonical form, every column as ``dataset.column``."""
    node = parse_metric(spark, text)
    for parts in references(node):
        if len(parts) > 2 or parts[-1].lower() not in dataset.columns or (
                len(parts) == 2 and parts[0].lower() != dataset.name.lower()):
            raise MetricError("LLM_METRIC_REFERENCE_UNKNOWN", ".".join(parts))
    return _render(spark, node, dataset)[0]


def _render(spark: SparkSession, node, dataset: Dataset) -> tuple[str, bool]:
    """SQL of a node and whether its type is an integer."""
    kind = _class(node)
    if kind == "UnresolvedAttribute":
        name = node.nameParts().apply(node.nameParts().size() - 1).lower()
        return f"{_quoted(dataset.name)}.{_quoted(dataset.columns[name])}", dataset.types[name] in INTEGRAL
    own = node.sql()
    if kind == "UnresolvedFunction" and node.isDistinct() and "(DISTINCT " not in own:
        own = own.replace("(", "(DISTINCT ", 1)
    parts = []
    for child in _children(node):
        text, whole = _render(spark, child, dataset)
        parts.append((child.sql(), text, whole))
    if kind == "Divide" and parts[0][2]:
        parts[0] = (parts[0][0], f"CAST({parts[0][1]} AS DECIMAL(38, 12))", False)
    out, at = "", 0
    for before, after, _ in parts:  # a node's SQL holds its children's, in order
        found = own.find(before, at)
        if found < 0:
            raise MetricError("LLM_METRIC_SQL_INVALID", own)
        out += own[at:found] + after
        at = found + len(before)
    whole = [p[2] for p in parts]
    integer = {"Literal": lambda: node.dataType().simpleString() in INTEGRAL,
               "Divide": lambda: False,
               "Cast": lambda: node.dataType().simpleString() in INTEGRAL,
               "UnresolvedFunction": lambda: node.nameParts().mkString(".").lower() == "count" or (
                   node.nameParts().mkString(".").lower() in ("sum", "min", "max", "coalesce", "nullif", "abs") and all(whole)),
               }.get(kind, lambda: bool(whole) and all(whole))()
    return out + own[at:], integer


def compile_metrics(spark: SparkSession, metrics: list[tuple[str, str, str]], datasets: dict[str, DataFrame]):
    """({dataset: {metric: SQL}}, [(metric, code)]) of (name, dataset list, expression) triples.

    Metrics over several datasets are left out with a warning code: no join path is
    declared for them. Names are unique whatever their case.
    """
    catalog = dataset_catalog([Dataset.of(n, d) for n, d in datasets.items()])
    ready: dict[str, dict[str, str]] = {}
    warned: list[tuple[str, str]] = []
    seen: set[str] = set()
    for name, over, text in metrics:
        if name.lower() in seen:
            raise MetricError("LLM_METRIC_NAME_DUPLICATE", name)
        seen.add(name.lower())
        names = [d.strip().lower() for d in over.split(",")]
        if len(names) > 1:
            warned.append((name, "METRIC_MULTI_DATASET_UNSUPPORTED"))
        elif names[0] not in catalog:
            warned.append((name, "LLM_METRIC_DATASET_UNKNOWN"))
        else:
            dataset = catalog[names[0]]
            ready.setdefault(dataset.name, {})[name] = qualify(spark, text, dataset)
    return ready, warned


def run_metrics(df: DataFrame, dataset: str, metrics: dict[str, str], by: list[str] | None = None) -> DataFrame:
    """All metrics of one dataset in one aggregation, by optional dimensions."""
    frame = df.alias(dataset)
    columns = [F.expr(sql).alias(name) for name, sql in metrics.items()]
    return (frame.groupBy(*by) if by else frame.groupBy()).agg(*columns)


def with_dimension(many: DataFrame, one: DataFrame, on: list[tuple[str, str]], columns: list[str]) -> DataFrame:
    """``many`` with columns of the one-side of a relationship; never fans out.

    The one side is reduced to one row a key, so a measure can't be counted twice.
    """
    keys = [b for _, b in on]
    side = one.select(*keys, *[c for c in columns if c not in keys]).dropDuplicates(keys)
    cond = None
    for a, b in on:
        c = many[a] == side[b]
        cond = c if cond is None else cond & c
    joined = many.join(side, cond, "left")
    for b in keys:
        if b not in many.columns and b not in columns:
            joined = joined.drop(side[b])
    return joined
