"""Submission forms: ``### Heading`` and value pairs in one text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.functions.text import normalize_line_ends, trimmed

EMPTY = "_No response_"


def form_fields(forms: DataFrame) -> DataFrame:
    """(form_id, position, heading, value) of forms (form_id, body)."""
    parts = F.filter(F.split(normalize_line_ends(F.col("body")), r"(?m)^### "), lambda p: trimmed(p) != "")
    rows = forms.select("form_id", F.posexplode(parts).alias("position", "part"))
    value = trimmed(F.regexp_replace("part", r"^[^\n]*\n?", ""))
    return rows.select("form_id", "position", trimmed(F.regexp_extract("part", r"^([^\n]*)", 1)).alias("heading"),
                       F.when(value == EMPTY, "").otherwise(value).alias("value"))


def form_findings(fields: DataFrame, required: list[str]) -> DataFrame:
    """(form_id, code, heading): repeated and missing fields."""
    twice = fields.groupBy("form_id", "heading").count().where("count > 1").select(
        "form_id", F.lit("DUPLICATE_ISSUE_FIELD").alias("code"), "heading")
    want = fields.select("form_id").distinct().withColumn("heading", F.explode(F.array(*[F.lit(r) for r in required])))
    missing = want.join(fields.where("value <> ''"), ["form_id", "heading"], "left_anti").select(
        "form_id", F.lit("MISSING_ISSUE_FIELD").alias("code"), "heading")
    return twice.unionByName(missing)


def attachments(fields: DataFrame) -> DataFrame:
    """(form_id, heading, name, url) of values that are one markdown link."""
    pattern = r"^\[([^\]]+)\]\((https?://[^\s()]+)\)$"
    return fields.where(F.col("value").rlike(pattern)).select(
        "form_id", "heading", F.regexp_extract("value", pattern, 1).alias("name"), F.regexp_extract("value", pattern, 2).alias("url"))
