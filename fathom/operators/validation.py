"""Validators: rows in, findings out. An entity without a finding is valid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Identifier shapes.
UUID7 = "[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}"
ENTITY_PREFIXES = ("prd", "tbl", "col", "met", "rel", "lnk", "cst")
CONTENT_PREFIXES = ("span", "atom", "region", "hyp", "line", "candidate", "candidate_set", "cell", "block", "figure", "decision")


def valid_entity_id(value: Column, prefix: str) -> Column:
    return value.rlike(f"^{prefix}_{UUID7}$")


def valid_content_id(value: Column, prefix: str) -> Column:
    return value.rlike(f"^{prefix}_[0-9a-f]{{16}}$")


def valid_version(value: Column) -> Column:
    return value.between(1, 999)


def locator_part_code(value: Column) -> Column:
    """Null for a usable locator part, else why it isn't one."""
    plain = F.lower(F.trim(value))
    return F.when(plain.isNull() | (plain == ""), "LOCATOR_PART_EMPTY").when(plain.contains("|"), "LOCATOR_PART_SEPARATOR")


def unique_findings(rows: DataFrame, scope: list[str], name: str, ident: str) -> DataFrame:
    """(scope, code, value) of names (in any case) and ids that occur more than once."""
    names = rows.groupBy(*scope, F.lower(name).alias("value")).count().where("count > 1").select(
        *scope, F.lit("DUPLICATE_NAME").alias("code"), "value")
    ids = rows.groupBy(*scope, F.col(ident).alias("value")).count().where("count > 1").select(
        *scope, F.lit("DUPLICATE_ID").alias("code"), "value")
    return names.unionByName(ids)


def orphans(child: DataFrame, parent: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Child rows whose key no parent has; null keys refer to nothing and are left out."""
    cond = None
    for a, b in on:
        c = child[a] == parent[b]
        cond = c if cond is None else cond & c
        child = child.where(F.col(a).isNotNull())
    return child.join(parent, cond, "left_anti")


def evidence_findings(atoms: DataFrame, regions: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc, code, n): broken integrity of evidence.

    ``atoms``: doc, atom, ordinal, page. ``regions``: doc, region, atom. ``pages``: doc, page_count.
    """
    def finding(rows: DataFrame, code: str) -> DataFrame:
        return rows.groupBy("doc").agg(F.count("*").alias("n")).select("doc", F.lit(code).alias("code"), "n")

    parts = [
        (atoms.groupBy("doc", "atom").count().where("count > 1"), "ATOM_ID_DUPLICATE"),
        (atoms.groupBy("doc", "ordinal").count().where("count > 1"), "ATOM_ORDINAL_DUPLICATE"),
        (atoms.join(pages, "doc").where("page < 1 OR page > page_count"), "ATOM_PAGE_OUT_OF_RANGE"),
        (regions.join(atoms, ["doc", "atom"], "left_anti"), "REGION_ATOM_UNKNOWN"),
        (regions.groupBy("doc", "atom").agg(F.count_distinct("region").alias("k")).where("k > 1"), "ATOM_OWNED_TWICE"),
        (atoms.join(regions, ["doc", "atom"], "left_anti"), "ATOM_NOT_OWNED"),
    ]
    out = finding(*parts[0])
    for rows, code in parts[1:]:
        out = out.unionByName(finding(rows, code))
    return out


def boundary_findings(boundaries: DataFrame) -> DataFrame:
    """(candidate, code): mutable boundaries that are hard breaks, or indexes out of order.

    ``boundaries``: candidate, place, idx, state, mutable.
    """
    hard = boundaries.where("mutable AND state = 'hard_break'").select("candidate", F.lit("CANDIDATE_MUTABLE_HARD_BOUNDARY").alias("code"))
    w = Window.partitionBy("candidate").orderBy("place")
    wrong = boundaries.withColumn("before", F.lag("idx").over(w)).where("idx <= before").select(
        "candidate", F.lit("CANDIDATE_BOUNDARY_SEQUENCE_INVALID").alias("code"))
    return hard.unionByName(wrong).distinct()


def fidelity_status(unmatched: Column, duplicated: Column, degraded: Column, warnings: Column, unaudited: Column) -> Column:
    return (F.when((unmatched > 0) | (duplicated > 0), "FAIL")
            .when((degraded > 0) | (warnings > 0) | (unaudited > 0), "WARN").otherwise("PASS"))


def plan_code(checks: dict[str, Column]) -> Column:
    """The first failed check of an ordered set, or null."""
    out = None
    for code, failed in checks.items():
        out = F.when(failed, code) if out is None else out.when(failed, code)
    return out


def continuation_valid(overlap: Column, page_gap: Column, between: Column) -> Column:
    """Next page, only repeated edges in between, three quarters of the extent shared."""
    return (page_gap == 1) & (between == 0) & (overlap >= 0.75)
