"""Reports: findings gathered, statuses decided, calls and decisions counted."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def findings(*tables: DataFrame) -> DataFrame:
    """All findings in one long table; columns a table lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def product_status(all_findings: DataFrame, products: DataFrame, hard: tuple[str, ...]) -> DataFrame:
    """(product_id, status, hard, soft): FAIL with a hard finding, WARN with another, else PASS."""
    n = all_findings.groupBy("product_id").agg(F.count_if(F.col("code").isin(*hard)).alias("hard"), F.count_if(~F.col("code").isin(*hard)).alias("soft"))
    j = products.select("product_id").join(n, "product_id", "left").na.fill(0, ["hard", "soft"])
    return j.withColumn("status", F.when(F.col("hard") > 0, "FAIL").when(F.col("soft") > 0, "WARN").otherwise("PASS"))


def blocking(decisions: DataFrame) -> DataFrame:
    return decisions.where("decision = 'BLOCK'")


def audit_findings(audited: DataFrame, documents: DataFrame) -> DataFrame:
    """(doc, missing): pages of documents (doc, pages) that were not audited."""
    seen = audited.groupBy("doc").agg(F.collect_set("page").alias("seen"))
    j = documents.join(seen, "doc", "left")
    missing = F.array_except(F.expr("sequence(1, pages)"), F.coalesce("seen", F.array().cast("array<int>")))
    return j.select("doc", F.array_sort(missing).alias("missing")).where(F.size("missing") > 0)


def model_calls(attempts: Column, repairs: Column, cached: Column) -> Column:
    """Calls of one decision: one, its retries and repairs; none if it was cached."""
    return F.when(cached, 0).otherwise(F.lit(1) + attempts + repairs)


def application_report(decisions: DataFrame) -> DataFrame:
    """(doc, selected, deferred, cached, calls, outcome) of decisions (doc, outcome, source, retries, repairs)."""
    cached = F.col("source") == "cache"
    a = decisions.groupBy("doc").agg(
        F.count_if(F.col("outcome") == "selected").alias("selected"), F.count_if(F.col("outcome") == "deferred").alias("deferred"),
        F.count_if(cached).alias("cached"), F.sum(model_calls(F.col("retries"), F.col("repairs"), cached)).alias("calls"))
    return a.withColumn("outcome", F.when(F.col("deferred") == 0, "applied").when(F.col("selected") > 0, "partial").otherwise("deferred"))


def candidate_summary(candidates: DataFrame) -> DataFrame:
    """(doc, kind, sets, candidates, best): candidates by kind."""
    return candidates.groupBy("doc", "kind").agg(F.count_distinct("region").alias("sets"), F.count("*").alias("candidates"), F.max("score").alias("best"))


def sibling_hashes(payloads: DataFrame) -> DataFrame:
    """(product_id, name, sha256) of report texts."""
    return payloads.select("product_id", "name", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))


def missing_artifacts(present: DataFrame, products: DataFrame, required: tuple[str, ...], optional_set: tuple[str, ...]) -> DataFrame:
    """(product_id, code): required artifacts missing, or a set that must be there in whole or not at all."""
    want = products.select("product_id", F.explode(F.array(*[F.lit(r) for r in required])).alias("name"))
    gone = want.join(present.select("product_id", "name"), ["product_id", "name"], "left_anti").select(
        "product_id", F.lit("RELEASE_ARTIFACT_MISSING").alias("code")).distinct()
    some = present.where(F.col("name").isin(*optional_set)).groupBy("product_id").agg(F.count_distinct("name").alias("n"))
    part = some.where(F.col("n") < len(optional_set)).select("product_id", F.lit("DIAGNOSTICS_INCOMPLETE").alias("code"))
    return gone.unionByName(part)


def publishable(reports: DataFrame) -> DataFrame:
    """(product_id, code) of reports that fail the release gate; no row: releasable."""
    code = (F.when(F.col("status") == "FAIL", "QUALITY_GATE_FAILED").when((F.col("coverage") < 1.0) | (F.col("degraded") > 0), "SEMANTIC_FIDELITY_GATE_FAILED")
            .when(~F.col("verified"), "SEMANTIC_VALIDATION_NOT_VERIFIED"))
    return reports.select("product_id", code.alias("code")).where("code IS NOT NULL")


def to_release(paths: DataFrame, ready: DataFrame) -> DataFrame:
    """(product_id): products of changed paths and of expanded changesets, without deferred ones."""
    direct = paths.where("product_key IS NOT NULL AND kind IN ('generated', 'config', 'product')").select(F.col("product_key").alias("product_id"))
    expanded = ready.where("state = 'release'").select("product_id")
    held = ready.where("state IN ('deferred', 'conflict')").select("product_id")
    return direct.unionByName(expanded).distinct().join(held, "product_id", "left_anti")


def tag_codes(tags: DataFrame, existing: DataFrame) -> DataFrame:
    """(tag, code): create, keep, or TAG_TARGET_CONFLICT where a tag is on another commit."""
    e = existing.select("tag", F.col("commit").alias("at"))
    return tags.join(e, "tag", "left").select("tag", F.when(F.col("at").isNull(), "CREATE").when(F.col("at") == F.col("commit"), "KEEP").otherwise("TAG_TARGET_CONFLICT").alias("code"))


def replay_catalog(reports: DataFrame, source_hash: str) -> DataFrame:
    """(identity, markdown_hash): verified baselines of one source; an identity with two contents has none."""
    good = reports.where((F.col("source_hash") == source_hash) & (F.sha2(F.col("markdown").cast("binary"), 256) == F.col("markdown_hash")))
    return good.groupBy("identity").agg(F.count_distinct("markdown_hash").alias("n"), F.min("markdown_hash").alias("markdown_hash")).where("n = 1").drop("n")
