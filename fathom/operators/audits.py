"""Audits of recorded decisions, their redaction, and what is assembled from their parts.

A decision's attempts are bounded by the policy that made them, so they are gathered in
order with their decision and judged by array expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from fathom.functions.ids import content_id
from fathom.operators.sequences import top_rows
from fathom.operators.validation import UUID7

# Codes and permissions of the data model, and the form of product keys.
LOW_CODE, REPAIRED_CODE = "LLM_CONFIDENCE_TOO_LOW", "LLM_SPACING_REPAIR_APPLIED"
APPROVERS = ("admin", "maintain", "write")
PRODUCT_KEY = r"^[a-z0-9]+(?:-[a-z0-9]+)*$"


def with_attempts(decisions: DataFrame, attempts: DataFrame, allowed: DataFrame) -> DataFrame:
    """Decisions with their attempts in order (``tries``) and their candidates (``allowlist``).

    ``attempts``: decision_id, position, phase, status, candidate_id, confidence, codes,
    retries, repairs, and index and request_hash where recoveries are judged. ``allowed``: decision_id,
    candidate_id. A decision without attempts or candidates has empty lists.
    """
    more = [c for c in ("index", "request_hash") if c in attempts.columns]
    row = F.struct("position", "phase", "status", "candidate_id", "confidence", "codes", "retries", "repairs", *more)
    tries = attempts.groupBy("decision_id").agg(F.sort_array(F.collect_list(row)).alias("tries"))
    lists = allowed.groupBy("decision_id").agg(F.collect_set("candidate_id").alias("allowlist"))
    return decisions.join(tries, "decision_id", "left").join(lists, "decision_id", "left").withColumn(
        "allowlist", F.coalesce("allowlist", F.expr("cast(array() as array<string>)")))


COUNTS = """retry_count = aggregate(tries, 0L, (n, t) -> n + t.retries) AND repair_count = aggregate(tries, 0L, (n, t) -> n + t.repairs)"""
LAST = "element_at(tries, -1)"


def primary_matches(least: float) -> Column:
    """Whether a plain model decision is what its attempts say: unknown answers, then one
    accepted candidate of the list, with enough confidence and no codes."""
    return F.coalesce(F.expr(f"""source IN ('model', 'cache') AND size(tries) > 0 AND forall(tries, t -> t.phase = 'primary')
        AND forall(slice(tries, 1, size(tries) - 1), t -> t.status = 'candidate_unknown')
        AND {LAST}.status = 'accepted' AND array_contains(allowlist, {LAST}.candidate_id)
        AND {LAST}.candidate_id = selected_id AND {LAST}.confidence >= {least}D AND {LAST}.confidence = confidence
        AND size({LAST}.codes) = 0 AND size(codes) = 0 AND {COUNTS}"""), F.lit(False))


def generated_matches(least: float) -> Column:
    """Whether a generated repair is what its attempts say: primary answers up to a listed
    candidate, then a generation and a verification that agree."""
    before, made, seen = "element_at(tries, -3)", "element_at(tries, -2)", LAST
    return F.coalesce(F.expr(f"""CASE WHEN size(tries) < 3 THEN false ELSE source IN ('generated', 'cache')
        AND forall(slice(tries, 1, size(tries) - 2), t -> t.phase = 'primary')
        AND forall(slice(tries, 1, size(tries) - 3), t -> t.status = 'candidate_unknown')
        AND array_contains(allowlist, {before}.candidate_id)
        AND {before}.status = CASE WHEN {before}.confidence >= {least}D THEN 'accepted' ELSE 'low_confidence' END
        AND array_join({before}.codes, ',') = CASE WHEN {before}.confidence >= {least}D THEN '' ELSE '{LOW_CODE}' END
        AND {made}.phase = 'generation' AND {seen}.phase = 'verification'
        AND {made}.status = 'accepted' AND {seen}.status = 'accepted'
        AND {made}.candidate_id = generated_id AND {seen}.candidate_id = generated_id
        AND {made}.confidence >= {least}D AND {seen}.confidence >= {least}D
        AND size({made}.codes) = 0 AND size({seen}.codes) = 0
        AND confidence = least({made}.confidence, {seen}.confidence)
        AND array_join(codes, ',') = '{REPAIRED_CODE}' AND {COUNTS} END"""), F.lit(False))


def redact(decisions: DataFrame, texts: list[str]) -> DataFrame:
    """Decisions with hashes in place of their generated texts; a null text stays null."""
    kept = [c for c in decisions.columns if c not in texts]
    return decisions.select(*kept, *[F.sha2(F.col(t).cast("binary"), 256).alias(f"{t}_hash") for t in texts])


def merge_plans(blocks: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc, block_id, order): blocks of all batch plans of a document, from 0 by the place of
    their first span.

    ``blocks``: doc, block_id, span_ids. ``spans``: doc, span_id, position. Blocks without
    a known first span come last.
    """
    first = blocks.select("doc", "block_id", F.get("span_ids", F.lit(0)).alias("span_id")).join(spans, ["doc", "span_id"], "left")
    order = Window.partitionBy("doc").orderBy(F.col("position").asc_nulls_last(), "block_id")
    return first.select("doc", "block_id", (F.row_number().over(order) - 1).alias("order"))


def table_text(cells: DataFrame, tables: DataFrame) -> DataFrame:
    """(table, text): rows by line, columns by tab, a cell's text at its origin only.

    ``cells``: table, start_row, start_column, text. ``tables``: table, row_count, column_count.
    """
    grid = tables.withColumn("r", F.explode(F.expr("sequence(0, row_count - 1)"))).withColumn(
        "k", F.explode(F.expr("sequence(0, column_count - 1)"))).select("table", "r", "k")
    at = cells.select("table", F.col("start_row").alias("r"), F.col("start_column").alias("k"), "text")
    full = grid.join(at, ["table", "r", "k"], "left").withColumn("text", F.coalesce("text", F.lit("")))
    rows = full.groupBy("table", "r").agg(F.sort_array(F.collect_list(F.struct("k", "text"))).alias("c")).select(
        "table", "r", F.expr("array_join(transform(c, x -> x.text), '\t')").alias("line"))
    return rows.groupBy("table").agg(F.sort_array(F.collect_list(F.struct("r", "line"))).alias("l")).select(
        "table", F.expr("array_join(transform(l, x -> x.line), '\n')").alias("text"))


def layout_only(excluded: DataFrame) -> DataFrame:
    """Dispositions of the white space of excluded regions (doc, region, atom, text, decision_id)."""
    return excluded.where(F.col("text").rlike(r"^[\s\x1c-\x1f\x85\p{Z}]+$")).select(
        "doc", "atom", F.lit("layout_only").alias("outcome"), F.lit("none").alias("boundary_state"), "decision_id")


def writeback_allowed(path: Column, product_key: Column) -> Column:
    """Whether a release may write a path (relative, normal): the registry, the product's
    description, or what is generated for it; nothing for a key of another form."""
    parts = F.split(path, "/")
    own = (F.get(parts, F.lit(0)) == "products") & (F.get(parts, F.lit(1)) == product_key)
    clean = ~F.exists(parts, lambda x: x.isin("", ".", ".."))
    return F.coalesce(clean & product_key.rlike(PRODUCT_KEY) & (
        ((F.size(parts) >= 2) & (parts[0] == "registry"))
        | ((F.size(parts) == 3) & own & (F.get(parts, F.lit(2)) == "product.yaml"))
        | ((F.size(parts) >= 4) & own & F.get(parts, F.lit(2)).isin("generated", "quality"))), F.lit(False))


def label_code(permission: Column, label: Column, approval: str) -> Column:
    """Why a label does or doesn't approve, where ``approval`` is the label that does."""
    return (F.when(~label.eqNullSafe(F.lit(approval)), "LABEL_NOT_APPROVAL")
            .when(F.coalesce(F.lower(permission).isin(*APPROVERS), F.lit(False)), "AUTHORIZED")
            .otherwise("INSUFFICIENT_APPROVER_PERMISSION"))


def evidence_ids(evidence: DataFrame, doc: str, position: str) -> DataFrame:
    """Evidence with its evidence_id by place in the document, from 1."""
    n = F.row_number().over(Window.partitionBy(doc).orderBy(position))
    return evidence.withColumn("evidence_id", F.format_string("product-evidence-%06d", n))


def evidence_key(source_hash: Column, role: Column, locator: Column, excerpt: Column) -> Column:
    """What two evidences must share to be the same: a locator (map) counts without its nulls."""
    named = F.map_filter(locator, lambda _, v: v.isNotNull())
    pairs = F.array_sort(F.map_entries(named))
    text = F.concat(F.lit("{"), F.array_join(F.transform(
        pairs, lambda e: F.concat(F.lit('"'), e["key"], F.lit('":"'), e["value"], F.lit('"'))), ","), F.lit("}"))
    return F.struct(source_hash.alias("source_hash"), role.alias("role"), text.alias("locator"), excerpt.alias("excerpt"))


# How a recovered decision is marked, and the form of changeset ids.
RECOVERED_CODE = "LLM_LOW_CONFIDENCE_RECOVERED"
CHANGESET = f"^cst_{UUID7}$"


def recovery_matches(least: float, votes: int = 2) -> Column:
    """Whether a recovered decision is what its attempts say.

    Its phases come one after the other, each unknown answers and then one vote of the list: a primary
    one of low confidence, an accepted recovery, and, where these two differ, an accepted tiebreak
    that is one of them. ``tries`` also hold index and request_hash; decisions: method, consensus_id, confidence,
    recovery_count.
    """
    phases = "CASE WHEN method = 'same_candidate' THEN array('primary', 'recovery') ELSE array('primary', 'recovery', 'tiebreak') END"
    own = "filter(tries, t -> t.phase = p)"
    last = f"try_element_at({own}, -1)"
    one = (f"size({own}) > 0 AND forall(slice({own}, 1, size({own}) - 1), t -> t.status = 'candidate_unknown') "
           f"AND array_contains(allowlist, {last}.candidate_id) "
           f"AND {last}.status = CASE WHEN {last}.confidence >= {least}D THEN 'accepted' ELSE 'low_confidence' END")
    vote = {p: f"try_element_at(filter(tries, t -> t.phase = '{p}'), -1)" for p in ("primary", "recovery", "tiebreak")}
    first, second, third = vote["primary"], vote["recovery"], vote["tiebreak"]
    agree = (f"(CASE WHEN {third}.candidate_id = {first}.candidate_id THEN 2 WHEN {third}.candidate_id = {second}.candidate_id THEN 2 ELSE 1 END)")
    end = f"(CASE WHEN method = 'same_candidate' THEN {second} ELSE {third} END)"
    return F.coalesce(F.expr(f"""size(tries) > 0 AND transform(tries, t -> t.index) = sequence(1, size(tries))
        AND size(array_distinct(transform(tries, t -> t.request_hash))) = size(tries)
        AND array_distinct(transform(tries, t -> t.phase)) = {phases}
        AND forall({phases}, p -> {one})
        AND {first}.status = 'low_confidence' AND {second}.status = 'accepted'
        AND CASE WHEN method = 'same_candidate' THEN {first}.candidate_id = {second}.candidate_id AND recovery_count = 1
            ELSE {first}.candidate_id <> {second}.candidate_id AND {third}.status = 'accepted' AND recovery_count = 2
                AND {agree} >= {votes} END
        AND {end}.candidate_id = consensus_id AND {end}.confidence = confidence
        AND array_join(codes, ',') = '{RECOVERED_CODE}' AND {COUNTS}"""), F.lit(False))


def decision_id(*parts: str) -> Column:
    """Content id of a decision over everything its audit holds."""
    return F.concat(F.lit("decision_"), F.substring(F.sha2(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}).cast("binary"), 256), 1, 16))


def recognition_candidates(regions: DataFrame, hypotheses: DataFrame, most: int = 5) -> DataFrame:
    """(doc, region, rank, candidate_id, text, engine, score): readings of a region, best first.

    ``regions``: doc, region, hypothesis_ids. ``hypotheses``: doc, hypothesis, text, engine, confidence.
    """
    j = regions.select("doc", "region", F.explode("hypothesis_ids").alias("hypothesis")).join(hypotheses, ["doc", "hypothesis"])
    ident = content_id("candidate", F.lit("recognition"), F.col("region"), F.col("hypothesis"), F.col("text"), F.col("engine"))
    rows = j.select("doc", "region", ident.alias("candidate_id"), "text", "engine", F.col("confidence").alias("score"))
    return top_rows(rows, ["doc", "region"], [F.col("score").desc(), "candidate_id"], most)


def reusable_plans(trusted: DataFrame, contexts: DataFrame, plan: str) -> DataFrame:
    """Trusted plans whose source, spans, versions and schema are a context's, and whose recorded
    hash is that of the plan they hold."""
    keys = ["source_hash", "span_hashes", "parser_version", "prompt_version", "schema_hash"]
    return trusted.where(F.sha2(F.col(plan).cast("binary"), 256) == F.col("plan_hash")).join(contexts.select(*keys), keys, "left_semi")


def product_changesets(products: DataFrame, configs: DataFrame) -> DataFrame:
    """(product_key, changeset_id, code) of registered products by their configuration.

    Both: product_key, product_id, version; ``configs`` also changeset_id. An empty changeset is none.
    """
    own = configs.select("product_key", F.col("product_id").alias("_id"), F.col("version").alias("_version"), "changeset_id", F.lit(True).alias("_there"))
    j = products.join(own, "product_key", "left")
    same = F.col("_id").eqNullSafe(F.col("product_id")) & F.col("_version").eqNullSafe(F.col("version"))
    named = F.when(F.col("changeset_id") != "", F.col("changeset_id"))
    code = (F.when(F.col("_there").isNull(), "RELEASE_PRODUCT_CONFIG_MISSING").when(~same, "RELEASE_PRODUCT_CONFIG_MISMATCH")
            .when(named.isNotNull() & ~named.rlike(CHANGESET), "CHANGESET_REFERENCE_INVALID"))
    return j.select("product_key", F.when(code.isNull(), named).alias("changeset_id"), code.alias("code"))
