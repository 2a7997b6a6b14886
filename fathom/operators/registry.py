"""The registry as tables: write checks, impact, changesets, releases, diffs.

Checks return findings (entity, code), so a batch of writes is judged in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_names(rows: DataFrame, scope: list[str], name: str) -> DataFrame:
    """Names that occur more than once in their scope, whatever their case."""
    return rows.groupBy(*scope, F.lower(name).alias("name")).agg(F.count("*").alias("n")).where("n > 1")


def product_write_findings(writes: DataFrame, registry: DataFrame) -> DataFrame:
    """(product_id, code): RETIRED_ID_REUSE, or PRODUCT_KEY_CONFLICT with a key or alias of another."""
    known = registry.select("product_id", F.col("status").alias("known_status"))
    reuse = writes.join(known, "product_id").where("known_status = 'RETIRED' AND status = 'ACTIVE'").select(
        "product_id", F.lit("RETIRED_ID_REUSE").alias("code"))
    names = registry.select(F.col("product_id").alias("other"), F.explode(F.array_distinct(F.concat(
        F.array("product_key"), F.coalesce("aliases", F.array().cast("array<string>"))))).alias("product_key"))
    clash = writes.join(names, "product_key").where("other <> product_id").select(
        "product_id", F.lit("PRODUCT_KEY_CONFLICT").alias("code")).distinct()
    return reuse.unionByName(clash)


def table_write_findings(writes: DataFrame, registry: DataFrame) -> DataFrame:
    """(table_id, code): RETIRED_ID_REUSE, or TABLE_LOCATOR_CONFLICT with another table."""
    known = registry.select("table_id", F.col("status").alias("known_status"))
    reuse = writes.join(known, "table_id").where("known_status = 'RETIRED' AND status = 'ACTIVE'").select(
        "table_id", F.lit("RETIRED_ID_REUSE").alias("code"))
    others = registry.select(F.col("table_id").alias("other"), "locator")
    clash = writes.join(others, "locator").where("other <> table_id").select(
        "table_id", F.lit("TABLE_LOCATOR_CONFLICT").alias("code")).distinct()
    return reuse.unionByName(clash)


def mapping_findings(mappings: DataFrame, products: DataFrame, tables: DataFrame) -> DataFrame:
    """(link_id, code) of product-table links whose product, table or version isn't registered."""
    p = products.select("product_id", F.lit(True).alias("has_product"))
    t = tables.select("table_id", F.col("version").alias("known_version"))
    code = (F.when(F.col("has_product").isNull(), "MAPPING_PRODUCT_NOT_FOUND")
            .when(F.col("known_version").isNull(), "MAPPING_TABLE_NOT_FOUND")
            .when(F.col("known_version") != F.col("table_version"), "MAPPING_TABLE_VERSION_MISMATCH"))
    return (mappings.join(p, "product_id", "left").join(t, "table_id", "left")
            .select("link_id", code.alias("code")).where("code IS NOT NULL"))


def indexes(products: DataFrame, tables: DataFrame) -> DataFrame:
    """(index, key, id): product keys and table locators."""
    return products.select(F.lit("product-keys").alias("index"), F.col("product_key").alias("key"), F.col("product_id").alias("id")).unionByName(
        tables.select(F.lit("table-locators").alias("index"), F.col("locator").alias("key"), F.col("table_id").alias("id")))


def impact(mappings: DataFrame) -> DataFrame:
    """(table_id, required_product_ids, shared): the products that use each table."""
    used = mappings.groupBy("table_id").agg(F.sort_array(F.collect_set("product_id")).alias("required_product_ids"))
    return used.withColumn("shared", F.size("required_product_ids") > 1)


def impact_counts(mappings: DataFrame) -> DataFrame:
    """As :func:`impact` with a count in place of the list: bounded rows for hot tables."""
    used = mappings.groupBy("table_id").agg(F.count_distinct("product_id").alias("products"))
    return used.withColumn("shared", F.col("products") > 1)


def changeset_status(changesets: DataFrame) -> DataFrame:
    """Adds status: ready where the ready products are exactly the required ones."""
    ready, required = F.col("ready_product_ids"), F.col("required_product_ids")
    equal = (F.size(F.array_except(ready, required)) == 0) & (F.size(F.array_except(required, ready)) == 0)
    return changesets.withColumn("status", F.when(equal, "ready").otherwise("blocked"))


def shared_table_findings(changes: DataFrame, mappings: DataFrame, changesets: DataFrame) -> DataFrame:
    """Findings of changed shared tables that no changeset covers.

    ``changes``: product_id, table_id, changeset_id (or null), pr_number, of tables that
    existed and changed. ``changesets``: changeset_id, table_ids, required_product_ids; without table_ids
    it is unknown, without required_product_ids it is not asked for products. Returns product_id, table_id, code.
    """
    sets = changesets.where("table_ids IS NOT NULL")
    return shared_table_findings_by_member(
        changes, mappings, sets.select("changeset_id", F.col("required_product_ids").isNotNull().alias("asks")),
        sets.select("changeset_id", F.explode("table_ids").alias("table_id")), sets.select("changeset_id", F.explode("required_product_ids").alias("product_id")))


def shared_table_findings_by_member(changes: DataFrame, mappings: DataFrame, changesets: DataFrame, included: DataFrame, required: DataFrame) -> DataFrame:
    """As :func:`shared_table_findings`, with a row for each member of a changeset.

    ``changesets``: changeset_id, asks (whether products are asked for). ``included``: changeset_id, table_id.
    ``required``: changeset_id, product_id. Members are looked up by key; no list of them is gathered or searched.
    """
    shared = changes.join(impact_counts(mappings).where("shared").select("table_id"), "table_id", "left_semi")
    tables = included.select("changeset_id", "table_id").distinct().withColumn("_included", F.lit(True))
    products = required.select("changeset_id", "product_id").distinct().withColumn("_required", F.lit(True))
    # Changesets may be few and so hot keys: their join has only their names, and members are joined by two keys.
    j = shared.join(changesets.select("changeset_id", "asks"), "changeset_id", "left").join(
        tables, ["table_id", "changeset_id"], "left").join(products, ["product_id", "changeset_id"], "left")
    known = F.col("asks").isNotNull()
    code = F.array_compact(F.array(
        F.when(F.col("changeset_id").isNull(), "SHARED_TABLE_CHANGESET_REQUIRED").when(~known, "CHANGESET_NOT_FOUND"),
        F.when(F.col("asks") & F.col("product_id").isNotNull() & F.col("_required").isNull(), "CHANGESET_PRODUCT_NOT_REQUIRED"),
        F.when(known & F.col("_included").isNull(), "CHANGESET_TABLE_NOT_INCLUDED"),
        F.when(known & ~F.coalesce(F.col("pr_number") > 0, F.lit(False)), "CHANGESET_PR_NUMBER_REQUIRED")))
    return j.select("product_id", "table_id", F.explode(code).alias("code")).distinct()


def expand_changeset(ready: DataFrame, products: DataFrame) -> DataFrame:
    """(changeset_id, product_id, state) of ready products against the registry's version.

    conflict: the changeset is behind the registry; deferred: ahead of it; release: equal.
    """
    now = products.select("product_id", F.col("version").alias("current"))
    state = (F.when(F.col("current").isNull(), "unknown").when(F.col("version") < F.col("current"), "conflict")
             .when(F.col("version") > F.col("current"), "deferred").otherwise("release"))
    return ready.join(now, "product_id", "left").select("changeset_id", "product_id", state.alias("state"))


def release_plan(products: DataFrame, mappings: DataFrame, tables: DataFrame) -> DataFrame:
    """(product_id, tag, code): the tags of each product and its tables; a version that differs is a finding."""
    own = products.select("product_id", F.format_string("product/%s/v%d", "product_id", "version").alias("tag"),
                          F.lit("RELEASE").alias("code"))
    t = tables.select("table_id", F.col("version").alias("known_version"))
    linked = mappings.join(products.select("product_id"), "product_id").join(t, "table_id", "left")
    tag = F.format_string("table/%s/v%d", "table_id", "table_version")
    code = F.when(F.col("known_version").eqNullSafe(F.col("table_version")), "RELEASE").otherwise("RELEASE_TABLE_VERSION_MISMATCH")
    return own.unionByName(linked.select("product_id", tag.alias("tag"), code.alias("code")).distinct())


def diff(before: DataFrame, after: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """(key, change): created, removed, updated or unchanged between two versions of a table."""
    a = before.select(*key, F.struct(*values).alias("a"), F.lit(True).alias("had"))
    b = after.select(*key, F.struct(*values).alias("b"), F.lit(True).alias("has"))
    change = (F.when(F.col("had").isNull(), "created").when(F.col("has").isNull(), "removed")
              .when(F.col("a").eqNullSafe(F.col("b")), "unchanged").otherwise("updated"))
    return a.join(b, key, "full_outer").select(*key, change.alias("change"))


def hash_set_findings(declared: DataFrame, present: DataFrame) -> DataFrame:
    """(path, code) where declared and present artifact hashes differ."""
    j = declared.select("path", F.col("sha256").alias("d")).join(
        present.select("path", F.col("sha256").alias("p")), "path", "full_outer")
    code = (F.when(F.col("p").isNull(), "RELEASE_ARTIFACT_MISSING").when(F.col("d").isNull(), "QUALITY_ARTIFACT_HASH_SET_MISMATCH")
            .when(F.col("d") != F.col("p"), "RELEASE_ARTIFACT_HASH_MISMATCH"))
    return j.select("path", code.alias("code")).where("code IS NOT NULL")


def classify_paths(paths: DataFrame) -> DataFrame:
    """(path, kind, product_key) of changed paths: source, generated, config, registry or code."""
    parts = F.split("path", "/")
    in_product = (parts[0] == "products") & (F.size(parts) > 2)
    kind = (F.when(in_product & (parts[2] == "sources"), "source").when(in_product & (parts[2] == "generated"), "generated")
            .when(in_product & (F.element_at(parts, -1) == "product.yaml"), "config").when(in_product, "product")
            .when(parts[0] == "registry", "registry").otherwise("code"))
    return paths.select("path", kind.alias("kind"), F.when(in_product, parts[1]).alias("product_key"))


def completeness(described: DataFrame) -> DataFrame:
    """(product_id, score, missing) of rows (product_id, entity, description): the share described."""
    has = F.coalesce(F.length(F.trim("description")) > 0, F.lit(False))
    return described.groupBy("product_id").agg(
        F.round(F.avg(has.cast("double")), 4).alias("score"), F.count_if(~has).alias("missing"))


def replay_conflicts(entries: DataFrame) -> DataFrame:
    """(identity, contents) of replay identities that name several contents."""
    return entries.groupBy("identity").agg(F.count_distinct("content").alias("contents")).where("contents > 1")
