"""Identity resolution: foreign keys, columns, named records, duplicates.

All functions join whole tables of entities, of as many products as there are; keys are
compared in lower case. Where the first of several matches counts, order is the
registry's: by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_match(df: DataFrame, by: list[str], order: list) -> DataFrame:
    """One row of each group, the first in ``order``."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def table_names(tables: DataFrame) -> DataFrame:
    """(product_id, table_id, dataset, name): the three names a table answers to.

    ``tables``: product_id, table_id, source_system, catalog, schema_name, table_name.
    """
    names = F.array_distinct(F.array(
        F.lower("table_name"), F.lower(F.concat_ws(".", "catalog", "schema_name", "table_name")),
        F.lower(F.concat_ws("|", "source_system", "catalog", "schema_name", "table_name"))))
    return tables.select("product_id", "table_id", F.col("table_name").alias("dataset"), F.explode(names).alias("name"))


def resolve_foreign_keys(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """Outcome of every declared foreign key within its product.

    ``columns``: product_id, table_id, column_id, column_name, foreign_key. Returns product_id,
    table_id, column_id, foreign_key, target_table_id, target_column_id, relationship and
    code: RESOLVED, FOREIGN_KEY_FORMAT_INVALID, FOREIGN_KEY_TARGET_AMBIGUOUS or
    FOREIGN_KEY_TARGET_NOT_FOUND.
    """
    keys = columns.where("foreign_key IS NOT NULL AND foreign_key <> ''").select(
        "product_id", "table_id", "column_id", "column_name", "foreign_key",
        F.lower(F.regexp_extract("foreign_key", r"^(.*)\.[^.]*$", 1)).alias("name"),
        F.lower(F.regexp_extract("foreign_key", r"\.([^.]*)$", 1)).alias("leaf"),
        F.col("foreign_key").contains(".").alias("formed"))
    names = table_names(tables)
    targets = names.groupBy("product_id", "name").agg(
        F.count_distinct("table_id").alias("targets"), F.min("table_id").alias("target_table_id"),
        F.min_by("dataset", "table_id").alias("target_dataset"))
    leaves = columns.select("product_id", F.col("table_id").alias("target_table_id"), F.lower("column_name").alias("leaf"),
                            F.col("column_id").alias("target_column_id"), F.col("column_name").alias("target_column"))
    leaves = first_match(leaves, ["product_id", "target_table_id", "leaf"], ["target_column_id"])
    sources = tables.select("product_id", "table_id", F.col("table_name").alias("source_dataset"))
    joined = (keys.join(targets, ["product_id", "name"], "left")
              .join(leaves, ["product_id", "target_table_id", "leaf"], "left")
              .join(sources, ["product_id", "table_id"]))
    code = (F.when(~F.col("formed"), "FOREIGN_KEY_FORMAT_INVALID")
            .when(F.col("targets") > 1, "FOREIGN_KEY_TARGET_AMBIGUOUS")
            .when(F.col("target_column_id").isNull(), "FOREIGN_KEY_TARGET_NOT_FOUND").otherwise("RESOLVED"))
    resolved = code == "RESOLVED"
    return joined.select(
        "product_id", "table_id", "column_id", "foreign_key",
        F.when(resolved, F.col("target_table_id")).alias("target_table_id"),
        F.when(resolved, F.col("target_column_id")).alias("target_column_id"),
        F.when(resolved, F.concat_ws("_", "source_dataset", "column_name", F.lit("to"), "target_dataset", "target_column")).alias("relationship"),
        code.alias("code"))


def match_named(candidates: DataFrame, existing: DataFrame, scope: list[str], id_col: str, kind: str = "COLUMN") -> DataFrame:
    """Match records to existing ones by name or alias; first match by id.

    ``candidates``: scope, name. ``existing``: scope, id, name, aliases, status. Adds id and
    code: KEPT, NEW or RETIRED_<kind>_REUSE. Existing active records that nothing matched come
    back with code RETIRED.
    """
    answers = existing.select(*scope, id_col, "status", F.explode(F.array_distinct(F.transform(
        F.array_union(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>"))), F.lower))).alias("key"))
    answers = first_match(answers, [*scope, "key"], [id_col])
    matched = candidates.withColumn("key", F.lower("name")).join(answers, [*scope, "key"], "left")
    found = matched.select(
        *scope, "name", id_col, F.when(F.col(id_col).isNull(), "NEW").when(F.col("status") == "RETIRED", f"RETIRED_{kind}_REUSE")
        .otherwise("KEPT").alias("code"))
    gone = existing.join(found.select(*scope, id_col).where(F.col(id_col).isNotNull()), [*scope, id_col], "left_anti")
    return found.unionByName(gone.select(*scope, "name", id_col, F.lit("RETIRED").alias("code")))


def reuse_links(wanted: DataFrame, existing: DataFrame, new_id: Column) -> DataFrame:
    """Product-table links: the existing id on (product_id, table_id, usage), else a new one."""
    known = existing.select("product_id", "table_id", "usage", F.col("link_id").alias("known_id"))
    return wanted.join(known, ["product_id", "table_id", "usage"], "left").select(
        *wanted.columns, F.coalesce("known_id", new_id).alias("link_id"), F.col("known_id").isNull().alias("is_new"))


def _decided(cases: list[tuple[Column, str, str, Column]], default: tuple[str, str]) -> list[Column]:
    """decision, code and target columns of an ordered cascade."""
    out = []
    for place, name in ((1, "decision"), (2, "code"), (3, "target_id")):
        chain = None
        for case in cases:
            value = case[place] if place == 3 else F.lit(case[place])
            chain = F.when(case[0], value) if chain is None else chain.when(case[0], value)
        last = F.lit(None).cast("string") if place == 3 else F.lit(default[place - 1])
        out.append(chain.otherwise(last).alias(name))
    return out


def classify_products(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Duplicate decision of every candidate product against the registry.

    ``candidates``: candidate_id, product_id, product_key, status, canonical_hash, operation.
    ``existing``: product_id, product_key, status, canonical_hash, aliases. Rules in order: id,
    key, alias, content. Returns candidate_id, decision, code, target_id.
    """
    def keyed(column: Column, name: str) -> DataFrame:
        rows = existing.select(column.alias(name), F.col("product_id").alias(f"{name}_id"))
        return rows.where(F.col(name).isNotNull()).groupBy(name).agg(F.min(f"{name}_id").alias(f"{name}_id"))

    by_id = existing.select(F.col("product_id").alias("known"), F.col("product_key").alias("known_key"),
                            F.col("status").alias("known_status"), F.col("canonical_hash").alias("known_hash"))
    c = (candidates.join(by_id, F.col("product_id") == F.col("known"), "left")
         .join(keyed(F.col("product_key"), "k"), F.col("product_key") == F.col("k"), "left")
         .join(keyed(F.explode("aliases"), "a"), F.col("product_key") == F.col("a"), "left")
         .join(keyed(F.col("canonical_hash"), "h"), F.col("canonical_hash") == F.col("h"), "left"))
    create, known = F.col("operation") == "create", F.col("known").isNotNull()
    target = F.col("known")
    none = F.lit(None).cast("string")
    return c.select("candidate_id", *_decided([
        (~create & ~known, "BLOCK", "PRODUCT_ID_NOT_FOUND", none),
        (~create & (F.col("known_status") == "RETIRED") & (F.col("status") == "ACTIVE"), "BLOCK", "RETIRED_ID_REUSE", target),
        (~create & (F.col("product_key") != F.col("known_key")), "BLOCK", "PRODUCT_ID_KEY_CONFLICT", target),
        (~create & F.col("canonical_hash").eqNullSafe(F.col("known_hash")), "NO_CHANGE", "PRODUCT_NO_CHANGE", target),
        (~create, "UPDATE", "PRODUCT_UPDATE", target),
        (known, "BLOCK", "PRODUCT_ID_CONFLICT", target),
        (F.col("k_id").isNotNull(), "BLOCK", "PRODUCT_KEY_CONFLICT", F.col("k_id")),
        (F.col("a_id").isNotNull(), "BLOCK", "PRODUCT_ALIAS_CONFLICT", F.col("a_id")),
        (F.col("h_id").isNotNull(), "BLOCK", "PRODUCT_CONTENT_DUPLICATE", F.col("h_id")),
    ], ("CREATE", "PRODUCT_CREATE")))


def classify_tables(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Duplicate decision of every candidate table: by id, locator, then schema hash.

    Both: table_id, locator, status, canonical_hash, schema_hash (candidates also
    candidate_id). Returns candidate_id, decision, code, target_id and, for a possible clone,
    the number of tables of the same schema and the first of them (clones, clone_id):
    their list could grow with the registry.
    """
    by_id = existing.select(F.col("table_id").alias("known"), F.col("locator").alias("known_locator"),
                            F.col("status").alias("known_status"), F.col("canonical_hash").alias("known_hash"))
    at = first_match(existing, ["locator"], ["table_id"]).select(
        F.col("locator").alias("l"), F.col("table_id").alias("l_id"), F.col("status").alias("l_status"))
    like = existing.where("schema_hash IS NOT NULL").groupBy(F.col("schema_hash").alias("s")).agg(
        F.countDistinct("table_id").alias("clones"), F.min("table_id").alias("clone_id"))
    c = (candidates.join(by_id, F.col("table_id") == F.col("known"), "left")
         .join(at, F.col("locator") == F.col("l"), "left")
         .join(like, F.col("schema_hash") == F.col("s"), "left"))
    known, target = F.col("known").isNotNull(), F.col("known")
    none = F.lit(None).cast("string")
    cases = [
        (known & (F.col("known_status") == "RETIRED") & (F.col("status") == "ACTIVE"), "BLOCK", "RETIRED_ID_REUSE", target),
        (known & (F.col("known_locator") != F.col("locator")), "BLOCK", "TABLE_ID_LOCATOR_CONFLICT", target),
        (known & F.col("known_hash").eqNullSafe(F.col("canonical_hash")), "NO_CHANGE", "TABLE_NO_CHANGE", target),
        (known, "UPDATE", "TABLE_UPDATE", target),
        (F.col("l_status") == "RETIRED", "BLOCK", "RETIRED_ID_REUSE", F.col("l_id")),
        (F.col("l_id").isNotNull(), "REUSE", "TABLE_LOCATOR_REUSE", F.col("l_id")),
        (F.col("clones").isNotNull(), "WARN", "POSSIBLE_CLONE", none),
    ]
    out = c.select("candidate_id", "clones", "clone_id", *_decided(cases, ("CREATE", "TABLE_CREATE")))
    clone = F.col("code") == "POSSIBLE_CLONE"
    return out.select("candidate_id", "decision", "code", "target_id", F.when(clone, F.col("clones")).otherwise(0).alias("clones"),
                      F.when(clone, F.col("clone_id")).alias("clone_id"))
