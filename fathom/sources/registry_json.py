"""Registry files: one JSON object a file, read with fixed schemas and checked for strays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOCATOR = "struct<source_system_id:string,catalog:string,schema_name:string,table_name:string>"
SCHEMAS = {
    "products": "product_id string, product_key string, version int, status string, display_name string, aliases array<string>, "
                "canonical_hash string, metrics array<struct<metric_id:string,name:string,aliases:array<string>,status:string>>, "
                "relationships array<struct<relationship_id:string,name:string,aliases:array<string>,status:string>>",
    "tables": f"table_id string, version int, status string, aliases array<string>, schema_hash string, canonical_hash string, locator {LOCATOR}, "
              "columns array<struct<column_id:string,name:string,aliases:array<string>,status:string>>",
    "mappings": "link_id string, product_id string, table_id string, table_version int, usage string, required boolean, semantic_dataset string",
    "changesets": "changeset_id string, table_ids array<string>, required_product_ids array<string>, "
                  "ready_products map<string,struct<version:int,pr_number:int,head_sha:string>>",
}


def read_registry(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """Records of one kind, with the file they came from."""
    return spark.read.schema(SCHEMAS[kind]).option("multiLine", True).option("mode", "FAILFAST").json(f"{root}/{kind}").withColumn(
        "file", F.col("_metadata.file_path"))


def unknown_keys(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """(file, key) of top-level keys that no schema field has; Spark's reader drops them silently."""
    known = [f.name for f in T._parse_datatype_string(SCHEMAS[kind]).fields]
    raw = spark.read.option("wholetext", True).text(f"{root}/{kind}").select(F.col("_metadata.file_path").alias("file"), "value")
    keys = raw.select("file", F.explode(F.coalesce(
        F.json_object_keys("value"), F.flatten(F.transform(F.from_json("value", "array<string>"), F.json_object_keys)))).alias("key"))
    return keys.where(~F.col("key").isin(*known)).distinct()


def locator_key(locator: Column) -> Column:
    """``system|catalog|schema|table`` in lower case."""
    return F.lower(F.concat_ws("|", locator["source_system_id"], locator["catalog"], locator["schema_name"], locator["table_name"]))
