"""A product's configuration: one small YAML file, read on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

OPERATIONS = ("create", "update")
SCHEMA = ("product_id string, product_key string, operation string, display_name string, description string, changeset_id string, "
          "base_version int, version int, tables array<struct<locator:string,table_id:string,usage:string,base_version:int,version:int>>")


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """One row. Needs a YAML reader; unknown operations and repeated locators are errors."""
    try:
        import yaml
    except ModuleNotFoundError as e:
        raise RuntimeError("reading YAML needs the yaml package") from e
    with open(path, encoding="utf-8") as f:
        found = yaml.safe_load(f)
    if not isinstance(found, dict) or not found.get("product_key"):
        raise ValueError("MISSING_PRODUCT_CONFIG")
    if found.get("operation") == "retire":
        raise ValueError("RETIRE_NOT_SUPPORTED")
    if found.get("operation") not in OPERATIONS:
        raise ValueError("OPERATION_UNKNOWN")
    tables = [(str(t["locator"]).lower(), t.get("table_id"), t.get("usage"), t.get("base_version"), t.get("version")) for t in found.get("tables", [])]
    if len({t[0] for t in tables}) != len(tables):
        raise ValueError("DUPLICATE_TABLE_CONFIG")
    keys = ("product_id", "product_key", "operation", "display_name", "description", "changeset_id", "base_version", "version")
    return spark.createDataFrame([(*[found.get(k) for k in keys], tables)], SCHEMA)
