"""Content ids and hashes as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256_hex(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def content_id(prefix: str, *parts: Column) -> Column:
    """``prefix_`` and 16 hexadecimal digits of the SHA-256 of a JSON list of strings."""
    return F.concat(F.lit(f"{prefix}_"), F.substring(
        sha256_hex(F.to_json(F.array(*[p.cast("string") for p in parts]))), 1, 16))


def span_id(source_hash: Column, ordinal: Column) -> Column:
    return F.concat(F.lit("span_"), F.substring(
        sha256_hex(F.concat_ws(":", source_hash, ordinal.cast("string"))), 1, 16))


def replay_identity(decisions: Column) -> Column:
    """Distinct decision structs in order."""
    return F.sort_array(F.array_distinct(decisions))
