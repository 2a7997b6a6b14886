"""Sinks: registry files, reports, manifests and release bundles.

Tables are written by Spark. What is one small file by its nature (a result envelope, a
bundle of a product's artifacts) is written on the driver, through a staged name.
"""

from __future__ import annotations

import hashlib
import io
import json
import os
import shutil
import uuid
import zipfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The largest bundle written on the driver.
MOST_BUNDLE_BYTES = 256 * 1024 * 1024
FIXED_TIME = (1980, 1, 1, 0, 0, 0)


def write_records(records: DataFrame, path: str, by: str | None = None) -> None:
    """Registry records as JSON lines, a folder a value of ``by`` if given."""
    writer = records.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).json(path)


def json_rows(records: DataFrame, key: str) -> DataFrame:
    """(key, json): each record as a JSON text, null fields left out."""
    rest = [c for c in records.columns]
    return records.select(F.col(key), F.to_json(F.struct(*rest)).alias("json"))


def manifest(files: DataFrame) -> DataFrame:
    """(product_id, manifest): the sources of each product as JSON, by path."""
    f = F.struct("path", "role", "sha256", "size")
    return files.where("role IS NOT NULL").groupBy("product_id").agg(F.to_json(F.struct(F.sort_array(F.collect_list(f)).alias("sources"))).alias("manifest"))


def write_json_atomically(path: str, value: object) -> None:
    """One JSON file on the driver: written beside its place, synced, then renamed."""
    staged = f"{path}.{uuid.uuid4().hex}.tmp"
    with open(staged, "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, sort_keys=True, indent=2)
        f.write("\n")
        f.flush()
        os.fsync(f.fileno())
    os.replace(staged, path)


def promote(staged: dict[str, str]) -> None:
    """Put staged folders in place of live ones, all or none: {live: staged}."""
    backups: list[tuple[str, str]] = []
    done: list[str] = []
    try:
        for live, new in staged.items():
            if os.path.exists(live):
                backup = f"{live}.{uuid.uuid4().hex}.old"
                os.rename(live, backup)
                backups.append((live, backup))
            os.rename(new, live)
            done.append(live)
    except OSError:
        for live in done:
            shutil.rmtree(live, ignore_errors=True)
        for live, backup in backups:
            if not os.path.exists(live):
                os.rename(backup, live)
        raise
    for _, backup in backups:
        shutil.rmtree(backup, ignore_errors=True)


def release_bundle(artifacts: DataFrame, product_id: str) -> bytes:
    """A product's artifacts (product_id, name, content) as a reproducible ZIP.

    Names are sorted and times fixed, so equal artifacts give equal bytes. One product's
    artifacts are small; their total is checked before they are fetched.
    """
    own = artifacts.where(F.col("product_id") == product_id)
    total = own.agg(F.coalesce(F.sum(F.length("content")), F.lit(0)).alias("n")).first()["n"]
    if total > MOST_BUNDLE_BYTES:
        raise ValueError("RELEASE_BUNDLE_TOO_LARGE")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=9) as z:
        for row in own.orderBy("name").collect():
            info = zipfile.ZipInfo(row["name"], FIXED_TIME)
            info.compress_type = zipfile.ZIP_DEFLATED
            info.external_attr = 0o644 << 16
            z.writestr(info, bytes(row["content"]))
    return out.getvalue()


def verify_bundle(bundle: bytes, expected: dict[str, str]) -> str | None:
    """Null for a bundle that holds exactly the expected names and hashes, else why not."""
    try:
        with zipfile.ZipFile(io.BytesIO(bundle)) as z:
            if sorted(z.namelist()) != sorted(expected):
                return "RELEASE_BUNDLE_CONTENT_MISMATCH"
            if any(hashlib.sha256(z.read(n)).hexdigest() != h for n, h in expected.items()):
                return "RELEASE_BUNDLE_HASH_MISMATCH"
    except zipfile.BadZipFile:
        return "RELEASE_BUNDLE_INVALID"
    return None


def result_envelope(command: str, outputs: dict[str, object], version: int = 1) -> dict[str, object]:
    return {"command": command, "outputs": outputs, "schema_version": version}
