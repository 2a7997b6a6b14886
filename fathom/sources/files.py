"""File sources: submissions as binary rows, checked by role, signature, size and hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_BYTES = 50 * 1024 * 1024
# Folder and extensions of each role, and signatures.
ROLES = {"product_html": ("product-info", ("html", "htm")), "semantic_document": ("semantic", ("docx", "pdf")),
         "dictionary": ("dictionary", ("xlsx",))}
MISSING = {"product_html": "MISSING_PRODUCT_HTML", "semantic_document": "MISSING_SEMANTIC_DOCUMENT", "dictionary": "MISSING_DICTIONARY"}
MULTIPLE = {"product_html": "MULTIPLE_PRODUCT_HTML_DOCUMENTS", "semantic_document": "MULTIPLE_SEMANTIC_DOCUMENTS",
            "dictionary": "MULTIPLE_DICTIONARY_DOCUMENTS"}


def role_of(path: Column) -> Column:
    """The role a path has by its folder and extension, or null."""
    out = None
    for role, (folder, extensions) in ROLES.items():
        is_role = path.rlike(rf"/{folder}/[^/]+\.({'|'.join(extensions)})$")
        out = F.when(is_role, role) if out is None else out.when(is_role, role)
    return out


def signature_ok(path: Column, content: Column) -> Column:
    """Whether the first bytes fit the extension."""
    head = F.hex(F.substring(content, 1, 8))
    kind = F.lower(F.regexp_extract(path, r"\.([^.]+)$", 1))
    return (F.when(kind.isin("docx", "xlsx"), head.startswith("504B0304")).when(kind == "pdf", head.startswith("25504446"))
            .when(kind.isin("html", "htm"), F.locate("<", F.substring(content, 1, 8).cast("string")) > 0).otherwise(False))


def snapshot(files: DataFrame) -> DataFrame:
    """Adds product_id, role, size and sha256 to binary file rows (path, content)."""
    return files.select(
        "path", "content", F.regexp_extract("path", r"/([^/]+)/sources/", 1).alias("product_id"), role_of(F.col("path")).alias("role"),
        F.length("content").cast("long").alias("size"), F.sha2("content", 256).alias("sha256"))


def read_submissions(spark: SparkSession, root: str) -> DataFrame:
    return snapshot(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "content"))


def scan_findings(files: DataFrame, products: DataFrame) -> DataFrame:
    """(product_id, code): a missing, repeated, too large or mislabelled source."""
    roles = products.select("product_id", F.explode(F.array(*[F.lit(r) for r in ROLES])).alias("role"))
    counted = files.where("role IS NOT NULL").groupBy("product_id", "role").agg(F.count("*").alias("n"))
    j = roles.join(counted, ["product_id", "role"], "left")
    code = None
    for role in ROLES:
        for failed, value in ((F.col("n").isNull(), MISSING[role]), (F.col("n") > 1, MULTIPLE[role])):
            c = (F.col("role") == role) & failed
            code = F.when(c, value) if code is None else code.when(c, value)
    out = j.select("product_id", code.alias("code")).where("code IS NOT NULL")
    each = (F.when(F.col("size") > MOST_BYTES, "SOURCE_TOO_LARGE")
            .when(~signature_ok(F.col("path"), F.col("content")), "SOURCE_SIGNATURE_MISMATCH"))
    return out.unionByName(files.where("role IS NOT NULL").select("product_id", each.alias("code")).where("code IS NOT NULL"))


def snapshot_findings(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """(path, code) of files whose size or hash isn't the manifest's."""
    m = manifest.select("path", F.col("size").alias("want_size"), F.col("sha256").alias("want_hash"))
    code = (F.when(F.col("size") != F.col("want_size"), "SOURCE_SNAPSHOT_SIZE_MISMATCH")
            .when(F.col("sha256") != F.col("want_hash"), "SOURCE_SNAPSHOT_HASH_MISMATCH"))
    return files.join(m, "path").select("path", code.alias("code")).where("code IS NOT NULL")


def trusted_file(files: DataFrame, path: str, expected_hash: str) -> DataFrame:
    """The file at ``path`` if its hash is the expected one; no row otherwise."""
    return files.where((F.col("path") == path) & (F.sha2("content", 256) == expected_hash))
