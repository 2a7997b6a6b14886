"""Five stages from raw documents to packed token sequences.

Each function takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written and read again as the next one's docs. All but the last return the columns of
documents. The quality classifier has no SQL, so neither has the whole.

Edge cases: null texts are empty; each stage treats nulls, very long texts, ties and repeated
rows as its operator states; extra columns of documents are not read; stages give no rows for an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.llm.common import Scratch
from fathom.llm.line_dedup import delete_repeated_lines
from fathom.llm.mixing import mixed_documents
from fathom.llm.order_minhash import drop_near_duplicates
from fathom.llm.packing import pack_tokens
from fathom.llm.quality import QualityModel

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
ORACLE_SQL = None


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.7 or more."""
    model = QualityModel(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(model.score_of(F.col("text")) >= 0.7).select(*COLUMNS)


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeated runs of lines."""
    cut = delete_repeated_lines(docs.select(*COLUMNS))
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return drop_near_duplicates(spark, docs.select(*COLUMNS))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words of each document that each pass of the mix takes."""
    return mixed_documents(docs).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed token sequences."""
    return pack_tokens(spark, docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                                           "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality classifier", keep_good_documents),
    ("line dedup", cut_repeated_lines),
    ("MinHash near-dedup", keep_one_of_near_duplicates),
    ("mixing sources to target weights", mix_to_weights),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to documents."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage_{i}")
        if i:
            scratch.drop(f"stage_{i - 1}")
    return docs
