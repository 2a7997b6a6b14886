"""Queries of this subpackage and, where SQL can say the same, their SQL."""

import corpus_pipeline

from . import (
    embedding_dedup,
    line_dedup,
    lz_fingerprint,
    mixing,
    order_minhash,
    packing,
    pii,
    quality,
    substring_dedup,
    suffix_dedup,
)

QUERIES = {
    "op1_order_minhash": order_minhash.op1_order_minhash,
    "op2_mixing": mixing.op2_mixing,
    "op3_quality": quality.op3_quality,
    "op4_embedding_dedup": embedding_dedup.op4_embedding_dedup,
    "op5_lz_fingerprint": lz_fingerprint.op5_lz_fingerprint,
    "op6_line_dedup": line_dedup.op6_line_dedup,
    "op7_pii": pii.op7_pii,
    "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
    "op9_packing": packing.op9_packing,
    "op10_substring_dedup": substring_dedup.op10_substring_dedup,
    "pipeline": corpus_pipeline.run,
}
ORACLE_SQL = {
    "op2_mixing": mixing.ORACLE_SQL,
    "op4_embedding_dedup": embedding_dedup.ORACLE_SQL,
    "op6_line_dedup": line_dedup.ORACLE_SQL,
    "op10_substring_dedup": substring_dedup.ORACLE_SQL,
}
