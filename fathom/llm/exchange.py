"""Corpus-wide key counting without a row for each key.

Documents are kept once as a table bucketed by chunk (``chunk_bytes`` of text, or one
longer document). The numbers of buckets and of shards of the key space grow with the
bytes of the corpus, so a chunk, a bucket and a shard stay of one size at any scale.
In each round every chunk sends, to each shard of the key space, one compressed
sorted array of its distinct keys; the shard answers with a bit or byte for each
key sent. A frequent key is one entry in each chunk's message, however often it
occurs, so no key can be hot, and the text is never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.session import release_memory

from .common import Scratch, id_columns, shuffle_partitions

MESSAGE = "chunk long, shard int, kind int, body binary, extra binary"
REPLY = "chunk long, shard int, level int, kind int, bits binary"


def chunked(rows: DataFrame, chunk_bytes: int) -> DataFrame:
    """``rows`` with the chunk (long) and row (long, ascending in it) they belong to."""

    def number(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        chunk = row = TaskContext.get().partitionId() << 33
        held = 0
        for batch in batches:
            sizes = pc.add(pc.binary_length(batch.column("text")), 64).to_numpy(zero_copy_only=False)
            at, chunks = 0, np.empty(len(sizes), np.int64)
            for at, size in enumerate(sizes.tolist()):
                if held and held + size > chunk_bytes:
                    chunk, held = chunk + 1, 0
                held += size
                chunks[at] = chunk
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.arange(row, row + len(sizes))), pa.array(chunks)],
                names=[*batch.schema.names, "row", "chunk"])
            row += len(sizes)

    return rows.mapInArrow(number, "doc_id long, no_id boolean, text string, row long, chunk long")


class Exchange:
    def __init__(self, spark: SparkSession, docs: DataFrame, name: str, chunk_bytes: int = 1 << 20,
                 shard_bytes: int = 64 << 20):
        self.scratch = Scratch(spark, name)
        parts = shuffle_partitions(spark)
        rows = docs.select(*id_columns(), F.coalesce(F.col("text"), F.lit("")).alias("text"))
        size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        self.shards = max(2 * parts, -(-size // shard_bytes))
        self.store = self.scratch.save_bucketed(chunked(rows, chunk_bytes), "store", "chunk", max(parts, -(-size // shard_bytes)))
        self.replies: DataFrame | None = None
        self.level = 0

    def visit(self, work: Callable, schema: str) -> DataFrame:
        """``work(chunk, documents in row order, replies so far)`` for every chunk."""

        def alone(key, left):
            try:
                return work(key[0], left.sort_values("row"), None)
            finally:
                release_memory()

        def both(key, left, right):
            if not len(left):
                return pd.DataFrame({})
            try:
                return work(key[0], left.sort_values("row"), right)
            finally:
                release_memory()

        if self.replies is None:
            return self.store.groupBy("chunk").applyInPandas(alone, schema)
        return (self.store.groupBy("chunk").cogroup(self.replies.groupBy("chunk"))
                .applyInPandas(both, schema))

    def round(self, send: Callable, answer: Callable) -> None:
        """``send`` yields (shard, kind, body, extra); ``answer`` maps the messages of
        a shard, as lists of bodies and extras of one kind, to a list of replies."""
        level = self.level

        def sending(chunk, docs, replies):
            out = [(chunk, int(s), k, b, x) for s, k, b, x in send(docs, by_shard(replies))]
            return pd.DataFrame(out, columns=["chunk", "shard", "kind", "body", "extra"])

        def answering(key, got):
            got = got.sort_values(["kind", "chunk"])
            out = []
            for kind, part in got.groupby("kind", sort=True):
                bits = answer(kind, list(part["body"]), list(part["extra"]))
                out += [(c, int(key[0]), level, kind, b)
                        for c, b in zip(part["chunk"], bits, strict=True) if b is not None]
            release_memory()
            return pd.DataFrame(out, columns=["chunk", "shard", "level", "kind", "bits"])

        messages = self.visit(sending, MESSAGE)
        replies = messages.groupBy("shard").applyInPandas(answering, REPLY)
        replies = self.scratch.save(replies, f"replies_{level}")
        self.replies = replies if self.replies is None else self.replies.unionByName(replies)
        self.level += 1

    def finish(self, work: Callable, schema: str) -> DataFrame:
        out = self.scratch.save(self.visit(
            lambda chunk, docs, replies: work(docs, by_shard(replies)), schema), "result")
        self.scratch.drop_tables()
        self.scratch.drop(*[f"replies_{i}" for i in range(self.level)])
        return out


def by_shard(replies: pd.DataFrame | None) -> dict:
    if replies is None:
        return {}
    return {(lv, sh, k): b for lv, sh, k, b in
            zip(replies["level"], replies["shard"], replies["kind"], replies["bits"], strict=True)}


def split_keys(keys: np.ndarray, shards: int):
    """Distinct 64-bit keys, ordered by shard then key, with the shards' bounds.

    Returns (distinct, inverse, counts, bounds); distinct[bounds[s]:bounds[s + 1]]
    are shard s's keys in ascending order.
    """
    distinct, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    shard = (distinct % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    return distinct[order], rank[inverse], counts[order], bounds


def parts_of(bounds: np.ndarray):
    """(shard, from, to) of the shards that have keys."""
    for s in np.flatnonzero(np.diff(bounds)).tolist():
        yield s, int(bounds[s]), int(bounds[s + 1])
