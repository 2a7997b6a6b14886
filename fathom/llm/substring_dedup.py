"""Substring dedup by level-wise doubling over words.

Words are ``[^\\x20\\x09-\\x0D]+``. Every window of ``start_words`` words is counted
over the whole corpus; only where two adjacent windows both repeat are they joined
to a window of twice the length and counted again, level by level up to
``window_words`` or until no candidate survives. At the last level the first
occurrence (smallest doc_id, then position) of each window is settled exactly and
every word covered by a later occurrence is removed.

The short levels are counted by 32-bit keys inside each shard of the key space: they
may let a unique window pass to the next level, never stop a repeated one. The last
level compares 64-bit keys.

Chunks and shards are sized by bytes; a text longer than a chunk is a chunk of its own.

Edge cases: null text has no words; texts under ``window_words`` words lose nothing;
equal texts lose all words but the first one's, ties of doc_id going to the row in
the earlier chunk; null doc_ids come last; very long texts are read whole; extra columns
are not read; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NULL_ID, batches, ids_of, mix, pack, pack_sorted, unpack, unpack_sorted, word_table
from .exchange import Exchange, parts_of, split_keys

SCHEMA = "doc_id long, n_words long, n_removed long, kept_text string"


def _window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of ``length`` words from each position; the array is shorter by length - 1."""
    n = len(words) - length + 1
    total = np.zeros(max(n, 0), np.uint64)
    for i in range(length):
        total = mix(total + words[i:i + n] + np.uint64(i)) if n > 0 else total
    return total


def _levels(start: int, window: int) -> list[int]:
    out = [start]
    while out[-1] * 2 <= window:
        out.append(out[-1] * 2)
    if out[-1] != window:
        raise ValueError("window_words must be start_words times a power of two")
    return out


class _Chunk:
    """Candidate positions of one chunk, level by level, from the replies so far."""

    def __init__(self, docs: pd.DataFrame, levels: list[int], shards: int, replies: dict):
        self.docs, self.levels, self.shards = docs, levels, shards
        self.raws = [t.encode() for t in docs["text"]]
        words, first = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
        at = 0
        for lo, hi in batches(self.raws):
            _, _, _, h, f = word_table(self.raws[lo:hi])
            words.append(h)
            first.append(f[1:] + at)
            at += len(h)
        self.words, self.first = np.concatenate(words), np.concatenate(first)
        self.owner = np.repeat(np.arange(len(self.raws)), np.diff(self.first))
        start = levels[0]
        self.hash = _window_hashes(self.words, start)
        self.at = np.flatnonzero(self.owner[:len(self.hash)] == self.owner[start - 1:]) \
            if len(self.hash) else np.zeros(0, np.int64)
        self.keys = self.hash[self.at]
        for level, length in enumerate(levels):
            self.distinct, self.inverse, self.counts, self.bounds = split_keys(self.keys, shards)
            if level == len(levels) - 1 or not any(k[0] == level for k in replies):
                break
            self._double(self.repeated(level, replies), length)

    def repeated(self, level: int, replies: dict) -> np.ndarray:
        """For each distinct key whether it repeats (last level: starts here first)."""
        out = np.zeros(len(self.distinct), bool)
        for s, lo, hi in parts_of(self.bounds):
            bits = np.frombuffer(replies[level, s, 0], np.uint8)
            out[lo:hi] = np.unpackbits(bits, count=hi - lo).astype(bool)
        return out

    def _double(self, repeated: np.ndarray, length: int) -> None:
        hit = repeated[self.inverse]
        here = np.zeros(len(self.words) + 1, bool)
        here[self.at[hit]] = True
        value = np.zeros(len(self.words) + 1, np.uint64)
        value[self.at] = self.keys
        at = self.at[hit]
        at = at[(at + 2 * length <= self.first[self.owner[at] + 1])]
        at = at[here[at + length]]
        self.at, self.keys = at, mix(value[at] * np.uint64(0x9E3779B97F4A7C15) + value[at + length])


def _narrow(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys // np.uint64(shards)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def remove_repeated_words(spark: SparkSession, docs: DataFrame, window_words: int = 20,
                          start_words: int = 5) -> DataFrame:
    """Each document without the words that repeat earlier ones (see module).

    Returns doc_id, n_words, n_removed and kept_text: the kept words joined by a space.
    """
    levels = _levels(start_words, window_words)
    ex = Exchange(spark, docs, "substring")
    shards, last = ex.shards, len(levels) - 1

    def send_short(docs, replies):
        c = _Chunk(docs, levels, shards, replies)
        for s, lo, hi in parts_of(c.bounds):
            # Equal narrow keys of distinct windows count as one repeated key.
            keys = _narrow(c.distinct[lo:hi], shards)
            order = np.argsort(keys, kind="stable")
            yield s, 0, pack_sorted(keys[order]), pack(
                np.packbits(c.counts[lo:hi] > 1), order.astype(np.uint32)
                if (np.diff(order) != 1).any() else None)

    def answer_short(_, bodies, extras):
        keys = [unpack_sorted(b, np.uint32) for b in bodies]
        notes = [unpack(x) for x in extras]
        flat = np.concatenate(keys)
        value, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
        again = (counts > 1)[inverse]
        at = 0
        for k, (dup, order) in zip(keys, notes, strict=True):
            got = np.zeros(len(k), bool)
            got[slice(None) if order is None else order] = again[at:at + len(k)]
            got |= np.unpackbits(dup, count=len(k)).astype(bool)
            # A window repeated within one chunk is so for the other chunks as well:
            # they hold the same key, so its count is over 1 there.
            yield np.packbits(got).tobytes()
            at += len(k)

    def send_last(docs, replies):
        c = _Chunk(docs, levels, shards, replies)
        ids = docs["doc_id"].to_numpy(np.int64)
        least = np.full(len(c.distinct), NULL_ID)
        np.minimum.at(least, c.inverse, ids[c.owner[c.at]])
        for s, lo, hi in parts_of(c.bounds):
            yield s, 0, pack_sorted(c.distinct[lo:hi]), pack(least[lo:hi])

    def answer_last(_, bodies, extras):
        keys = [unpack_sorted(b, np.uint64) for b in bodies]
        sender = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        flat, least = np.concatenate(keys), np.concatenate([unpack(x)[0] for x in extras])
        order = np.lexsort((sender, least, flat))
        first = np.zeros(len(flat), bool)
        first[order] = np.diff(flat[order], prepend=~flat[order][:1]) != 0
        at = 0
        for k in keys:
            yield np.packbits(first[at:at + len(k)]).tobytes()
            at += len(k)

    for _ in levels[:-1]:
        ex.round(send_short, answer_short)
    ex.round(send_last, answer_last)

    def cut(docs, replies):
        c = _Chunk(docs, levels, shards, replies)
        ids = docs["doc_id"].to_numpy(np.int64)
        mine = c.repeated(last, replies)
        # The chunk's own first occurrence of a key that starts here first stays.
        order = np.lexsort((c.at, ids[c.owner[c.at]], c.inverse))
        head = np.zeros(len(order), bool)
        if len(order):
            head[order[np.diff(c.inverse[order], prepend=-1) != 0]] = True
        later = c.at[~(head & mine[c.inverse])]
        cover = np.zeros(len(c.words) + 1, np.int64)
        np.add.at(cover, later, 1)
        np.add.at(cover, later + window_words, -1)
        gone = np.cumsum(cover)[:-1] > 0
        out = []
        for i in range(len(c.raws)):
            lo, hi = c.first[i], c.first[i + 1]
            lost = gone[lo:hi]
            words = _words(c.raws[i])
            kept = [w for w, x in zip(words, lost, strict=True) if not x] if lost.any() else words
            out.append((hi - lo, int(lost.sum()), b" ".join(kept).decode()))
        got = pd.DataFrame(out, columns=["n_words", "n_removed", "kept_text"])
        got.insert(0, "doc_id", ids_of(docs))
        return got

    return ex.finish(cut, SCHEMA)


#: bytes.split() splits at exactly the six separators of the word pattern.
def _words(raw: bytes) -> list[bytes]:
    return raw.split()


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = remove_repeated_words(spark, docs)
    return out.select("doc_id", "n_words", "n_removed",
                      F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH w AS (
  SELECT doc_id, string_split(trim(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), ' ') AS words
  FROM documents),
n AS (SELECT doc_id, CASE WHEN words = [''] THEN [] ELSE words END AS words FROM w),
p AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS pos FROM n),
h AS (SELECT doc_id, pos, md5(array_to_string(words[pos:pos + 19], ' ')) AS k FROM p),
r AS (SELECT doc_id, pos FROM (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY k ORDER BY doc_id, pos) AS rn FROM h) WHERE rn > 1),
g AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM r),
x AS (SELECT doc_id, list(pos) AS gone FROM g GROUP BY doc_id)
SELECT n.doc_id, len(words)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN words ELSE
    [words[i] FOR i IN range(1, len(words) + 1) IF NOT list_contains(gone, i)] END, ' ')) AS kept_sha256
FROM n LEFT JOIN x USING (doc_id)
"""
