"""Document fingerprints from a Lempel-Ziv parse.

A text is parsed into phrases, each the shortest string from the present place that is
not in the dictionary yet. The phrases' hashes are the text's set; its fingerprint is
the ``size`` smallest of them (hexadecimal, ascending). The likeness of two
fingerprints estimates the Jaccard similarity of the phrase sets from the smallest
hashes of their union, which tells how well one text's dictionary compresses the other; it
is exact for texts of at most ``size`` phrases.

Documents are dealt by ranges of doc_id and streamed in descending order, so each
meets its successor; the first document of the next range is sent along as a guest.

Edge cases: null text is empty (empty fingerprint; two empty ones are alike by 1, an
empty and another by 0); equal doc_ids are ordered by text, null ones come last; a lone
document is its own successor; very long texts are parsed whole (their dictionary is held
while they are); extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathom.session import lean, ship_package

from .common import BASE, BASE_INVERSE, _powers, mix, shuffle_partitions

SIZE = 128
NO_ID = np.iinfo(np.int64).min
SCHEMA = ("doc_id long, n_chars long, edited string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def parse(text: str, begin: int, node: dict, root: dict, journal: list | None = None) -> tuple[list[int], dict]:
    """Parse ``text`` from ``begin``, inside the phrase that has come to ``node``.

    The dictionary is a trie of nested dicts at ``root``. Returns the ends of the phrases
    completed and the node reached; a rest that is a known phrase completes none.
    ``journal`` receives the nodes added, so that they can be taken out again.
    """
    ends: list[int] = []
    ended, at = ends.append, begin
    if journal is None:
        for c in text[begin:] if begin else text:
            at += 1
            if c in node:
                node = node[c]
            else:
                node[c] = {}
                node = root
                ended(at)
        return ends, node
    added = journal.append
    for c in text[begin:]:
        at += 1
        if c in node:
            node = node[c]
        else:
            node[c] = {}
            added((node, c))
            node = root
            ended(at)
    return ends, node


def phrase_hashes(text: str, ends: list[int], begin: int = 0) -> np.ndarray:
    """32-bit hashes of the phrases that end at ``ends``, the first from ``begin``."""
    if not ends:
        return np.zeros(0, np.uint32)
    part = text[begin:ends[-1]]
    codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mix(codes.astype(np.uint64) + BASE) * _powers(BASE, len(codes))[:-1], out=sums[1:])
    stops = np.array(ends) - begin
    starts = np.concatenate([[0], stops[:-1]])
    whole = (sums[stops] - sums[starts]) * _powers(BASE_INVERSE, len(codes))[starts]
    return (mix(whole) >> np.uint64(32)).astype(np.uint32)


def smallest(*hashes: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The ``size`` smallest distinct hashes, ascending."""
    every = np.concatenate(hashes)
    if len(every) > 4 * size:
        # Repeats are few (phrases of one parse are distinct), so this many hold enough.
        every = np.partition(every, 2 * size)[:2 * size]
    every = np.sort(every)
    return every[np.flatnonzero(np.diff(every, prepend=~every[:1]))][:size]


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    both = np.sort(np.concatenate([a, b]))
    if not len(both):
        return 1.0
    again = np.diff(both, prepend=~both[:1]) == 0
    union = np.cumsum(~again)
    counted = union <= size
    return float((again & counted).sum() / min(size, union[-1]))


def as_text(hashes: np.ndarray) -> str:
    return hashes.astype(">u4").tobytes().hex()


class _Parsed:
    """A parsed text whose dictionary waits for its edited text."""

    __slots__ = ("doc_id", "hashes", "head", "journal", "keep", "node", "root", "start", "text")

    def __init__(self, doc_id, text: str):
        self.doc_id, self.text = doc_id, text
        self.keep = len(text) - len(text) // 3
        self.root: dict = {}
        ends, self.node = parse(text[:self.keep], 0, self.root, self.root)
        self.start = ends[-1] if ends else 0
        self.head = phrase_hashes(text, ends)
        self.journal: list = []
        rest, _ = parse(text, self.keep, self.node, self.root, self.journal)
        self.hashes = smallest(self.head, phrase_hashes(text, rest, self.start))

    def row(self, follower: _Parsed) -> tuple:
        edited = self.text[:self.keep] + follower.text[:len(self.text) - self.keep]
        for node, c in reversed(self.journal):
            del node[c]
        rest, _ = parse(edited, self.keep, self.node, self.root)
        changed = smallest(self.head, phrase_hashes(edited, rest, self.start))
        return (None if self.doc_id == NO_ID else self.doc_id, len(self.text), edited,
                as_text(self.hashes), as_text(changed), likeness(self.hashes, changed),
                likeness(self.hashes, follower.hashes))


def _stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    bucket, last, rows = None, None, []
    for frame in frames:
        for b, guest, key, text in zip(frame["bucket"], frame["guest"], frame["key"], frame["text"], strict=True):
            if b != bucket:
                bucket, last = b, None
            elif last is None:
                continue  # a second guest
            if guest and last is None:
                continue
            now = _Parsed(key, text)
            if last is not None:
                rows.append(last.row(now))
            last = None if guest else now
        if rows:
            got = pd.DataFrame(rows, columns=columns)
            got["doc_id"] = pd.array([r[0] for r in rows], "Int64")
            yield got
            rows = []


def fingerprint_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    The edited text has its last third replaced by the beginning of the next document in
    descending doc_id (after the last: the first). Returns doc_id, n_chars, edited,
    fingerprint, edited_fingerprint, near_edited and near_next.
    """
    ship_package(spark)
    parts = shuffle_partitions(spark)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    # Range bounds of the ids: a few for each partition, whatever the number of documents.
    probs = [i / (4 * parts) for i in range(1, 4 * parts)]
    keys = docs.select(key.cast("double").alias("key"))
    bounds = np.unique(np.array(keys.approxQuantile("key", probs, 0.1 / parts), np.float64))

    def bucket_of(x) -> np.ndarray:
        return np.searchsorted(bounds, np.asarray(x, np.float64))

    own = F.pandas_udf(lambda x: pd.Series(bucket_of(x)), T.IntegerType())
    tops = sorted((r["b"], r["top"]) for r in docs.select(key.alias("key")).select("key", own("key").alias("b"))
                  .groupBy("b").agg(F.max("key").alias("top")).collect())
    # The highest id of each range also goes, as a guest, to the range above it.
    upper = {top: tops[(i + 1) % len(tops)][0] for i, (_, top) in enumerate(tops)}

    def places(x: pd.Series) -> pd.Series:
        mine = bucket_of(x)
        return pd.Series([[int(b)] if v not in upper else [int(b), upper[v]]
                          for b, v in zip(mine.tolist(), x.tolist(), strict=True)])

    to = F.pandas_udf(places, T.ArrayType(T.IntegerType()))
    rows = docs.select(key.alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("key", "text", F.posexplode(to("key")).alias("guest", "bucket"))
    rows = rows.repartition(parts, "bucket").sortWithinPartitions(
        "bucket", "guest", F.col("key").desc(), "text")
    return rows.select("bucket", "guest", "key", "text").mapInPandas(lean(_stream), SCHEMA)


def op5_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return fingerprint_documents(spark, docs).select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next")
