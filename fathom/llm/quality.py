"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

1. Every token (a run of letters, digits or other marks, in its own case) falls in one of
   ``VOCABULARY`` rows. Random indexing: a token's context vector is the sum, over all its
   occurrences in the corpus, of fixed sparse ternary vectors of its neighbours.
   Tasks send the rows they touched; the sum has a fixed size.
2. A document is the mean and the spread of its tokens' vectors, with the mean
   similarity of neighbours, the share of tokens that repeat one of the last three, and length.
3. A two-layer numpy network is fitted on labelled documents, at most ``fit_rows`` of
   them chosen by a hash of doc_id (a documented bound; everything else covers all
   documents), and its probabilities are calibrated by a temperature on rows kept
   from the fit.

Labels, language, source and doc_id are never inputs of a score.

Edge cases: null and empty texts get the score of the zero vector; equal texts get equal
scores; very long texts are pooled whole, in slices; null and repeated doc_ids are scored as
rows of their own; extra columns are not read; documents without a label are scored like all others; without any usable
label every score is 0.5; rows of an unlabelled or empty table give an empty or
scored result, never an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.session import lean, release_memory

from .common import Scratch, batches, id_columns, ids_of, mix

VOCABULARY = 1 << 15
DIM = 32
SPARSE = 4
REACH = 2
ROW_BLOCKS = 32
FEATURES = 2 * DIM + 3
SLICE = 1 << 17

_CLASS = np.zeros(256, np.uint8)  # 0: white space, 1: letter, 2: digit, 3: other marks
_CLASS[33:] = 3
_CLASS[:32] = 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[48:58] = 2
_CLASS[65:91] = _CLASS[97:123] = 1
_CLASS[128:] = 1


def tokens(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Row of each token of the texts, and for each text the index of its first token."""
    from .common import BASE, BASE_INVERSE, BYTE_CODE, _powers

    joined = np.frombuffer(b" ".join(raws) + b" ", np.uint8)
    text_at = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raws])])
    kind = _CLASS[joined]
    change = np.flatnonzero(np.diff(kind.astype(np.int8), prepend=-1))
    ends = np.append(change[1:], len(joined))
    word = kind[change] > 0
    starts, ends = change[word], ends[word]
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(BYTE_CODE[joined] * _powers(BASE, len(joined))[:-1], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _powers(BASE_INVERSE, len(joined))[starts])
    return (hashes % np.uint64(VOCABULARY)).astype(np.int64), np.searchsorted(starts, text_at)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the fixed sparse vectors."""
    rng = np.random.default_rng(11)
    return (rng.integers(0, DIM, (VOCABULARY, SPARSE)),
            rng.choice(np.array([-1, 1], np.int64), (VOCABULARY, SPARSE)))


def context_counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The context vectors of a task's documents, in ROW_BLOCKS blocks of rows."""
    from pyspark import TaskContext

    place, sign = index_vectors()
    task = TaskContext.get().partitionId() // 64
    total = np.zeros(VOCABULARY * DIM, np.int64)
    for frame in frames:
        raws = [t.encode() for t in frame["text"]]
        for lo, hi in batches(raws, 1 << 20):
            row, first = tokens(raws[lo:hi])
            owner = np.repeat(np.arange(hi - lo), np.diff(first))
            for step in range(1, REACH + 1):
                near = owner[:-step] == owner[step:]
                a, b = row[:-step][near], row[step:][near]
                for at in range(0, len(a), 1 << 20):
                    x, y = a[at:at + (1 << 20)], b[at:at + (1 << 20)]
                    for k in range(SPARSE):
                        for u, v in ((x, y), (y, x)):
                            total += np.bincount(u * DIM + place[v, k], sign[v, k], len(total)).astype(np.int64)
    rows = VOCABULARY * DIM // ROW_BLOCKS
    for k in range(ROW_BLOCKS):
        part = total[k * rows:(k + 1) * rows]
        if part.any():
            yield pd.DataFrame({"block": [k], "part": [task], "body": [zstandard.compress(part.tobytes(), 1)]})


def _add_blocks(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(zstandard.decompress(b), np.int64) for b in frame["body"])
    return pd.DataFrame({"block": [key[0]], "body": [zstandard.compress(total.tobytes(), 1)]})


def word_vectors(scratch: Scratch, texts: DataFrame) -> np.ndarray:
    """Unit word vectors from all texts; VOCABULARY x DIM, whatever the corpus."""
    partial = texts.mapInPandas(lean(context_counts), "block int, part int, body binary")
    # Sums of 64 tasks first, so that no task adds up all tasks' blocks of a large corpus.
    halfway = partial.groupBy("block", "part").applyInPandas(_add_blocks, "block int, body binary")
    blocks = scratch.save(halfway.groupBy("block").applyInPandas(_add_blocks, "block int, body binary"), "context")
    rows = VOCABULARY * DIM // ROW_BLOCKS
    out = np.zeros(VOCABULARY * DIM, np.float64)
    for r in blocks.collect():
        out[r["block"] * rows:(r["block"] + 1) * rows] = np.frombuffer(zstandard.decompress(bytes(r["body"])), np.int64)
    out = out.reshape(VOCABULARY, DIM)
    out = np.sign(out) * np.log1p(np.abs(out))
    seen = np.abs(out).sum(axis=1) > 0
    if seen.any():
        out[seen] -= out[seen].mean(axis=0)
    norm = np.sqrt((out**2).sum(axis=1, keepdims=True))
    return (out / np.where(norm > 0, norm, 1)).astype(np.float32)


def pooled(raws: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """A feature row for each text. Sums are taken in double precision, in slices of tokens that
    start anew in every text, so a text's row does not depend on its neighbours."""
    out = np.zeros((len(raws), FEATURES), np.float32)
    for lo, hi in batches(raws, 1 << 18):
        row, first = tokens(raws[lo:hi])
        if not len(row):
            continue
        n = np.diff(first)
        owner = np.repeat(np.arange(len(n)), n)
        again, near = np.zeros(len(row), bool), np.zeros(len(row))
        for step in (1, 2, 3):
            again[step:] |= (row[step:] == row[:-step]) & (owner[step:] == owner[:-step])
        some = np.flatnonzero(n)
        total, square = np.zeros((2, len(some), DIM))
        # Slices: each text's own, of at most SLICE tokens (a batch of several texts is shorter).
        cuts = np.unique(np.concatenate([first[:-1][some], np.arange(0, len(row), SLICE)])) if len(some) == 1 else first[:-1][some]
        ends = np.append(cuts[1:], len(row))
        for group in np.array_split(np.arange(len(cuts)), max(1, len(row) // SLICE)):
            if not len(group):
                continue
            begin, end = cuts[group[0]], ends[group[-1]]
            v = vectors[row[begin:end]].astype(np.float64)
            place = np.searchsorted(first[:-1][some], cuts[group], side="right") - 1
            np.add.at(total, place, np.add.reduceat(v, cuts[group] - begin))
            np.add.at(square, place, np.add.reduceat(v * v, cuts[group] - begin))
            near[begin:end - 1] = np.einsum("ij,ij->i", v[:-1], v[1:])
            if end < len(row):
                near[end - 1] = vectors[row[end - 1]].astype(np.float64) @ vectors[row[end]].astype(np.float64)
        near[first[1:][some] - 1] = 0
        at = first[:-1][some]
        mean = total / n[some, None]
        out[lo + some, :DIM] = mean
        out[lo + some, DIM:2 * DIM] = np.sqrt(np.maximum(0, square / n[some, None] - mean**2))
        out[lo + some, 2 * DIM] = np.add.reduceat(near, at) / np.maximum(1, n[some] - 1)
        out[lo + some, 2 * DIM + 1] = np.log1p(n[some]) / 10
        out[lo + some, 2 * DIM + 2] = np.add.reduceat(again.astype(float), at) / n[some]
    return out


class Network:
    """A hidden layer of tanh units, a logistic output, and a temperature."""

    def __init__(self, hidden: int = 24, epochs: int = 300, rate: float = 0.01, decay: float = 1e-3):
        self.hidden, self.epochs, self.rate, self.decay = hidden, epochs, rate, decay
        self.weights: list[np.ndarray] | None = None
        self.temperature = 1.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Network:
        rng = np.random.default_rng(3)
        if len(x) < 2 or y.min() == y.max():
            return self
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        order = rng.permutation(len(x))
        kept = order[:max(1, len(x) // 5)]
        rest = order[len(kept):] if len(x) > 10 else order
        w = [rng.standard_normal((x.shape[1], self.hidden)) / np.sqrt(x.shape[1]), np.zeros(self.hidden),
             rng.standard_normal(self.hidden) / np.sqrt(self.hidden), np.zeros(1)]
        first, second = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
        z, step = (x - self.mean) / self.scale, 0
        best, best_loss = [a.copy() for a in w], np.inf
        for _ in range(self.epochs):
            for rows in np.array_split(rng.permutation(rest), max(1, len(rest) // 256)):
                h = np.tanh(z[rows] @ w[0] + w[1])
                p = 1 / (1 + np.exp(-(h @ w[2] + w[3])))
                d = (p - y[rows]) / len(rows)
                back = np.outer(d, w[2]) * (1 - h**2)
                grads = [z[rows].T @ back + self.decay * w[0], back.sum(axis=0), h.T @ d + self.decay * w[2],
                         np.array([d.sum()])]
                step += 1
                for a, g, m, s in zip(w, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    a -= self.rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
            loss = self._loss(w, z[kept], y[kept], 1.0)
            if loss < best_loss:
                best, best_loss = [a.copy() for a in w], loss
        self.weights = best
        # Smoothed targets, so that a few rows without an error don't claim certainty.
        ones = y[kept].sum()
        soft = np.where(y[kept] > 0.5, (ones + 1) / (ones + 2), 1 / (len(kept) - ones + 2))
        grid = np.exp(np.linspace(np.log(0.2), np.log(10), 121))
        self.temperature = float(min(grid, key=lambda t: self._loss(best, z[kept], soft, t)))
        return self

    @staticmethod
    def _loss(w, z, y, temperature) -> float:
        logit = (np.tanh(z @ w[0] + w[1]) @ w[2] + w[3]) / temperature
        return float(np.mean(np.logaddexp(0, logit) - y * logit))

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        w = self.weights
        logit = (np.tanh((x - self.mean) / self.scale @ w[0] + w[1]) @ w[2] + w[3]) / self.temperature
        return 1 / (1 + np.exp(-logit))


class QualityModel:
    """Word vectors from all texts and a network fitted on labelled ones."""

    def __init__(self, spark: SparkSession, docs: DataFrame, labels: DataFrame, held_out_of: int = 4,
                 held_out: int = 2, fit_rows: int = 20_000):
        """Labels (doc_id, quality) are learnt only from rows whose crc32(doc_id as text) mod
        ``held_out_of`` is not ``held_out``; ``fit_rows`` bounds the labelled rows fitted (as an
        expected number: each label is taken by a hash of its doc_id)."""
        scratch = Scratch(spark, "quality")
        remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % held_out_of
        self.is_held_out = F.coalesce(remainder == held_out, F.lit(False))
        texts = docs.select(*id_columns(), F.coalesce("text", F.lit("")).alias("text"))
        self.vectors = spark.sparkContext.broadcast(word_vectors(scratch, texts.select("text")))
        shared = self.vectors

        def describe(frames):
            for frame in frames:
                got = pooled([t.encode() for t in frame["text"]], shared.value)
                yield pd.DataFrame({"doc_id": ids_of(frame), "x": [r.tobytes() for r in got]})

        self.features = scratch.save(texts.mapInPandas(lean(describe), "doc_id long, x binary"), "features")
        marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y"))
        marked = marked.where("doc_id IS NOT NULL AND y IS NOT NULL").where(remainder != held_out)
        marked = marked.groupBy("doc_id").agg(F.avg("y").alias("y"))
        # A share of the labels by hash, so that no task sends more than its part.
        share = min(1.0, fit_rows / max(1, marked.count()))
        marked = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
        fit = self.features.join(marked, "doc_id").select("doc_id", "x", "y").collect()
        fit.sort(key=lambda r: (r["doc_id"], bytes(r["x"])))
        x = np.array([np.frombuffer(bytes(r["x"]), np.float32) for r in fit], np.float64).reshape(-1, FEATURES)
        self.network = Network().fit(x, np.array([r["y"] for r in fit], np.float64))

    def scores(self) -> DataFrame:
        """(doc_id, score) of the documents it was built from."""
        net = self.network

        def score(frames):
            for frame in frames:
                x = np.frombuffer(b"".join(frame["x"]), np.float32).reshape(-1, FEATURES).astype(np.float64)
                yield pd.DataFrame({"doc_id": ids_of(frame), "score": net.score(x)})

        return self.features.select(*id_columns(), "x").mapInPandas(score, "doc_id long, score double")

    def score_of(self, text: Column) -> Column:
        """The score of a text column, for filtering without a join."""
        net, shared = self.network, self.vectors

        def score(part: pd.Series) -> pd.Series:
            got = net.score(pooled([t.encode() for t in part], shared.value).astype(np.float64))
            release_memory()
            return pd.Series(got)

        return F.pandas_udf(score, "double")(F.coalesce(text, F.lit("")))


def score_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = 0.7,
                  **how) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document; see QualityModel."""
    model = QualityModel(spark, docs, labels, **how)
    return model.scores().select("doc_id", model.is_held_out.alias("held_out"), "score",
                                 F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"),
                         spark.read.parquet(f"{sf_dir}/labels.parquet"))
