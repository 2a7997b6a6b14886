"""Shared plumbing: staged tables, compact arrays, text hashing, connected components.

Conventions that hold for every operator in this subpackage:

* only the columns an operator names are read, so extra columns (whatever their
  names) neither reach the result nor clash with internal ones;
* a null text counts as an empty one; a null ``doc_id`` is an ordinary value that
  sorts after all others; repeated rows are separate documents;
* an empty table gives an empty result with the usual columns.
"""

from __future__ import annotations

import pickle
import uuid

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.session import shared_dir, ship_package

NULL_ID = np.iinfo(np.int64).max


def id_columns() -> list[Column]:
    """doc_id as a long that is never null, and no_id where it is: pandas would make
    a column with nulls floating-point, and long ids inexact."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
            F.col("doc_id").isNull().alias("no_id")]


def ids_of(frame: pd.DataFrame) -> pd.arrays.IntegerArray:
    """The ids of such columns, with their nulls."""
    return pd.arrays.IntegerArray(frame["doc_id"].to_numpy(np.int64).copy(), frame["no_id"].to_numpy(bool).copy())


class Scratch:
    """Tables written between the steps of one operator run.

    They cut lineage: a lost executor costs its running tasks only.
    """

    def __init__(self, spark: SparkSession, name: str):
        ship_package(spark)
        self.spark = spark
        self.id = f"fathom_{name}_{uuid.uuid4().hex[:12]}"
        self.root = f"{shared_dir(spark).rstrip('/')}/{self.id}"
        self.tables: list[str] = []

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def save_bucketed(self, df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
        """A bucketed table: later groupings by ``key`` need no shuffle of it."""
        table = f"{self.id}_{name}"
        (df.write.format("parquet").option("compression", "zstd")
         .bucketBy(buckets, key).saveAsTable(table))
        self.tables.append(table)
        return self.spark.table(table)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)

    def drop_tables(self) -> None:
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.tables = []


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


HOT_KEYS = 10_000


def join_counted(rows: DataFrame, counted: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows`` joined by ``keys`` to ``counted``, a row for each key with its count n.

    Keys that hold more than a 10 000th of all ``total`` rows are fewer than that, so
    they are broadcast and their rows stay where they are; the others are shuffled.
    Both inputs are read twice and should be stored tables.
    """
    limit = max(1, total // HOT_KEYS)
    hot = F.broadcast(counted.where(F.col("n") > limit))
    cold = rows.join(hot.select(*keys), keys, "left_anti").join(counted.where(F.col("n") <= limit), keys)
    return rows.join(hot, keys).unionByName(cold)


# ---------------------------------------------------------------- compact arrays
def pack(*values) -> bytes:
    return zstandard.compress(pickle.dumps(values, protocol=5), 1)


def unpack(blob: bytes) -> tuple:
    return pickle.loads(zstandard.decompress(blob))


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending unsigned keys as byte planes of their differences."""
    if not len(keys):
        return b""
    steps = np.diff(keys, prepend=keys.dtype.type(0))
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(len(keys), keys.itemsize).T)
    return zstandard.compress(planes.tobytes(), 1)


def unpack_sorted(blob: bytes, dtype) -> np.ndarray:
    if not blob:
        return np.zeros(0, dtype)
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(width, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(dtype).ravel(), dtype=dtype)


# ---------------------------------------------------------------- hashing of text
_RNG = np.random.default_rng(20240607)
BYTE_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """The first n + 1 powers; kept for the life of a worker up to the longest asked for."""
    known = _POWERS.get(int(base))
    if known is None or len(known) <= n:
        steps = np.full(max(n, 1 << 16) + 1, base, np.uint64)
        steps[0] = 1
        known = np.cumprod(steps, dtype=np.uint64)
        if n <= 1 << 23:
            _POWERS[int(base)] = known
    return known[:n + 1]


def word_table(raws: list[bytes]):
    """Words ``[^\\x20\\x09-\\x0D]+`` of a list of texts given as UTF-8.

    Returns start and end byte of each word in the texts joined by a space, its
    64-bit hash, and for each text the index of its first word (one more at the end).
    """
    joined = np.frombuffer(b" ".join(raws) + b" ", np.uint8)
    sizes = np.array([len(r) + 1 for r in raws], np.int64)
    text_at = np.concatenate([[0], np.cumsum(sizes)])
    inside = ~IS_SPACE[joined]
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    starts, ends = edge[::2], edge[1::2]
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(BYTE_CODE[joined] * _powers(BASE, len(joined))[:-1], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _powers(BASE_INVERSE, len(joined))[starts])
    return joined, starts, ends, hashes, np.searchsorted(starts, text_at)


def batches(raws: list[bytes], limit: int = 4 << 20):
    """Slices of a list of texts of about ``limit`` bytes each, whole texts only."""
    at, size = 0, 0
    for i, raw in enumerate(raws):
        if size and size + len(raw) > limit:
            yield at, i
            at, size = i, 0
        size += len(raw) + 1
    if at < len(raws):
        yield at, len(raws)


# ---------------------------------------------------------------- components
def connected_components(spark: SparkSession, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of undirected ``edges`` (a, b); component: the smallest node.

    Alternating large-star and small-star steps; every step aggregates with
    map-side combine, is written to the shared folder, and their number is
    logarithmic in the size of the largest component.
    """
    edges = edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = scratch.save(edges, "cc_0")
    step = 0
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("lu"), F.least("u", "m").alias("low"))
        large = (both.join(low, F.col("u") == F.col("lu")).where("v > u")
                 .select(F.col("v").alias("u"), F.col("low").alias("v")).distinct())
        step += 1
        large = scratch.save(large, f"cc_{step}")
        down = large.groupBy("u").agg(F.min("v").alias("low")).select(
            F.col("u").alias("lu"), "low")
        joined = large.join(down, F.col("u") == F.col("lu"))
        small = (joined.select("u", F.col("low").alias("v"))
                 .unionAll(joined.select(F.col("v").alias("u"), F.col("low").alias("v")))
                 .where("u <> v").distinct())
        step += 1
        small = scratch.save(small, f"cc_{step}")
        changed = small.exceptAll(edges).limit(1).count() + edges.exceptAll(small).limit(1).count()
        scratch.drop(f"cc_{step - 1}", f"cc_{step - 2}")
        edges = small
        if not changed:
            break
    return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
