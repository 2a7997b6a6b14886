"""Embedding near-dedup with randomised-rotation binary codes.

1. Equal vectors become one node with a multiplicity, so a common vector costs one row.
2. The signs of a unit vector in several random rotations are its code, the inner
   product of vector and code its stored correction factor.
3. Candidates: each of ``tables`` slices of ``bits`` signs of the code deals the vectors into
   cells. The number of tables is set from the number of bits so that a pair exactly at the
   threshold shares no cell with a chance of at most ``miss`` (closer pairs: far less); the
   number of bits grows with the logarithm of the number of vectors, which holds the
   cells' mean size. Only ids and codes are dealt. Cells above ``cell_rows`` are split
   into blocks, every pair of blocks being one group.
4. In a group a pair is looked at in the first table only in which it shares a cell. Pairs
   whose codes differ in more signs than a pair at the threshold does, by ``sigmas``
   deviations, are out. The vectors of the others are fetched: code . vector / factor
   estimates the cosine without bias, with a known spread, and only pairs whose upper
   confidence bound (``sigmas`` deviations) reaches the threshold are recomputed, in
   double precision.
5. A group returns link counts by node and a spanning forest of its links, never its
   pairs; components are found from the forests' edges.

Edge cases: vectors that are null, zero, or hold null or non-finite values link with
nothing, not even equal ones, and are kept; equal vec_ids are separate rows; a null vec_id
sorts last; vectors of different lengths are compared within their length; very long
vectors have longer codes; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NULL_ID, Scratch, connected_components

PAIRS = 1 << 16  # handled at a time


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


class Codes:
    """Signs of unit vectors in whole rotations, enough for ``tables`` slices of ``bits``."""

    def __init__(self, tables: int, bits: int, seed: int = 77):
        self.tables, self.bits, self.seed = tables, bits, seed
        self.planes: dict[int, np.ndarray] = {}

    def turned(self, x: np.ndarray) -> np.ndarray:
        """The vectors in all rotations, side by side, as unit vectors; double precision."""
        dim = x.shape[1]
        if dim not in self.planes:
            turns = -(-self.tables * self.bits // dim)
            self.planes[dim] = np.concatenate([rotation(dim, self.seed + i) for i in range(turns)], axis=1) / math.sqrt(turns)
        return x @ self.planes[dim]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (packed signs) and correction factors."""
        turned = self.turned(x)
        return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / math.sqrt(turned.shape[1])

    def width(self, dim: int) -> int:
        return -(-self.tables * self.bits // dim) * dim

    def signs(self, codes: np.ndarray, dim: int) -> np.ndarray:
        """Codes as rows of 1 and -1."""
        return np.unpackbits(codes, axis=1, count=self.width(dim)).astype(np.float32) * 2 - 1

    def cells(self, codes: np.ndarray) -> np.ndarray:
        """The cell of each code in each table."""
        signs = np.unpackbits(codes, axis=1, count=self.tables * self.bits)
        return signs.reshape(len(codes), self.tables, self.bits) @ (1 << np.arange(self.bits)).astype(np.int64)


def plan_tables(n: int, threshold: float, miss: float) -> tuple[int, int]:
    """(tables, bits) for ``n`` vectors; 40 bits serve 2e13 vectors."""
    bits = min(40, max(6, math.ceil(math.log2(max(n, 1) / 64 + 1))))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return math.ceil(math.log(miss) / math.log(1 - same)), bits


def first_met(cells: np.ndarray, table: int, i: np.ndarray, j: np.ndarray):
    """Slices of the pairs that share no cell of an earlier table."""
    for k in range(0, len(i), PAIRS):
        a, b = i[k:k + PAIRS], j[k:k + PAIRS]
        fresh = ~(cells[a, :table] == cells[b, :table]).any(axis=1) if table else np.ones(len(a), bool)
        yield a[fresh], b[fresh]


def near_codes(signs: np.ndarray, cells: np.ndarray, table: int, left: np.ndarray, right: np.ndarray,
               threshold: float, sigmas: float) -> np.ndarray:
    """Indexes of rows with a partner, first met in ``table``, whose code is near enough."""
    m = signs.shape[1]
    apart = math.acos(threshold) / math.pi  # chance of a differing sign
    least = m - 2 * m * (apart + sigmas * math.sqrt(apart * (1 - apart) / m))
    i, j = np.nonzero(signs[left] @ signs[right].T >= least)
    i, j = left[i], right[j]
    i, j = i[i != j], j[i != j]
    near = np.zeros(len(signs), bool)
    for a, b in first_met(cells, table, i, j):
        near[a] = near[b] = True
    return np.flatnonzero(near)


def linked_pairs(x: np.ndarray, turned: np.ndarray, signs: np.ndarray, factor: np.ndarray, cells: np.ndarray, table: int,
                 left: np.ndarray, right: np.ndarray, threshold: float, sigmas: float):
    """Index pairs (i of ``left``, j of ``right``) linked, first met in ``table``."""
    m = signs.shape[1]
    spread = np.sqrt(np.maximum(0, 1 - factor**2)) / factor / math.sqrt(max(1, m - 1))
    estimate = (signs[left] / (math.sqrt(m) * factor[left, None])) @ turned[right].T
    i, j = np.nonzero(estimate + sigmas * spread[left, None] >= threshold)
    out = []
    for a, b in first_met(cells, table, left[i], right[j]):  # exact, in double precision
        hit = np.einsum("ij,ij->i", x[a], x[b]) >= threshold
        out.append((a[hit], b[hit]))
    none = np.zeros(0, np.int64)
    return np.concatenate([o[0] for o in out] or [none]), np.concatenate([o[1] for o in out] or [none])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links."""
    root = list(range(n))

    def find(v):
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    kept = []
    for u, v in zip(a.tolist(), b.tolist(), strict=True):
        ru, rv = find(u), find(v)
        if ru != rv:
            root[ru] = rv
            kept.append((u, v))
    return kept


def link_embeddings(spark: SparkSession, vectors: DataFrame, threshold: float = 0.95, miss: float = 1e-6,
                    sigmas: float = 5.0, cell_rows: int = 2048) -> DataFrame:
    """Links by cosine >= ``threshold`` (see module), a row for each vector.

    Returns vec_id, n_links, component_id and kept (vec_id = component_id).
    """
    scratch = Scratch(spark, "embedding")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.withColumn("valid", F.expr(
        "v IS NOT NULL AND size(v) > 0 AND forall(v, e -> e IS NOT NULL AND NOT isnan(e) AND abs(e) < double('Infinity')) "
        "AND exists(v, e -> e <> 0)")).withColumn("valid", F.coalesce("valid", F.lit(False)))
    rows = rows.withColumn("node", F.when(F.col("valid"), F.xxhash64(F.expr("transform(v, e -> e + 0.0D)"))))
    nodes = scratch.save(rows.where("valid").groupBy("node", F.expr("transform(v, e -> e + 0.0D)").alias("v")).agg(
        F.count("*").alias("copies"), F.min(F.coalesce("vec_id", F.lit(NULL_ID))).alias("low")), "nodes")
    count = nodes.count()
    tables, bits = plan_tables(count, threshold, miss)
    shares = max(1, count // 4096)
    codes = Codes(tables, bits)

    def unit(x: np.ndarray) -> np.ndarray:
        x = x / np.abs(x).max(axis=1, keepdims=True)
        return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]

    def code(frames):
        for frame in frames:
            for dim, part in frame.groupby(frame["v"].map(len)):
                x = np.stack(part["v"].to_numpy()).astype(np.float64)
                got, factor = codes.encode(unit(x))
                yield pd.DataFrame({"node": part["node"], "dim": dim, "raw": [r.tobytes() for r in x],
                                    "copies": part["copies"], "code": [c.tobytes() for c in got], "factor": factor})

    # Codes and correction factors are stored with their vectors, once.
    coded = scratch.save(nodes.mapInPandas(code, "node long, dim int, raw binary, copies long, code binary, factor double"), "coded")

    def deal(frames):
        for frame in frames:
            for lo in range(0, len(frame), 256):
                some = frame.iloc[lo:lo + 256]
                own = codes.cells(np.stack([np.frombuffer(c, np.uint8)[:-(-tables * bits // 8)] for c in some["code"]]))
                yield pd.DataFrame({"dim": np.repeat(some["dim"].to_numpy(), tables), "t": np.tile(np.arange(tables), len(some)),
                                    "cell": own.ravel(), "node": np.repeat(some["node"].to_numpy(), tables),
                                    "code": np.repeat(some["code"].to_numpy(), tables)})

    dealt = coded.select("dim", "node", "code").mapInPandas(deal, "dim int, t int, cell long, node long, code binary")
    sizes = dealt.groupBy("dim", "t", "cell").agg(F.count("*").alias("n")).where("n > 1").withColumn(
        "blocks", F.expr(f"cast(ceil(n / {cell_rows}) as int)"))
    placed = dealt.join(sizes, ["dim", "t", "cell"]).withColumn("b", F.expr("cast(pmod(node, blocks) as int)"))
    placed = placed.withColumn("o", F.explode(F.expr("sequence(0, blocks - 1)"))).selectExpr(
        "dim", "t", "least(b, o) AS b1", "greatest(b, o) AS b2", "b", "node", "code", "cell",
        # small cells share a group, so that a task handles some hundred rows at once
        f"CASE WHEN blocks > 1 THEN cell ELSE pmod(xxhash64(cell), {shares}) - {1 << 40} END AS g")
    group = ["dim", "t", "g", "b1", "b2"]

    def cells_of(frame: pd.DataFrame):
        """Rows of each cell of a group, as both sides of the block pair."""
        cell, b = frame["cell"].to_numpy(), frame["b"].to_numpy()
        b1, b2 = int(frame["b1"].iloc[0]), int(frame["b2"].iloc[0])
        order = np.argsort(cell, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1):
            if b1 != b2:
                yield rows[b[rows] == b1], rows[b[rows] == b2]
            elif len(rows) > 1:
                yield rows, rows

    def filter_codes(frame: pd.DataFrame) -> pd.DataFrame:
        t, dim = int(frame["t"].iloc[0]), int(frame["dim"].iloc[0])
        packed = np.stack([np.frombuffer(c, np.uint8) for c in frame["code"]])
        signs, own = codes.signs(packed, dim), codes.cells(packed[:, :-(-tables * bits // 8)])
        near = [near_codes(signs, own, t, left, right, threshold, sigmas) for left, right in cells_of(frame)]
        return frame.iloc[np.concatenate([np.zeros(0, np.int64), *near])][[*group, "b", "node", "cell"]]

    near = scratch.save(placed.groupBy(*group).applyInPandas(
        filter_codes, "dim int, t int, g long, b1 int, b2 int, b int, node long, cell long"), "near")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        t, dim = int(frame["t"].iloc[0]), int(frame["dim"].iloc[0])
        x = unit(np.stack([np.frombuffer(r, np.float64) for r in frame["raw"]]))
        packed = np.stack([np.frombuffer(c, np.uint8) for c in frame["code"]])
        signs, own = codes.signs(packed, dim), codes.cells(packed[:, :-(-tables * bits // 8)])
        turned, factor = codes.turned(x), frame["factor"].to_numpy()
        links = []
        for left, right in cells_of(frame):
            i, j = linked_pairs(x, turned, signs, factor, own, t, left, right, threshold, sigmas)
            if left is right:
                i, j = i[i < j], j[i < j]
            links.append((i, j))
        i = np.concatenate([k[0] for k in links] or [np.zeros(0, np.int64)])
        j = np.concatenate([k[1] for k in links] or [np.zeros(0, np.int64)])
        copies, node = frame["copies"].to_numpy(), frame["node"].to_numpy()
        linked = np.bincount(i, copies[j], len(x)) + np.bincount(j, copies[i], len(x))
        some = np.flatnonzero(linked)
        edges = forest(len(x), i, j)
        return pd.DataFrame({
            "node": np.concatenate([node[some], node[[e[0] for e in edges]]]).astype(np.int64),
            "other": pd.array([None] * len(some) + node[[e[1] for e in edges]].tolist(), "Int64"),
            "n": np.concatenate([linked[some], np.zeros(len(edges))]).astype(np.int64)})

    fetched = near.join(coded.select("node", "raw", "copies", "code", "factor"), "node")
    found = scratch.save(fetched.groupBy(*group).applyInPandas(compare, "node long, other long, n long"), "found")
    scratch.drop("near", "coded")
    counts = found.where("other IS NULL").groupBy("node").agg(F.sum("n").alias("n"))
    edges = found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b"))
    groups = connected_components(spark, edges, scratch)
    members = nodes.select("node", "low", "copies").join(groups, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    lowest = members.groupBy("component").agg(F.min("low").alias("least"))
    by_node = members.join(lowest, "component").join(counts, "node", "left").select(
        "node", "least", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"))
    out = rows.select("vec_id", "node").join(by_node, "node", "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("vec_id"))
        .otherwise(F.when(F.col("least") != NULL_ID, F.col("least"))).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_embeddings(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
u AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
  AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95),
r AS (SELECT vec_id, vec_id AS c FROM v UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.vec_id),
m AS (SELECT vec_id, min(c) AS component_id FROM r GROUP BY vec_id),
k AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT v.vec_id, coalesce(k.n, 0)::BIGINT AS n_links, m.component_id, v.vec_id = m.component_id AS kept
FROM v JOIN m USING (vec_id) LEFT JOIN k USING (vec_id)
"""
