"""Packing token sequences by non-negative least squares.

Documents are tokenized, closed with an end id, and cut into whole windows and a
remainder. Remainders are packed block by block of some million tokens inside the task
that read them, so no document, length or block total crosses a task:

1. enumerate all combinations of up to three remainder lengths that fill a window
   exactly;
2. solve for non-negative repeat counts x with A x close to the length histogram, where
   column p of A counts the lengths of combination p (block coordinate descent with an
   active set, so x is sparse);
3. round the counts, as far as the histogram allows, and solve again for what is left;
   when that takes no more, short remainders are laid end to end to piles of an
   eighth, then a quarter of a window, and 1 to 3 are done again with the piles' lengths;
4. pack what is left greedily: the longest first, then the longest that fits, and
   a piece cut from the next document where none fits. The rest of a block that
   fills no window becomes sequences whose lengths are powers of two, which need no
   padding.

The ids are those of the byte-level BPE vocabulary whose ranks ``vocabulary`` names; the
string of its special token gets that token's id wherever a text holds it.

Edge cases: null text is empty and packs as its end id alone; very long texts are cut
into many windows; ties of length are taken in any order; equal rows and null doc_ids
are packed each; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.session import lean, ship_package

from .common import id_columns

WINDOW = 2048
END_ID = 1
BLOCK_TOKENS = 4_000_000
SPECIAL = {"<|endoftext|>": 50256}  # as the vocabulary names it
SCHEMA = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, "
          "offset long, sequence_length long, ids binary")

_ENCODERS: dict[str, object] = {}


def encoder(vocabulary: str):
    """The byte-level BPE of a rank file; kept for the life of a worker."""
    if vocabulary not in _ENCODERS:
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[vocabulary] = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
    return _ENCODERS[vocabulary]


def token_ids(bpe, text: str) -> list[int]:
    return bpe.encode(text, allowed_special="all") if any(x in text for x in SPECIAL) else bpe.encode_ordinary(text)


def fill_combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Every row of up to three indexes into ``lengths`` (-1: none) whose lengths sum to
    ``window``, ordered by the first index, that of the longest."""
    place = np.full(window + 1, -1)
    place[lengths] = np.arange(len(lengths))
    rows = []
    for i in range(len(lengths) - 1, -1, -1):
        rest = window - lengths[i]
        if rest > 2 * lengths[i]:
            break
        second = lengths[:i + 1]
        ok = np.flatnonzero((second <= rest) & (2 * second >= rest))
        third = place[rest - second[ok]]
        both = (third >= 0) | (second[ok] == rest)
        rows.append(np.stack([np.full(both.sum(), i), ok[both], third[both]], axis=1))
    return np.concatenate(rows[::-1]).astype(np.int32) if rows else np.zeros((0, 3), np.int32)


def repeat_counts(combos: np.ndarray, histogram: np.ndarray, steps: int = 24) -> np.ndarray:
    """x >= 0 that makes the lengths used by ``combos`` near ``histogram`` in least squares.

    Block coordinate descent with an active set: a step looks at every combination,
    takes for each longest length the one that lowers the squared error most, keeps
    those of them that share no length, and moves each to its minimum. All others
    stay at zero, so the solution is sparse.
    """
    none = len(histogram)
    used = np.where(combos < 0, none, combos)
    rest = np.append(histogram, 0).astype(np.float32)  # histogram - A x
    x = np.zeros(len(combos), np.float32)
    if not len(combos):
        return x
    heads = np.flatnonzero(np.diff(used[:, 0], prepend=-1))
    group = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(used))))
    same, last, pair = used[:, 0] == used[:, 1], used[:, 1] == used[:, 2], used[:, 2] == none
    # Squared length of a column: its lengths' repeats, squared.
    norm = np.select([pair & same, pair, same & last, same | last], [4, 2, 9, 5], 3).astype(np.float32)
    for _ in range(steps):
        slope = rest[used[:, 0]] + rest[used[:, 1]] + rest[used[:, 2]]
        move = np.maximum(slope / norm, -x)
        gain = move * (2 * slope - move * norm)
        best = np.flatnonzero(gain == np.maximum.reduceat(gain, heads)[group])
        best = best[gain[best] > 0.05]  # less moves no count to the next whole one
        if not len(best):
            break
        best = best[np.argsort(-gain[best], kind="stable")]
        rank = np.full(none + 1, len(best))
        np.minimum.at(rank, used[best], np.arange(len(best))[:, None])
        rank[none] = len(best)
        own = np.arange(len(best))[:, None]
        free = ((rank[used[best]] == own) | (used[best] == none)).all(axis=1)
        best = best[free]
        x[best] += move[best]
        np.subtract.at(rest, used[best], move[best][:, None])
        rest[none] = 0
    return x


def _fill_exactly(piles: dict[int, list], window: int, rounds: int) -> list[list]:
    """Solve, round and take, again on what is left, until a round takes little more."""
    out: list[list] = []
    for _ in range(rounds):
        lengths = np.array(sorted(n for n, v in piles.items() if v), np.int64)
        if not len(lengths):
            break
        counts = np.array([len(piles[n]) for n in lengths.tolist()], np.int64)
        combos = fill_combinations(lengths, window)
        x = repeat_counts(combos, counts)
        left, taken = counts.copy(), 0
        for p in np.argsort(-x, kind="stable"):
            # Rounded up from a third: the histogram, not the rounding, sets the limit.
            most = int(x[p] + 2 / 3)
            if not most:
                break
            kinds, times = np.unique(combos[p][combos[p] >= 0], return_counts=True)
            n = min(most, int((left[kinds] // times).min()))
            left[kinds] -= n * times
            for _ in range(n):
                out.append([piles[int(lengths[k])].pop() for k, t in zip(kinds, times, strict=True) for _ in range(t)])
            taken += n
        if taken * 50 < len(out):
            break
    return out


def _glue(piles: dict[int, list], least: int) -> tuple[dict[int, list], bool]:
    """Piles shorter than ``least`` joined, shortest first, to piles of that length or more."""
    out: dict[int, list] = {n: v for n, v in piles.items() if n >= least and v}
    held, size, glued = [], 0, False
    for n in sorted(n for n in piles if n < least):
        for pile in piles[n]:
            glued |= bool(held)
            held, size = held + pile, size + n
            if size >= least:
                out.setdefault(size, []).append(held)
                held, size = [], 0
    if held:
        out.setdefault(size, []).append(held)
    return out, glued


def plan_remainders(remainders: list[int], window: int, rounds: int = 6) -> tuple[list[list[tuple[int, int, int]]], int]:
    """Sequences of (document, from, length) over remainders, and how many of them, the
    first ones, come from the least squares; all are full but for the last ones."""
    piles: dict[int, list] = {}
    for i, n in enumerate(remainders):
        if n:
            piles.setdefault(n, []).append([(i, 0, n)])
    out = _fill_exactly(piles, window, rounds)
    for part in (8, 4):
        piles, glued = _glue(piles, window // part)
        if glued:
            out += _fill_exactly(piles, window, rounds)
    solved = [[x for pile in row for x in pile] for row in out]
    pool: dict[int, list[tuple[int, int]]] = {}
    for v in piles.values():
        for pile in v:
            for i, begin, n in pile:
                pool.setdefault(n, []).append((i, begin))
    return solved + _greedy(pool, window), len(solved)


def _greedy(pool: dict[int, list[tuple[int, int]]], window: int) -> list[list[tuple[int, int, int]]]:
    lengths = sorted(pool)

    def take(at: int) -> tuple[int, int, int]:
        n = lengths[at]
        i, begin = pool[n].pop()
        if not pool[n]:
            del pool[n], lengths[at]
        return i, begin, n

    out = []
    while lengths:
        row, gap = [take(len(lengths) - 1)], 0
        gap = window - row[0][2]
        while gap and lengths:
            at = bisect.bisect_right(lengths, gap) - 1
            if at >= 0:
                row.append(take(at))
                gap -= row[-1][2]
                continue
            i, begin, n = take(0)
            row.append((i, begin, gap))
            left = n - gap
            if left not in pool:
                bisect.insort(lengths, left)
            pool.setdefault(left, []).append((i, begin + gap))
            gap = 0
        out.append(row)
    if out and (total := sum(x[2] for x in out[-1])) < window:
        out += _powers_of_two(out.pop(), total)
    return out


def _powers_of_two(row: list[tuple[int, int, int]], total: int) -> list[list[tuple[int, int, int]]]:
    out = []
    for bit in range(total.bit_length() - 1, -1, -1):
        room = total & (1 << bit)
        cut = []
        while room:
            i, begin, n = row[0]
            k = min(n, room)
            cut.append((i, begin, k))
            row[0] = (i, begin + k, n - k)
            if k == n:
                row.pop(0)
            room -= k
        if cut:
            out.append(cut)
    return out


def pack_block(ids: list[np.ndarray], window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length) that hold every id of a block once."""
    out, remainders, whole = [], [], []
    for i, x in enumerate(ids):
        n = len(x) // window
        whole.append(n * window)
        out += [[(i, k * window, window)] for k in range(n)]
        remainders.append(len(x) % window)
    return out + [[(i, whole[i] + at, n) for i, at, n in row] for row in plan_remainders(remainders, window)[0]]


def pack_tokens(spark: SparkSession, docs: DataFrame, vocabulary: str | None = None,
                window: int = WINDOW, end_id: int = END_ID,
                block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Pieces of token sequences (see module), a row for each piece.

    Columns: doc_id, start and length in the document's ids, doc_tokens (with the end
    id), sequence_id, offset in the sequence, sequence_length (before padding), and ids:
    little-endian unsigned 32-bit.
    """
    ship_package(spark)
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        bpe = encoder(vocabulary)
        sequence = TaskContext.get().partitionId() << 40
        names: list = []
        ids: list[np.ndarray] = []
        held = 0

        def flush():
            nonlocal sequence, held
            rows = []
            for row in pack_block(ids, window):
                at, size = 0, sum(x[2] for x in row)
                for i, start, n in row:
                    rows.append((names[i], start, n, len(ids[i]), sequence, at, size,
                                 ids[i][start:start + n].tobytes()))
                    at += n
                sequence += 1
            names.clear()
            ids.clear()
            held = 0
            got = pd.DataFrame(rows, columns=["doc_id", "start", "length", "doc_tokens",
                                              "sequence_id", "offset", "sequence_length", "ids"])
            got["doc_id"] = pd.array([r[0] for r in rows], "Int64")
            return got

        for frame in frames:
            for doc, no_id, text in zip(frame["doc_id"], frame["no_id"], frame["text"], strict=True):
                got = token_ids(bpe, text)
                got.append(end_id)
                names.append(None if no_id else int(doc))
                ids.append(np.array(got, "<u4"))
                held += len(got)
                if held >= block_tokens:
                    yield flush()
        if ids:
            yield flush()

    return docs.select(*id_columns(),
                       F.coalesce("text", F.lit("")).alias("text")).mapInPandas(lean(pack), SCHEMA)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_tokens(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")
