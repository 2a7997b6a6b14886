"""Suffix-array dedup by a run-length index over bytes.

One corpus-wide Burrows-Wheeler transform would sort every suffix of the corpus, and
its text could not be spread over machines. Strings that can match are therefore
brought together first, without losing any:

1. Winnowing. The smallest hash of all ``seed_bytes`` strings inside a window of
   ``match_bytes`` bytes depends on that window alone, so two equal windows hold
   equal seeds at equal offsets. Seeds that occur once in the corpus (counted by
   :mod:`.exchange`) rule their windows out.
2. Index. The surroundings of a repeated seed, wide enough for every window around
   it, go to the seed's shard, equal ones of a chunk once with their count. There they
   are aligned at the seed, and a positional Burrows-Wheeler transform is built column
   by column from the right. Inside a run of equal characters the match length
   with the predecessor only grows by one (so it needs no storage); it is sampled at
   run ends alone, as a range minimum over the previous column.
3. Matching statistics. Streaming those lengths along the columns gives, for each
   window start, the longest match with either neighbour, which is the longest with any
   other text; starts with a match of ``match_bytes`` or more are marked.

A seed's surroundings gather in one task, so for seeds that occur more than ``hot_limit``
times (65 536: some 22 MB) the windows are counted exactly by 64-bit hash through the
exchange instead, which spreads by window.

Chunks and shards are sized by bytes; a text longer than a chunk is a chunk of its own,
and one that repeats itself is indexed as its distinct surroundings.

Edge cases: null text is empty; texts under ``match_bytes`` bytes lose nothing; matches
never cross documents; overlapping occurrences count; equal rows lose all that
is long enough, none is the first; null doc_ids pass through; very long texts are read whole;
extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, ids_of, mix, pack, pack_sorted, unpack, unpack_sorted
from .exchange import Exchange, parts_of, split_keys

SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
UNIQUE, REPEATED, HOT = 0, 1, 2


def _string_hashes(text: np.ndarray, length: int) -> np.ndarray:
    """64-bit hash of the ``length`` bytes (a multiple of 8) from each position."""
    n = len(text) - length + 1
    eights = np.ndarray((len(text) - 7,), "<u8", text, 0, (1,))
    total = np.full(n, length, np.uint64)
    for i in range(0, length, 8):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + eights[i:i + n])
    return total


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of each ``width`` adjacent values."""
    span = 1
    while span * 2 <= width:
        x = pick(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return pick(x[:-rest], x[rest:]) if rest else x


def find_seeds(text: np.ndarray, bounds: np.ndarray, seed: int, match: int):
    """Positions and hashes of the seeds of texts laid end to end at ``bounds``."""
    if len(text) < match:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    full = _string_hashes(text, seed)
    short = (full >> np.uint64(32)).astype(np.uint32)
    width = match - seed + 1
    low = _sliding(short, width, np.minimum)
    pad = np.zeros(width - 1, np.uint32)
    chosen = _sliding(np.concatenate([pad, low, pad]), width, np.maximum) == short
    at = np.flatnonzero(chosen)
    which = np.searchsorted(bounds, at, side="right") - 1
    at = at[(at + seed <= bounds[which + 1]) & (bounds[which + 1] - bounds[which] >= match)]
    return at, full[at]


class _Chunk:
    def __init__(self, docs: pd.DataFrame, seed: int, match: int):
        self.raws = [t.encode() for t in docs["text"]]
        self.blob = b"".join(self.raws)
        self.bounds = np.concatenate([[0], np.cumsum([len(r) for r in self.raws], dtype=np.int64)])
        text = np.frombuffer(self.blob, np.uint8)
        found = []
        for lo, hi in batches(self.raws):
            a, b = self.bounds[lo], self.bounds[hi]
            p, h = find_seeds(text[a:b], self.bounds[lo:hi + 1] - a, seed, match)
            found.append((p + a, h))
        self.at = np.concatenate([x[0] for x in found] or [np.zeros(0, np.int64)])
        self.seed = np.concatenate([x[1] for x in found] or [np.zeros(0, np.uint64)])
        which = np.searchsorted(self.bounds, self.at, side="right") - 1
        side = match - seed
        self.left = np.minimum(side, self.at - self.bounds[which])
        self.right = np.minimum(side, self.bounds[which + 1] - self.at - seed)
        self.match = match
        self.seed_bytes = seed

    def kinds(self, bounds, replies: dict, n: int) -> np.ndarray:
        out = np.zeros(n, np.uint8)
        for s, lo, hi in parts_of(bounds):
            out[lo:hi] = np.frombuffer(replies[0, s, 0], np.uint8)
        return out

    def surroundings(self, chosen: np.ndarray, shards: int):
        """Distinct (seed, surroundings) by shard, {shard: {(seed, left, bytes): [place, count]}},
        and for each chosen seed its shard and place (-1: no window fits)."""
        shard = (self.seed[chosen] % np.uint64(shards)).astype(np.int32)
        place = np.full(len(chosen), -1, np.int32)
        out: dict[int, dict] = {}
        for k, i in enumerate(chosen.tolist()):
            p, left = int(self.at[i]), int(self.left[i])
            piece = self.blob[p - left:p + self.seed_bytes + int(self.right[i])]
            if len(piece) < self.match:
                continue
            known = out.setdefault(int(shard[k]), {})
            entry = known.setdefault((int(self.seed[i]), left, piece), [len(known), 0])
            entry[1] += 1
            place[k] = entry[0]
        return out, shard, place

    def windows(self, chosen: np.ndarray):
        """Start and 64-bit hash of every window that holds a chosen seed."""
        # The windows around a seed start at adjacent places.
        first = self.at[chosen] - self.left[chosen]
        last = self.at[chosen] + self.seed_bytes + self.right[chosen] - self.match
        first, last = first[last >= first], last[last >= first]
        starts = np.flatnonzero(covered(len(self.blob), first, last + 1))
        if not len(starts):
            return starts, np.zeros(0, np.uint64)
        text = np.frombuffer(self.blob, np.uint8)
        eights = np.ndarray((len(text) - 7,), "<u8", text, 0, (1,))
        hashes = np.empty(len(starts), np.uint64)
        for lo in range(0, len(starts), 1 << 18):
            part = starts[lo:lo + (1 << 18)]
            total = np.full(len(part), self.match, np.uint64)
            for i in range(0, self.match - 7, 8):
                total = mix(total * np.uint64(0x9E3779B97F4A7C15) + eights[part + i])
            hashes[lo:lo + (1 << 18)] = mix(total + eights[part + self.match - 8])
        return starts, hashes


def covered(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in one of the intervals (ends exclusive)."""
    cover = np.zeros(size + 1, np.int32)
    np.add.at(cover, starts, 1)
    np.add.at(cover, ends, -1)
    return np.cumsum(cover, out=cover)[:-1] > 0


def index_matches(groups: np.ndarray, lefts: np.ndarray, pieces: list[bytes], seed: int,
                  match: int) -> np.ndarray:
    """Run-length positional index of pieces aligned at their seed.

    Returns, for each piece and each start 0 .. match - seed before the seed, whether
    the ``match`` bytes from there also occur, so aligned, in another piece of the group.
    """
    side, m = match - seed, len(pieces)
    width = 2 * side + seed
    grid = np.zeros((width, m), np.uint8)  # 0: outside the text; byte 0 becomes 255, never in UTF-8
    for j, (left, piece) in enumerate(zip(lefts.tolist(), pieces, strict=True)):
        row = np.frombuffer(piece, np.uint8)
        grid[side - left:side - left + len(row), j] = np.where(row == 0, 255, row)
    # The transform of a column is kept as its runs of equal characters. A match with the
    # predecessor grows by one in every column, so it is stored as ``base``: matched length
    # plus the column. Inside a run nothing is written; run ends are sampled.
    order = np.argsort(groups, kind="stable")
    base = np.full(m + 1, width, np.int64)
    out = np.zeros((side + 1, m), bool)
    owner = groups.astype(np.int64) * 256
    for c in range(width - 1, -1, -1):
        key = owner[order] + grid[c, order]
        heads = np.flatnonzero(np.diff(key, prepend=-1))
        sizes = np.diff(np.append(heads, m))
        by_key = np.argsort(key[heads], kind="stable")  # runs, not texts, are sorted
        if len(by_key) > 1:
            # A run whose key continues the run placed before it matches it as far as the
            # least of the matches in between; any other run starts a new character.
            went, came = heads[by_key], heads[by_key] + sizes[by_key] - 1
            same = np.concatenate([[False], key[went[1:]] == key[went[:-1]]])
            value = np.full(len(by_key), c, np.int64)
            again = np.flatnonzero(same)
            if len(again):
                spans = np.empty(2 * len(again), np.int64)
                spans[::2], spans[1::2] = came[again - 1] + 1, went[again] + 1
                base[m] = 2 * width
                value[again] = np.minimum.reduceat(base, spans)[::2]
            base[went] = value
            ends = np.cumsum(sizes[by_key])
            moved = np.arange(m) + np.repeat(went - (ends - sizes[by_key]), sizes[by_key])
            order, base[:m] = order[moved], base[:m][moved]
        elif m:
            base[0] = c
        if c <= side:
            long = np.append(base[:m] - c >= match, False)
            out[side - c, order] = long[:-1] | long[1:]
    return out.T


def remove_repeated_bytes(spark: SparkSession, docs: DataFrame, match_bytes: int = 200,
                          seed_bytes: int = 64, hot_limit: int = 1 << 16) -> DataFrame:
    """Each document without the bytes covered by a string of ``match_bytes`` bytes
    that also starts anywhere else (see module).

    Returns doc_id, n_bytes, n_removed, n_spans and kept: the remaining bytes.
    """
    ex = Exchange(spark, docs, "suffix")
    shards, side = ex.shards, match_bytes - seed_bytes

    def send_seeds(docs, replies):
        c = _Chunk(docs, seed_bytes, match_bytes)
        keys, _, counts, bounds = split_keys(c.seed, shards)
        for s, lo, hi in parts_of(bounds):
            yield s, 0, pack_sorted(keys[lo:hi]), pack(counts[lo:hi].astype(np.uint32))

    def count_seeds(_, bodies, extras):
        keys = [unpack_sorted(b, np.uint64) for b in bodies]
        _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.concatenate([unpack(x)[0] for x in extras])
        total = np.bincount(inverse, counts)[inverse]
        kind = (total > 1).astype(np.uint8) + (total > hot_limit)
        at = 0
        for k in keys:
            yield kind[at:at + len(k)].astype(np.uint8).tobytes()
            at += len(k)

    def chosen(c, replies):
        keys, inverse, _, bounds = split_keys(c.seed, shards)
        kind = c.kinds(bounds, replies, len(keys))[inverse]
        return np.flatnonzero(kind == REPEATED), np.flatnonzero(kind == HOT)

    def send_texts(docs, replies):
        c = _Chunk(docs, seed_bytes, match_bytes)
        repeated, hot = chosen(c, replies)
        for s, known in c.surroundings(repeated, shards)[0].items():
            yield (s, 1, pack(np.array([k[0] for k in known], np.uint64),
                              np.array([k[1] for k in known], np.int32),
                              np.array([len(k[2]) for k in known], np.int32),
                              b"".join(k[2] for k in known)),
                   pack(np.array([v[1] for v in known.values()], np.int64)))
        _, window = c.windows(hot)
        keys, _, counts, bounds = split_keys(window, shards)
        for s, lo, hi in parts_of(bounds):
            yield s, 2, pack_sorted(keys[lo:hi]), pack(np.packbits(counts[lo:hi] > 1))

    def match_texts(kind, bodies, extras):
        if kind == 2:
            keys = [unpack_sorted(b, np.uint64) for b in bodies]
            _, inverse, counts = np.unique(np.concatenate(keys), return_inverse=True,
                                           return_counts=True)
            again, at = (counts > 1)[inverse], 0
            for k, x in zip(keys, extras, strict=True):
                got = again[at:at + len(k)] | np.unpackbits(unpack(x)[0], count=len(k)).astype(bool)
                yield np.packbits(got).tobytes()
                at += len(k)
            return
        known: dict[tuple, int] = {}
        totals: list[int] = []
        sent = []
        for b, x in zip(bodies, extras, strict=True):
            seeds, lefts, sizes, blob = unpack(b)
            ends = np.cumsum(sizes).tolist()
            mine = []
            for sd, lf, e, n, k in zip(seeds.tolist(), lefts.tolist(), ends, sizes.tolist(),
                                       unpack(x)[0].tolist(), strict=True):
                j = known.setdefault((sd, lf, blob[e - n:e]), len(known))
                if j == len(totals):
                    totals.append(0)
                totals[j] += k
                mine.append(j)
            sent.append(mine)
        _, group, members = np.unique(np.array([k[0] for k in known], np.uint64),
                                      return_inverse=True, return_counts=True)
        marks = np.zeros((len(known), side + 1), bool)
        several = np.flatnonzero(members[group] > 1)
        if len(several):
            names = list(known)
            marks[several] = index_matches(
                group[several].astype(np.int64), np.array([names[j][1] for j in several], np.int64),
                [names[j][2] for j in several], seed_bytes, match_bytes)
        marks[np.array(totals) > 1] = True
        for mine in sent:
            yield pack(np.packbits(marks[mine], axis=1))

    ex.round(send_seeds, count_seeds)
    ex.round(send_texts, match_texts)

    def cut(docs, replies):
        c = _Chunk(docs, seed_bytes, match_bytes)
        repeated, hot = chosen(c, replies)
        starts = np.zeros(len(c.blob) + 1, bool)
        known, shard, place = c.surroundings(repeated, shards)
        for s in known:
            marks = unpack(replies[1, s, 1])[0]
            mine = np.flatnonzero((shard == s) & (place >= 0))
            for lo in range(0, len(mine), 1 << 15):  # a row of marks is 137 places wide
                part = mine[lo:lo + (1 << 15)]
                i, j = np.nonzero(np.unpackbits(marks[place[part]], axis=1, count=side + 1))
                at = repeated[part[i]]
                ok = (j <= c.left[at]) & (side - j <= c.right[at])
                starts[(c.at[at] - j)[ok]] = True
        del known
        begin, window = c.windows(hot)
        keys, inverse, _, bounds = split_keys(window, shards)
        again = np.zeros(len(keys), bool)
        for s, lo, hi in parts_of(bounds):
            again[lo:hi] = np.unpackbits(np.frombuffer(replies[1, s, 2], np.uint8), count=hi - lo).astype(bool)
        starts[begin[again[inverse]]] = True
        starts = np.flatnonzero(starts)
        gone = covered(len(c.blob), starts, starts + match_bytes)
        text = np.frombuffer(c.blob, np.uint8)
        out = []
        for i in range(len(c.raws)):
            lo, hi = c.bounds[i], c.bounds[i + 1]
            lost = gone[lo:hi]
            n = int(lost.sum())
            spans = int(np.count_nonzero(np.diff(lost.astype(np.int8), prepend=0) == 1))
            out.append((hi - lo, n, spans, text[lo:hi][~lost].tobytes() if n else c.raws[i]))
        got = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"])
        got.insert(0, "doc_id", ids_of(docs))
        return got

    return ex.finish(cut, SCHEMA)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = remove_repeated_bytes(spark, docs)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans",
                      F.sha2("kept", 256).alias("kept_sha256"))
