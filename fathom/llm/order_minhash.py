"""Near-dedup by Order MinHash, verified by banded alignment.

Words are ``[^\\x20\\x09-\\x0D]+``; a document is the sequence of its ``k``-word shingles,
each labelled with its occurrence number so that all are distinct (a text of fewer words
is one shingle). Similarity of two documents: M / (n + m - M), where M is the length
of their longest common subsequence of labelled shingles: the Jaccard similarity that counts
only shingles in the same order, so one that falls with every edit.

1. Equal texts become one node.
2. Each of ``sketches`` hash functions picks the ``sample`` smallest labelled shingles of a
   document and keeps them in text order; their hash is a key. Two documents of Jaccard
   similarity s agree on a key with a chance of about s ** sample.
3. In each group with a key in common, all are paired with the group's head: the node with
   the most company over all its groups, which in a group of copies is their source.
   A group whose members are still in several classes (its members unlike the head) is
   compared whole: its members are dealt to blocks, every pair of blocks is one piece of
   work, and every pair of members of different classes is compared, once over all
   bands. A count of common shingles, never under M, settles most of them. So any two
   documents with a key in common are compared or already in one class.
4. Pairs are verified by alignment in a band: unless |i - j| <= (n + m) (1 - t) / (1 + t)
   for all matched places the similarity is under t, so the band loses nothing. On distinct
   elements the alignment is a longest increasing subsequence.
5. Classes are the connected components of the verified pairs.

Edge cases: null text is empty; texts without words are similar to equal texts only; null
doc_ids come last and take their class's smallest id; equal rows are in one class; very
long texts are sketched whole and aligned in their band; places of
equal hashes are fixed by the text; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.session import lean

from .common import NULL_ID, Scratch, batches, connected_components, id_columns, ids_of, mix, word_table

#: Most members and words of a block, but for a longer text.
BLOCK_NODES, BLOCK_WORDS = 1024, 1 << 20

_RNG = np.random.default_rng(99)
SALTS = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the occurrence-labelled shingles of a word-hash sequence, in order."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    if n < k:
        k = n
    total = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + words[i:n - k + 1 + i])
    order = np.argsort(total, kind="stable")
    ranked = total[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    if not new.all():
        at = np.arange(len(ranked))
        nth = at - np.maximum.accumulate(np.where(new, at, 0))
        total[order] = mix(ranked + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return total


def order_keys(labelled: np.ndarray, sketches: int, sample: int) -> np.ndarray:
    """One key for each hash function: its smallest shingles in text order."""
    n = len(labelled)
    out = np.empty(sketches, np.uint64)
    least = min(sample, n)
    for lo in range(0, sketches, 8):
        salts = SALTS[lo:min(lo + 8, sketches), None]
        h = labelled[None, :] * salts
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        at = np.argpartition(h, least - 1, axis=1)[:, :least] if least < n else np.tile(np.arange(n), (len(h), 1))
        at.sort(axis=1)
        key = np.full(len(h), n if n < sample else 0, np.uint64)
        for j in range(least):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + labelled[at[:, j]])
        out[lo:lo + len(h)] = key
    return out


def similarity(a: np.ndarray, b: np.ndarray, threshold: float) -> float:
    """Ordered Jaccard similarity, by banded alignment; 0 where it is below ``threshold``."""
    n, m = len(a), len(b)
    if not n or not m:
        return 0.0
    # Rounding must not reject a pair exactly at the threshold: the last line alone decides.
    need = threshold / (1 + threshold) * (n + m) - 1e-6
    if min(n, m) < need:
        return 0.0
    order = np.argsort(b)
    ranked = b[order]
    place = np.minimum(np.searchsorted(ranked, a), m - 1)
    i = np.flatnonzero(ranked[place] == a)
    j = order[place[i]]
    near = np.abs(i - j) <= (n + m) * (1 - threshold) / (1 + threshold) + 1e-6
    j = j[near]
    if len(j) < need:
        return 0.0
    if (np.diff(j) > 0).all():
        common = len(j)
    else:
        tails: list[int] = []
        for x in j.tolist():
            at = bisect.bisect_left(tails, x)
            if at == len(tails):
                tails.append(x)
            else:
                tails[at] = x
        common = len(tails)
    got = common / (n + m - common)
    return got if got >= threshold else 0.0


def links_between(seqs: list[np.ndarray], keys: np.ndarray, classes: np.ndarray, right: np.ndarray, band: int,
                  threshold: float) -> list[tuple[int, int]]:
    """Links between rows not marked ``right`` and those marked; among all if none is marked.

    Left out are pairs of one class (with the links found here) and those with an earlier
    key in common, which meet in that key's group.
    """
    order = np.argsort(right, kind="stable")
    seqs, keys, sizes = [seqs[i] for i in order], keys[order], np.array([len(seqs[i]) for i in order])
    label = np.unique(classes[order], return_inverse=True)[1]
    n, split = len(seqs), int(np.count_nonzero(~right))
    one = split == n
    at = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.unique(np.concatenate(seqs), return_inverse=True)[1]
    mine, out = np.zeros(len(ids), np.int32), []
    for x in range(n - 1 if one else split):
        lo = x + 1 if one else split
        need = threshold / (1 + threshold) * (sizes[lo:] + sizes[x]) - 1e-6
        open_ = (label[lo:] != label[x]) & (np.minimum(sizes[lo:], sizes[x]) >= need)
        if band and open_.any():
            open_ &= ~(keys[lo:, :band] == keys[x, :band]).any(axis=1)
        if not open_.any():
            continue
        mine[ids[at[x]:at[x + 1]]] = 1
        some = np.flatnonzero(open_)
        if len(some) * 4 < n - lo:
            common = np.array([mine[ids[at[lo + y]:at[lo + y + 1]]].sum() for y in some])
        else:
            common = np.add.reduceat(mine[ids[at[lo]:]], at[lo:n] - at[lo])[some]
        mine[ids[at[x]:at[x + 1]]] = 0
        for y in (lo + some[common >= need[some]]).tolist():
            if label[y] != label[x] and similarity(seqs[x], seqs[y], threshold):
                out.append((int(order[x]), int(order[y])))
                label[label == label[y]] = label[x]
    return out


def _word_hashes(texts: list[str]) -> list[np.ndarray]:
    raws, out = [t.encode() for t in texts], []
    for lo, hi in batches(raws):
        _, _, _, words, first = word_table(raws[lo:hi])
        out += [words[first[i]:first[i + 1]] for i in range(hi - lo)]
    return out


def near_duplicates(spark: SparkSession, docs: DataFrame, threshold: float = 0.8, k: int = 5,
                    sketches: int = 24, sample: int = 3) -> DataFrame:
    """Classes of near duplicates, a row for each document.

    Returns doc_id, n_words, class_id (the class's smallest doc_id), class_size and kept:
    whether the document is its class's one (of equal rows, one), and text_hash, xxhash64 of
    the text.
    """
    scratch = Scratch(spark, "minhash")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keys, sizes = [], []
            for words in _word_hashes(list(frame["text"])):
                sizes.append(len(words))
                keys.append(order_keys(shingles(words, k), sketches, sample).tobytes() if len(words) else None)
            yield pd.DataFrame({"row": frame["row"], "doc_id": ids_of(frame),
                                "node": frame["node"], "n_words": sizes, "keys": keys})

    named = rows.withColumn("node", F.xxhash64("text"))
    sketched = scratch.save(named.select(F.monotonically_increasing_id().alias("row"), *id_columns(), "node", "text").mapInPandas(
        lean(sketch), "row long, doc_id long, node long, n_words long, keys binary"), "sketches")
    nodes = sketched.groupBy("node").agg(
        F.min(F.coalesce("doc_id", F.lit(NULL_ID))).alias("low"), F.count("*").alias("copies"),
        F.min("keys").alias("keys"), F.max("n_words").alias("n_words"))
    nodes = scratch.save(nodes, "nodes")

    def listed(frames):
        for frame in frames:
            for lo in range(0, len(frame), 1024):
                some = frame.iloc[lo:lo + 1024]
                yield pd.DataFrame({"node": some["node"], "keys": [np.frombuffer(b, np.int64) for b in some["keys"]]})

    keyed = nodes.where("keys IS NOT NULL").select("node", "keys").mapInPandas(listed, "node long, keys array<long>")
    keyed = scratch.save(keyed, "keys")
    single = keyed.select("node", F.posexplode("keys").alias("band", "key"))
    members = scratch.save(_members(single, ["band", "key"]), "members")
    weights = scratch.save(members.groupBy("node").agg(F.sum("n").alias("weight")), "weights")
    groups = scratch.save(_with_heads(members, ["band", "key"], weights), "groups")
    # The texts of nodes in some group, one for each: by the row with the smallest id.
    wanted = weights.select("node")
    chosen = nodes.select("node", "low").join(wanted, "node", "left_semi")
    texts = (named.withColumn("low", F.coalesce("doc_id", F.lit(NULL_ID)))
             .join(chosen, ["node", "low"], "left_semi").select("node", "text"))
    # Rows that share id and text are few; keep one of each without moving texts again.
    texts = scratch.save(texts.withColumn("copy", F.monotonically_increasing_id()), "texts")
    one = texts.groupBy("node").agg(F.min("copy").alias("copy"))
    texts = texts.join(one, ["node", "copy"], "left_semi").select("node", "text")

    def verify(pairs: DataFrame, name: str) -> DataFrame:
        left = texts.select(F.col("node"), F.col("text").alias("a"))
        right = texts.select(F.col("node").alias("head"), F.col("text").alias("b"))
        both = pairs.join(left, "node").join(right, "head")

        def align(frames):
            for frame in frames:
                seqs = {}
                for name, text in (("node", "a"), ("head", "b")):
                    some = frame.drop_duplicates(name)
                    hashes = _word_hashes(list(some[text]))
                    seqs |= {n: shingles(w, k) for n, w in zip(some[name], hashes, strict=True)}
                out = [similarity(seqs[a], seqs[b], threshold)
                       for a, b in zip(frame["node"], frame["head"], strict=True)]
                yield pd.DataFrame({"node": frame["node"], "head": frame["head"], "similar": np.array(out, float)})

        return scratch.save(both.select("node", "head", "a", "b").mapInPandas(
            lean(align), "node long, head long, similar double"), name)

    pairs = groups.select("node", "head").where("node <> head").distinct()
    first = verify(pairs, "first")
    links = scratch.save(first.where("similar > 0").select(F.col("node").alias("a"), F.col("head").alias("b")), "links")
    classes = connected_components(spark, links, scratch)
    # Groups of several classes hold members that no head has settled: all of them are compared.
    blocks = scratch.save(_blocks(groups.select("band", "key", "node").join(classes, "node", "left").withColumn(
        "component", F.coalesce("component", "node")).join(nodes.select("node", "n_words"), "node")), "blocks")

    def compare(frames):
        for frame in _whole(frames, "pair"):
            seqs = [shingles(w, k) for w in _word_hashes(list(frame["text"]))]
            keys = np.stack([np.frombuffer(b, np.uint64) for b in frame["keys"]])
            found = links_between(seqs, keys, frame["component"].to_numpy(), frame["right"].to_numpy(bool), int(frame["band"].iloc[0]), threshold)
            nodes_ = frame["node"].to_numpy()
            yield pd.DataFrame({"a": nodes_[[x for x, _ in found]], "b": nodes_[[y for _, y in found]]}, dtype="int64")

    placed = blocks.join(nodes.select("node", "keys"), "node").join(texts, "node")
    rest = scratch.save(placed.repartition("pair").sortWithinPartitions("pair").mapInPandas(lean(compare), "a long, b long"), "rest")
    known = classes.select(F.col("node").alias("a"), F.col("component").alias("b"))
    classes = connected_components(spark, known.unionAll(rest), Scratch(spark, "minhash_rest"))
    members = nodes.select("node", "low", "copies").join(classes, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    sizes = members.groupBy("component").agg(F.min("low").alias("least"), F.sum("copies").alias("class_size"),
                                             F.min(F.struct("low", "node"))["node"].alias("head"))
    members = members.join(sizes, "component").select("node", "least", "class_size", "head")
    # Equal (doc_id, text) rows: the first written is the class's one.
    heads = (sketched.join(members.where("node = head").select("node", "least"), "node")
             .where(F.coalesce("doc_id", F.lit(NULL_ID)) == F.col("least"))
             .groupBy("node").agg(F.min("row").alias("row")).withColumn("is_head", F.lit(True)))
    return (sketched.join(members, "node").join(heads, ["node", "row"], "left")
            .select("doc_id", "n_words", F.when(F.col("least") != NULL_ID, F.col("least")).alias("class_id"),
                    "class_size", F.coalesce("is_head", F.lit(False)).alias("kept"),
                    F.col("node").alias("text_hash")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, **how) -> DataFrame:
    """``docs`` with one document of each class of :func:`near_duplicates`."""
    kept = near_duplicates(spark, docs, **how).where("kept").select(
        F.col("doc_id").alias("_fathom_id"), F.col("text_hash").alias("_fathom_hash"))
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    joined = docs.withColumn("_fathom_text", text).join(
        kept, F.col("doc_id").eqNullSafe(F.col("_fathom_id")) & (F.col("_fathom_text") == F.col("_fathom_hash")))
    # Equal rows meet the same kept row; one of them stays.
    return joined.dropDuplicates(["_fathom_id", "_fathom_hash"]).select(*docs.columns)


def _members(keyed: DataFrame, by: list[str]) -> DataFrame:
    """Rows of groups of two nodes or more, with the group's size n.

    Written before it is joined again by the same key: each join then stands alone, and
    adaptive execution can split the partition of a hot group.
    """
    sizes = keyed.groupBy(*by).agg(F.count("*").alias("n"), F.min("node").alias("least"), F.max("node").alias("most")).where(
        "least < most").drop("least", "most")
    return keyed.join(sizes, by)


def _with_heads(members: DataFrame, by: list[str], weights: DataFrame) -> DataFrame:
    """Members with their group's head: its heaviest node.

    A node weighs the sizes of all its groups, so the head of a group of copies is the text the
    others were made from rather than any copy.
    """
    heads = members.join(weights, "node").groupBy(*by).agg(F.max(F.struct("weight", "node"))["node"].alias("head"))
    return members.drop("n").join(heads, by)


def _blocks(members: DataFrame) -> DataFrame:
    """Members of groups of several classes, once for each pair of blocks they are in.

    A class too large for a block has blocks of its own, which do not meet each other; the
    others share theirs. Returns pair, band, node, component, right (the pair's second block).
    """
    by = ["band", "key"]
    sizes = members.groupBy(*by, "component").agg(F.count("*").alias("n"), F.sum("n_words").alias("w"))
    sizes = sizes.withColumn("large", F.expr(f"n > {BLOCK_NODES} OR w > {BLOCK_WORDS}")).withColumn(
        "owner", F.expr("if(large, component, 0L)"))
    pools = sizes.groupBy(*by, "large", "owner").agg(F.sum("n").alias("n"), F.sum("w").alias("w"), F.count("*").alias("classes"))
    pools = pools.withColumn("blocks", F.expr(f"cast(greatest(ceil(n / {BLOCK_NODES}), ceil(w / {BLOCK_WORDS})) as int)"))
    pools = pools.groupBy(*by).agg(F.sum("classes").alias("classes"), F.collect_list(F.struct("large", "owner", "blocks")).alias("pools"))
    dealt = members.join(pools.where("classes > 1").drop("classes"), by).join(sizes.drop("n", "w"), [*by, "component"])
    dealt = dealt.withColumn("mine", F.expr("""named_struct('large', large, 'owner', owner, 'block',
        cast(pmod(node, filter(pools, p -> p.large = large AND p.owner = owner)[0].blocks) as int))"""))
    dealt = dealt.withColumn("other", F.explode(F.expr("""flatten(transform(
        filter(pools, p -> NOT (large AND p.large AND p.owner = owner)),
        p -> transform(sequence(0, p.blocks - 1), i -> named_struct('large', p.large, 'owner', p.owner, 'block', i))))""")))
    return dealt.select(F.expr("xxhash64(band, key, least(mine, other), greatest(mine, other))").alias("pair"), "band", "node",
                        "component", F.expr("mine > other").alias("right"))


def _whole(frames: Iterator[pd.DataFrame], by: str) -> Iterator[pd.DataFrame]:
    """Each group of rows sorted by ``by``, in one frame."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        for value, some in frame.groupby(by, sort=False):
            if held and held[0][by].iloc[0] != value:
                yield pd.concat(held, ignore_index=True)
                held = []
            held.append(some)
    if held:
        yield pd.concat(held, ignore_index=True)


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
