"""Mixing, quality, embeddings, fingerprints, personal data, packing, the pipeline."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from fathom.llm import embedding_dedup, lz_fingerprint, mixing, packing, pii, quality, registry
from tests.conftest import DATA, oracle_rows, rows_of
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_its_sql(spark, duck, name):
    assert rows_of(registry.QUERIES[name](spark, f"{DATA}/sf0.001")) == oracle_rows(duck, registry.ORACLE_SQL[name])


# ---------------------------------------------------------------- mixing
def water_fill(sizes: dict) -> dict:
    """Targets by literal resharing."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    rest, open_ = 1.5 * sum(sizes.values()), set(order)
    while rest > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        give = rest
        rest = 0.0
        for s in sorted(open_, key=str):
            target[s] += give * weight[s] / total
            if target[s] >= 2 * sizes[s]:
                rest += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
        open_ = {s for s in open_ if target[s] < 2 * sizes[s]}
    return target


def test_mixing_comes_to_its_targets(spark):
    rows = cases.documents()
    docs = cases.with_clashes(cases.frame(spark, rows))
    placed = mixing.place_documents(docs)
    goals = mixing.targets(placed)
    mix = mixing.mix_sources(placed, goals, block_words=16)
    size = [(r[3], len(WORD.findall(r[1] or ""))) for r in rows]
    sizes: dict = {}
    for s, n in size:
        sizes[s] = sizes.get(s, 0) + n
    want = water_fill(sizes)
    got = {r.src: r for r in goals.collect()}
    assert {k: round(r.target, 6) for k, r in got.items()} == {"-" if s is None else "+" + s: round(t, 6) for s, t in want.items()}
    taken = {r.src: r.n for r in mix.groupBy("src").agg(F.sum("words").alias("n")).collect()}
    places = sum(r.target for r in got.values()) / 16
    for k, r in got.items():  # a multinomial draw, cut at twice the source
        assert taken.get(k, 0) <= 2 * r.source_size
        assert abs(taken.get(k, 0) - r.target) <= 16 * (4.5 * (r.target / 16 * (1 - r.target / 16 / places)) ** 0.5 + 1)
    most = mix.groupBy("src", "start").agg(F.sum("words").alias("n")).join(placed.where("size > 0"), ["src", "start"]).where("n > 2 * size")
    assert most.count() == 0
    assert rows_of(mix) == rows_of(mixing.mix_sources(placed, goals, block_words=16))


def test_shards_hold_multinomial_counts(spark):
    goals = spark.createDataFrame([("+a", 400_000, 1, 600_000.0), ("+b", 300_000, 2, 240_000.0), ("-", 100_000, 3, 160_000.0)],
                                  "src string, source_size long, rank long, target double")
    drawn = mixing.draws(goals, 10, 100, 5).cache()
    shards = 1000
    for src, p, blocks in (("+a", 0.6, 40_000), ("+b", 0.24, 30_000), ("-", 0.16, 10_000)):
        rows = drawn.where(F.col("src") == src)
        got = {r.shard: r.draws for r in mixing.shard_counts(rows).collect()}
        counts = np.array([got.get(i, 0) for i in range(shards)])
        assert abs(counts.mean() - 100 * p) < 4 * (100 * p * (1 - p) / shards) ** 0.5
        assert 0.85 < counts.var() / (100 * p * (1 - p)) < 1.15
        assert abs(np.corrcoef(counts[:-1], counts[1:])[0, 1]) < 0.13
        # Shards take consecutive slots, and every slot is a block of its own pass.
        slots = [(r["pass"], r.block, r.slot) for r in rows.orderBy("slot").collect()]
        assert [x[2] for x in slots] == list(range(len(slots))) and len({x[:2] for x in slots}) == len(slots)
        assert all(x[0] == x[2] // blocks and 0 <= x[1] < blocks for x in slots)
        by_shard = [r.shard for r in rows.orderBy("slot").collect()]
        assert by_shard == sorted(by_shard)
    other = mixing.shard_counts(mixing.draws(goals, 10, 100, 6)).where("src = '+a' AND shard < 50")
    mine = mixing.shard_counts(drawn).where("src = '+a' AND shard < 50")
    assert rows_of(other) != rows_of(mine) and rows_of(mine) == rows_of(mixing.shard_counts(mixing.draws(goals, 10, 100, 5)).where("src = '+a' AND shard < 50"))


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_permutations_are_permutations(spark, n):
    got = spark.range(n).select(F.expr(mixing._permuted("id", f"cast({n} as bigint)", "cast(77 as bigint)")).alias("x")).collect()
    assert sorted(r.x for r in got) == list(range(n))
    if n == 1000:
        assert sum(r.x == i for i, r in enumerate(got)) < 20


def test_mixed_documents_hold_what_the_mix_takes(spark):
    rows = cases.documents()
    out = mixing.mixed_documents(cases.frame(spark, rows), block_words=16)
    placed = mixing.place_documents(cases.frame(spark, rows))
    words = mixing.mix_sources(placed, mixing.targets(placed), 16).agg(F.sum("words").alias("n")).first()["n"]
    got = out.collect()
    assert sum(len(WORD.findall(r.text)) for r in got) == words
    whole = {(r[0], " ".join(WORD.findall(r[1] or ""))) for r in rows}
    for r in got:
        assert any(d == r.doc_id and all(w in t for w in WORD.findall(r.text)) for d, t in whole)
        assert r.n_chars == len(r.text)


def test_mixing_is_native(spark):
    placed = mixing.place_documents(cases.frame(spark))
    plan = mixing.mix_sources(placed, mixing.targets(placed))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|ArrowEval|Cartesian", plan)


# ---------------------------------------------------------------- quality
def test_quality_learns_and_is_calibrated(spark, duck):
    out = quality.score_quality(spark, spark.read.parquet(f"{DATA}/sf0.1/documents.parquet"), spark.read.parquet(f"{DATA}/sf0.1/labels.parquet"))
    labels = spark.read.parquet(f"{DATA}/sf0.1/labels.parquet")
    rows = out.join(labels, "doc_id").collect()
    assert {r.held_out for r in rows} == {True, False}
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.predicted == r.quality for r in held]) > 0.97
    assert np.mean([(r.score - r.quality) ** 2 for r in held]) < 0.03
    assert np.mean([r.predicted for r in held if r.quality == 1]) > 0.98


def test_quality_ignores_labels_that_are_held_out(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/sf0.001/labels.parquet")
    changed = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert rows_of(quality.score_quality(spark, docs, labels)) == rows_of(quality.score_quality(spark, docs, changed))


def test_quality_edges(spark):
    docs = cases.with_clashes(cases.frame(spark))
    labels = spark.createDataFrame([(-5, 1, 0), (-2, 0, 1), (1, None, 0), (None, 1, 0), (4, 0, 0), (7, 1, 0), (10, 1, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.score_quality(spark, docs, labels).collect()
    assert len(rows) == len(cases.documents()) and all(0 <= r.score <= 1 for r in rows)
    by_text: dict = {}
    pairs = docs.select("doc_id", "text").distinct().collect()
    for p in pairs:
        by_text.setdefault(p.text or "", set()).update(round(r.score, 12) for r in rows if r.doc_id == p.doc_id)
    assert all(len(s) == 1 for s in by_text.values())
    none = quality.score_quality(spark, docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.score_quality(spark, cases.empty(spark), labels).count() == 0


def test_pooling_of_a_long_text():
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((quality.VOCABULARY, quality.DIM)).astype(np.float32)
    raw = " ".join(f"w{x}" for x in rng.integers(0, 5000, 150_000)).encode()
    got = quality.pooled([b"short one", raw, b"other"], vectors)[1]
    v = vectors[quality.tokens([raw])[0]].astype(np.float64)
    assert np.allclose(got[:quality.DIM], v.mean(axis=0), atol=1e-5) and np.allclose(got[quality.DIM:2 * quality.DIM], v.std(axis=0), atol=1e-5)
    assert np.isclose(got[2 * quality.DIM], (v[1:] * v[:-1]).sum() / (len(v) - 1), atol=1e-5)


def test_pooling_does_not_depend_on_batches():
    rng = random.Random(5)
    raws = [cases.prose(rng, rng.randint(0, 300)).encode() for _ in range(50)] + [b"", b" "]
    vectors = np.random.default_rng(0).standard_normal((quality.VOCABULARY, quality.DIM)).astype(np.float32)
    assert np.array_equal(quality.pooled(raws, vectors)[13:14], quality.pooled(raws[13:14], vectors))


# ---------------------------------------------------------------- embeddings
def brute_links(rows, threshold=0.95):
    ok = [i for i, (_, v) in enumerate(rows) if v and all(e is not None and np.isfinite(e) for e in v) and any(v)]
    n, root = dict.fromkeys(range(len(rows)), 0), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ok:
        for b in ok:
            x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
            if a < b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                n[a] += 1
                n[b] += 1
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    low: dict = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), 1 << 63), 1 << 62 if d is None else d)
    return sorted(((d, n[i], None if low[find(i)] == 1 << 62 else low[find(i)]) for i, (d, _) in enumerate(rows)), key=repr)


def vectors(seed=0, n=60, dim=16):
    rng = np.random.default_rng(seed)
    rows: list = []
    for i in range(n):
        v = rng.standard_normal(dim)
        for _ in range(rng.integers(1, 4)):
            rows.append((len(rows), [float(np.float32(e)) for e in v + rng.standard_normal(dim) * rng.choice([0, 0.05, 0.2, 0.3])]))
    rows += [(1000, None), (1001, [0.0] * dim), (1002, [None, *[1.0] * (dim - 1)]), (1003, [float("nan")] * dim), (1004, [float("inf")] * dim), (1005, [0.0] * dim),
             (1006, []), (None, rows[3][1]), (1007, rows[3][1]), (1007, rows[3][1]), (1008, [2 * e for e in rows[3][1]]), (1009, [1.0, 2.0]), (1010, [1.0, 2.0]), (1011, [-0.0, 1.0]), (1012, [0.0, 1.0])]
    return rows


@pytest.mark.parametrize("cell_rows", [2048, 8])
def test_links_against_brute_force(spark, cell_rows):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").select("*", *[F.lit(1).alias(c) for c in ("node", "v", "cell", "t", "b", "label", "copies")])
    out = embedding_dedup.link_embeddings(spark, df, cell_rows=cell_rows)
    assert cases.as_set(out, "vec_id", "n_links", "component_id") == cases.as_set(spark.createDataFrame(brute_links(rows), "a long, b long, c long"), "a", "b", "c")
    assert all(r.kept == (r.vec_id == r.component_id) for r in out.collect())


def test_no_embeddings(spark):
    assert embedding_dedup.link_embeddings(spark, spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    lone = embedding_dedup.link_embeddings(spark, spark.createDataFrame([(5, None), (6, [0.0])], "vec_id long, embedding array<float>"))
    assert cases.as_set(lone, "vec_id", "n_links", "component_id", "kept") == [(5.0, 0.0, 5.0, True), (6.0, 0.0, 6.0, True)]


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    codes = embedding_dedup.Codes(20, 9)
    turned = codes.turned(x)
    packed, factor = codes.encode(x)
    m = codes.width(64)
    code = codes.signs(packed, 64) / np.sqrt(m)
    assert m == 192 and np.allclose(factor, np.einsum("ij,ij->i", turned, code))
    estimate, true = code / factor[:, None] @ turned.T, x @ x.T
    assert np.allclose(turned @ turned.T, true)
    error = (estimate - true)[~np.eye(400, dtype=bool)]
    spread = (np.sqrt(1 - factor**2) / factor / np.sqrt(m - 1))[:, None]
    assert abs(error.mean()) < 0.005
    assert (np.abs(estimate - true) <= 5 * spread + 1e-9).mean() > 0.99999


def test_few_pairs_at_the_threshold_are_filtered_out():
    rng = np.random.default_rng(3)
    tables, bits = embedding_dedup.plan_tables(50_000, 0.95, 1e-6)
    codes = embedding_dedup.Codes(tables, bits)
    lost = met = 0
    for _ in range(20):
        a, o = rng.standard_normal((2, 200, 64))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        o -= (o * a).sum(axis=1, keepdims=True) * a
        o /= np.linalg.norm(o, axis=1, keepdims=True)
        b = 0.9501 * a + np.sqrt(1 - 0.9501**2) * o
        ca, cb = codes.encode(a)[0], codes.encode(b)[0]
        share = codes.cells(ca) == codes.cells(cb)
        met += int(share.any(axis=1).sum())
        sa, sb = codes.signs(ca, 64), codes.signs(cb, 64)
        for i in np.flatnonzero(share.any(axis=1)):
            both = np.stack([sa[i], sb[i]])
            lost += not len(embedding_dedup.near_codes(both, np.zeros((2, 1), np.int64), 0, np.array([0, 1]), np.array([0, 1]), 0.95, 5.0))
    assert met >= 3999 and lost == 0  # of 4000 pairs at 0.9501


# ---------------------------------------------------------------- fingerprints
def brute_phrases(text: str) -> set[str]:
    seen: set[str] = set()
    start = 0
    for end in range(1, len(text) + 1):
        if text[start:end] not in seen:
            seen.add(text[start:end])
            start = end
    return seen


def brute_fingerprint(text: str) -> str:
    hashes = [lz_fingerprint.phrase_hashes(p, [len(p)]) for p in brute_phrases(text)]
    return lz_fingerprint.as_text(np.unique(np.concatenate([np.zeros(0, np.uint32), *hashes]))[:lz_fingerprint.SIZE])


def brute_likeness(a: str, b: str) -> float:
    x, y = ({s[i:i + 8] for i in range(0, len(s), 8)} for s in (a, b))
    union = sorted(x | y)[:lz_fingerprint.SIZE]
    return sum(u in x and u in y for u in union) / len(union) if union else 1.0


def test_fingerprints_against_brute_force(spark):
    rows = [r for i, r in enumerate(cases.documents()) if r[0] not in {q[0] for q in cases.documents()[:i]}]
    out = lz_fingerprint.fingerprint_documents(spark, cases.with_clashes(cases.frame(spark, rows)))
    order = sorted(rows, key=lambda r: -(1 << 62) if r[0] is None else r[0], reverse=True)
    want = []
    for i, r in enumerate(order):
        text, nxt = r[1] or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[:len(text) - cut] + nxt[:cut]
        a, b, c = brute_fingerprint(text), brute_fingerprint(edited), brute_fingerprint(nxt)
        want.append((r[0], len(text), edited, a, b, round(brute_likeness(a, b), 6), round(brute_likeness(a, c), 6)))
    got = [(r.doc_id, r.n_chars, r.edited, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 6), round(r.near_next, 6)) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_fingerprint_edges(spark):
    assert lz_fingerprint.fingerprint_documents(spark, cases.empty(spark)).count() == 0
    lone = lz_fingerprint.fingerprint_documents(spark, cases.frame(spark, [(7, "abcabc", None, None, 6)])).collect()
    assert [(r.edited, r.near_next) for r in lone] == [("abcaab", 1.0)]
    same = lz_fingerprint.fingerprint_documents(spark, cases.frame(spark, [(7, "abc", None, None, 3)] * 4)).collect()
    assert len(same) == 4 and len({r.fingerprint for r in same}) == 1


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abü😀", max_size=60), st.text(alphabet="abc", max_size=30))
def test_parsing_on_equals_parsing_anew(text, other):
    got = lz_fingerprint._Parsed(1, text).row(lz_fingerprint._Parsed(2, other))
    assert got[3] == brute_fingerprint(text) and got[4] == brute_fingerprint(got[2])


# ---------------------------------------------------------------- personal data
BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def literal_spans(text: str) -> list[tuple[int, int, int]]:
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "phone" and not 9 <= len(digits) <= 15 or kind == "card" and not (
                    12 <= len(digits) <= 19 and pii.passes_luhn(digits)):
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a1@.-+ 0_%9(", max_size=40) | st.lists(st.sampled_from(
    ["a@b.c", "x@", "@y.z", "1.2.3.4", "300.1.1.1", "+1 (234) 555-1234", "4111111111111111", "4111 1111-1111 1111", ".", "@", " ", "0", "9", "_", "-", "é"]), max_size=12).map("".join))
def test_base_spans_are_the_patterns(text):
    assert pii.base_spans(text) == literal_spans(text)


def test_luhn():
    assert pii.passes_luhn("4111111111111111") and not pii.passes_luhn("4111111111111112")


def test_personal_data_edges(spark):
    rows = [*cases.documents(), (900, "mail a.b@c.org or +1 (212) 555-0100 x 4111111111111111 at 10.0.0.1", "en", "s", 0), (901, "call (212) 555-0100 now", "en", "s", 0),
            (902, "key 9f86d081884c7d659a2feaa0c55ad015a3bf4f1b2b0b822c", "en", "s", 0)]
    out = {r.doc_id: r for r in pii.find_pii(spark, cases.with_clashes(cases.frame(spark, rows))).collect()}
    assert [(k, s, e) for k, s, e, a in zip(out[900].kinds, out[900].starts, out[900].ends, out[900].added, strict=True) if not a] == [
        (pii.KINDS[k], s, e) for s, k, e in literal_spans(rows[-3][1])]
    assert not out[902].kinds and not out[-5].kinds
    assert pii.find_pii(spark, cases.empty(spark)).count() == 0


def test_long_octets_are_judged_by_value():
    for ip, ok in (("0000000999.1.1.1", False), ("00000000255.001.1.0", True), ("256.1.1.1", False), ("0000000000000.0.0.0", True), ("1.2.3.99999999999", False)):
        assert bool(pii.base_spans(f"at {ip} end")) == ok == bool(literal_spans(f"at {ip} end")), ip


def test_decoding_against_all_tag_sequences():
    import itertools

    tagger = pii.Tagger(embed=3, hidden=3, seed=2)
    rng = np.random.default_rng(4)
    tagger.p["trans"] = rng.standard_normal((pii.TAGS, pii.TAGS))
    ids = rng.integers(0, pii.ALPHABET, (6, 4))
    e, _ = tagger.emissions(ids)
    every = np.array(list(itertools.product(range(pii.TAGS), repeat=4)))
    for row, tags in zip(e, tagger.decode(ids), strict=True):
        score = sum(row[i, every[:, i]] for i in range(4)) + sum(tagger.p["trans"][every[:, i], every[:, i + 1]] for i in range(3))
        assert tuple(every[score.argmax()]) == tuple(tags)


class _Marks:
    """A tagger that knows the true tags: capitals and at signs are one card number."""

    def decode(self, ids):
        inside = (ids >= ord("A") - 32) & (ids <= ord("Z") - 32) | (ids == ord("@") - 32)
        begins = inside & ~np.concatenate([np.zeros((len(ids), 1), bool), inside[:, :-1]], axis=1)
        return np.where(begins, 5, np.where(inside, 6, 0))


@pytest.mark.parametrize("size", [5, 32, 50, 64, 80, 94, 95, 130, 400])
def test_spans_of_any_length_are_found_at_every_offset(size):
    span = "".join("@" if i % 20 == 3 else "A" for i in range(size))  # windows need a trigger
    for offset in range(70):
        text = "x" * offset + span + "y" * 200
        assert pii.reconciled_spans([text], _Marks())[0] == [(offset, 2, offset + size)], offset


def test_gradients_are_right():
    tagger = pii.Tagger(embed=4, hidden=3)
    rng = np.random.default_rng(0)
    ids, tags = rng.integers(0, pii.ALPHABET, (2, 6)), rng.integers(0, pii.TAGS, (2, 6))
    _, grads = tagger.loss_and_gradients(ids, tags)
    for name, value in tagger.p.items():
        flat = value.reshape(-1)
        for at in rng.integers(0, len(flat), 6):
            if name == "emb" and grads[name].reshape(-1)[at] == 0:
                continue
            old = flat[at]
            flat[at] = old + 1e-5
            up, _ = tagger.loss_and_gradients(ids, tags)
            flat[at] = old - 1e-5
            down, _ = tagger.loss_and_gradients(ids, tags)
            flat[at] = old
            assert abs((up - down) / 2e-5 - grads[name].reshape(-1)[at]) < 1e-5, name


def test_network_finds_variants_it_has_not_seen():
    rng = np.random.default_rng(77)
    words = ["thion", "and", "reand", "of", "inere"]
    tagger = pii.Tagger().fit(*pii.training_windows(["plain words and 12 more", "mail x.1@mail3.example.com here"]))
    found = clean = 0
    for _ in range(60):
        left = " ".join(rng.choice(words, 6))
        number = f"({pii._digits(rng, 3)}) {pii._digits(rng, 3)}-{pii._digits(rng, 4)}"
        text = f"{left} {number} {left}"
        got = pii.added_spans(text, pii.base_spans(text), pii.reconciled_spans([text], tagger)[0])
        found += any(k == 3 and s <= len(left) + 2 and e >= len(left) + len(number) for s, k, e in got)
        hexes = hashlib.sha256(left.encode()).hexdigest()[:32]
        clean += not pii.added_spans(f"{left} {hexes}", [], pii.reconciled_spans([f"{left} {hexes}"], tagger)[0])
    assert found >= 54 and clean >= 57


# ---------------------------------------------------------------- packing
def check_packing(rows, ids, window=2048):
    by_doc: dict = {}
    by_sequence: dict = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc, pieces in by_doc.items():
        assert sorted(x for p in pieces for x in range(p.start, p.start + p.length)) == sorted(list(range(len(ids[doc]))) * (len(pieces) and sum(p.length for p in pieces) // len(ids[doc])))
        for p in pieces:
            assert p.doc_tokens == len(ids[doc]) and bytes(p.ids) == ids[doc][p.start:p.start + p.length].tobytes()
    pad = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window and all(p.sequence_length == at for p in pieces)
        pad += 0 if at & (at - 1) == 0 else window - at
    return pad


def test_packing_is_a_round_trip(spark):
    rows = [r for i, r in enumerate(cases.documents()) if r[0] not in {q[0] for q in cases.documents()[:i]}]
    rows.append((500, "<|endoftext|> named <|endoftext|>", "en", "s", 0))
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r[0]: np.array([*t.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4") for r in rows}
    out = packing.pack_tokens(spark, cases.with_clashes(cases.frame(spark, rows)))
    assert check_packing(out.collect(), ids) == 0
    assert packing.pack_tokens(spark, cases.empty(spark)).count() == 0


def test_ids_are_the_tokenizers(spark):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [r.text for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").collect()]
    texts += ["", " ", "\n\n  x", "don't we'LL 12345 ½²", "<|endoftext|>", "a  <|endoftext|>  b\n<|endoftext|><|endof", "日本語 كتاب 😀‍🔥", "a" * 3000, "\x00\x01", "x　y\xa0z", "\r\n\t"]
    bpe = packing.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for text in texts:
        assert packing.token_ids(bpe, text) == t.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 200), max_size=60))
def test_blocks_are_packed_without_loss(lengths):
    ids = [np.arange(n, dtype=np.uint32) for n in lengths]
    seen: set = set()
    sequences = packing.pack_block(ids, 32)
    for row in sequences:
        for i, start, n in row:
            for x in range(start, start + n):
                assert (i, x) not in seen
                seen.add((i, x))
    assert len(seen) == sum(lengths)
    sizes = [sum(x[2] for x in row) for row in sequences]
    assert all(s == 32 or s & (s - 1) == 0 for s in sizes)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(1, 40), max_size=14), st.integers(2, 40))
def test_combinations_are_all_that_fill(lengths, window):
    import itertools

    lengths = sorted(n for n in lengths if n <= window)
    want = {c for k in (1, 2, 3) for c in itertools.combinations_with_replacement(lengths[::-1], k) if sum(c) == window and (k > 1)}
    got = [tuple(lengths[k] for k in c if k >= 0) for c in packing.fill_combinations(np.array(lengths, np.int64), window).tolist()]
    assert sorted(c for c in got if len(c) > 1) == sorted(want) and len(set(got)) == len(got)


def test_least_squares_finds_exact_counts():
    lengths, counts = np.array([8, 12, 20, 24]), np.array([30, 20, 10, 30])
    combos = packing.fill_combinations(lengths, 32)
    x = packing.repeat_counts(combos, counts, 500)
    got = np.zeros(4)
    for c, n in zip(combos, x, strict=True):
        for k in c:
            if k >= 0:
                got[k] += n
    # The same least squared error as by projected gradients over all combinations.
    a = np.zeros((4, len(combos)))
    for p, c in enumerate(combos):
        for k in c[c >= 0]:
            a[k, p] += 1
    y = np.zeros(len(combos))
    for _ in range(20000):
        y = np.maximum(0, y - 0.02 * a.T @ (a @ y - counts))
    assert (x >= 0).all() and abs(((got - counts) ** 2).sum() - ((a @ y - counts) ** 2).sum()) < 0.5


def test_most_sequences_come_from_least_squares():
    bpe = packing.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    import duckdb

    texts = [r[0] or "" for r in duckdb.sql(f"SELECT text FROM '{DATA}/sf0.1/documents.parquet' ORDER BY doc_id LIMIT 4000").fetchall()]
    sequences, solved = packing.plan_remainders([(len(packing.token_ids(bpe, t)) + 1) % 2048 for t in texts], 2048)
    assert solved > 0.8 * len(sequences)
    assert all(sum(x[2] for x in row) == 2048 for row in sequences[:solved])


# ---------------------------------------------------------------- pipeline
@pytest.fixture(scope="module")
def labelled(tmp_path_factory, spark):
    folder = str(tmp_path_factory.mktemp("labels"))
    spark.createDataFrame([(-5, 1, 0), (4, 1, 0), (7, 1, 0), (10, 1, 0), (13, 1, 0), (16, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.mark.parametrize("at", range(len(corpus_pipeline.STAGES)))
def test_stages_take_any_rows(spark, labelled, at):
    name, stage = corpus_pipeline.STAGES[at]
    out = stage(spark, cases.with_clashes(cases.frame(spark)), labelled)
    rows = out.collect()
    if at < 4:
        assert tuple(out.columns) == corpus_pipeline.COLUMNS, name
        assert all(r.n_chars == len(r.text) for r in rows if r.text and at in (1, 3))
    assert rows
    assert stage(spark, cases.empty(spark), labelled).count() == 0


def test_pipeline_stages_compose(spark):
    sf = f"{DATA}/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf)
        assert tuple(after.columns) == corpus_pipeline.COLUMNS, name
        before = after
    scores = quality.score_quality(spark, docs, spark.read.parquet(f"{sf}/labels.parquet"))
    good = corpus_pipeline.keep_good_documents(spark, docs, sf)
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in scores.where("predicted = 1").collect()}
    whole = corpus_pipeline.run(spark, sf)
    assert whole.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert whole.agg(F.sum("length")).first()[0] > 0


def test_pipeline_against_brute_force(spark):
    """Every stage against a plain version of it, each on what the stage before kept."""
    import duckdb

    from tests.llm.test_dedup import brute_lines, ordered_jaccard

    sf, stages = f"{DATA}/sf0.001", dict(corpus_pipeline.STAGES)
    start = spark.read.parquet(f"{sf}/documents.parquet")
    good = stages["quality classifier"](spark, start, sf)
    scores = quality.score_quality(spark, start, spark.read.parquet(f"{sf}/labels.parquet"))
    kept = {r.doc_id for r in scores.collect() if r.score >= 0.7}
    rows = [tuple(r) for r in start.collect() if r.doc_id in kept]
    assert cases.as_set(good, *corpus_pipeline.COLUMNS) == cases.as_set(spark.createDataFrame(rows, cases.SCHEMA), *corpus_pipeline.COLUMNS)

    cut = stages["line dedup"](spark, cases.frame(spark, rows), sf)
    want = {d: text for d, _, _, text in brute_lines(rows, 3)}
    assert {r.doc_id: r.text for r in cut.collect()} == want
    rows = [(d, want[d], lang, source, len(want[d])) for d, _, lang, source, _ in rows]

    words = {r[0]: WORD.findall(r[1]) for r in rows}
    sets = {d: {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} for d, w in words.items()}
    root = {d: d for d in words}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(words)
    text_of = {r[0]: r[1] for r in rows}
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            shared = len(sets[a] & sets[b])
            if text_of[a] == text_of[b] or (shared > 0.3 * max(len(sets[a]), len(sets[b])) and ordered_jaccard(words[a], words[b]) >= 0.8):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    single = stages["MinHash near-dedup"](spark, cases.frame(spark, rows), sf)
    assert sorted(r.doc_id for r in single.collect()) == sorted({find(d) for d in ids})
    rows = [r for r in rows if find(r[0]) == r[0]]

    mixed = stages["mixing sources to target weights"](spark, cases.frame(spark, rows), sf).collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    taken = {r[0]: r[1] for r in con.sql(f"SELECT doc_id, taken FROM ({mixing.ORACLE_SQL})").fetchall()}
    got: dict = dict.fromkeys(taken, 0)
    for r in mixed:
        got[r.doc_id] += len(WORD.findall(r.text))
    assert got == taken

    packed = stages["packing"](spark, spark.createDataFrame(mixed, cases.SCHEMA), sf).collect()
    bpe = packing.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    texts: dict = {}
    for r in mixed:
        texts.setdefault(r.doc_id, []).append(np.array([*packing.token_ids(bpe, r.text), 1], "<u4"))
    assert sum(p.length for p in packed) == sum(len(x) for xs in texts.values() for x in xs)
    for p in packed:
        assert any(len(x) == p.doc_tokens and zlib.crc32(x[p.start:p.start + p.length].tobytes()) == p.ids_crc32 for x in texts[p.doc_id])
