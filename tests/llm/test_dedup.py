"""Substring, suffix, line and near dedup against brute force."""

from __future__ import annotations

import bisect
import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from fathom.llm import line_dedup, order_minhash, substring_dedup, suffix_dedup
from tests.conftest import DATA, ROOT
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")
INF = 1 << 62


def sha(value: bytes) -> str:
    return hashlib.sha256(value).hexdigest()


def unique_ids(rows):
    """Rows whose (doc_id, text) is their own, for brute force by position."""
    seen, out = set(), []
    for r in rows:
        if r[0] not in seen:
            seen.add(r[0])
            out.append(r)
    return out


def brute_words(rows, window):
    docs = sorted(((INF if r[0] is None else r[0], r[0], WORD.findall(r[1] or "")) for r in rows), key=lambda d: d[0])
    seen, gone = set(), {}
    for key, _, words in docs:
        lost = gone.setdefault(key, set())
        for i in range(len(words) - window + 1):
            w = tuple(words[i:i + window])
            if w in seen:
                lost.update(range(i, i + window))
            seen.add(w)
    return sorted(((d, len(w), len(gone[k]), " ".join(x for i, x in enumerate(w) if i not in gone[k])) for k, d, w in docs), key=repr)


def brute_bytes(rows, match):
    raws = [(r[0], (r[1] or "").encode()) for r in rows]
    count: dict[bytes, int] = {}
    for _, raw in raws:
        for i in range(len(raw) - match + 1):
            count[raw[i:i + match]] = count.get(raw[i:i + match], 0) + 1
    out = []
    for d, raw in raws:
        lost = np.zeros(len(raw), bool)
        for i in range(len(raw) - match + 1):
            if count[raw[i:i + match]] > 1:
                lost[i:i + match] = True
        kept = np.frombuffer(raw, np.uint8)[~lost].tobytes()
        spans = int(np.count_nonzero(np.diff(lost.astype(np.int8), prepend=0) == 1))
        out.append((d, len(raw), int(lost.sum()), spans, kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("window", "start"), [(20, 5), (8, 4), (4, 4)])
def test_words_against_brute_force(spark, window, start):
    rows = unique_ids(cases.documents())
    out = substring_dedup.remove_repeated_words(spark, cases.with_clashes(cases.frame(spark, rows)), window, start)
    assert cases.as_set(out, "doc_id", "n_words", "n_removed", "kept_text") == brute_words(rows, window)


def test_words_of_small_vocabulary(spark):
    rng = random.Random(3)
    rows = [(i, cases.prose(rng, rng.randint(0, 60), 3), "en", "s", 0) for i in range(60)]
    out = substring_dedup.remove_repeated_words(spark, cases.frame(spark, rows), 8, 2)
    assert cases.as_set(out, "doc_id", "n_words", "n_removed", "kept_text") == brute_words(rows, 8)


def test_repeated_rows_keep_one_copy(spark):
    text = " ".join(f"u{i}" for i in range(30))
    out = substring_dedup.remove_repeated_words(spark, cases.frame(spark, [(1, text, "en", "s", 0)] * 3), 20)
    assert sorted(r.n_removed for r in out.collect()) == [0, 30, 30]


@pytest.mark.parametrize("hot", [2048, 2, 0])
def test_bytes_against_brute_force(spark, hot):
    """With any hot limit: by the index, by both ways, and by window hashes alone."""
    rows = cases.documents()
    out = suffix_dedup.remove_repeated_bytes(spark, cases.with_clashes(cases.frame(spark, rows)), hot_limit=hot)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()), key=repr)
    assert got == brute_bytes(rows, 200)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bytes_of_random_copies(spark, seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abc \n") for _ in range(rng.randint(20, 400))) for _ in range(6)]
    rows = [(i, "".join(rng.choice(pool)[rng.randint(0, 15):] for _ in range(rng.randint(0, 5))), "en", "s", 0) for i in range(40)]
    out = suffix_dedup.remove_repeated_bytes(spark, cases.frame(spark, rows), match_bytes=40, seed_bytes=8)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()), key=repr)
    assert got == brute_bytes(rows, 40)


@pytest.mark.parametrize("hot", [1 << 16, 50])
def test_bytes_of_long_repetitive_texts(spark, hot):
    rng = random.Random(6)
    odd = "".join(rng.choice("abcdefgh ") for _ in range(1500))
    rows = [(1, "a" * 30_000, None, None, 0), (2, "ab " * 9_000 + odd, None, None, 0), (3, odd[:700] + "a" * 450, None, None, 0), (4, "unlike " + odd[900:], None, None, 0)]
    out = suffix_dedup.remove_repeated_bytes(spark, cases.frame(spark, rows), hot_limit=hot)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()), key=repr)
    assert got == brute_bytes(rows, 200)


def test_one_long_text_needs_little_memory():
    """5 MB of one byte: every position is a seed, all windows are equal."""
    import subprocess
    import sys

    code = """
import resource, numpy as np, pandas as pd
from fathom.llm import suffix_dedup as s
c = s._Chunk(pd.DataFrame({"text": ["a" * 5_000_000]}), 64, 200)
every = np.arange(len(c.at))
known, _, place = c.surroundings(every, 16)
starts, _ = c.windows(every)
assert len(starts) == 5_000_000 - 199 and sum(map(len, known.values())) == 273
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, check=True)
    assert int(run.stdout) < 1000


def test_chunks_are_bounded_by_bytes(spark):
    from fathom.llm.exchange import chunked
    from fathom.llm.common import id_columns

    rows = [(i, "x" * (i * 997 % 3000), None, None, 0) for i in range(300)] + [(900, "y" * 50_000, None, None, 0)]
    got = chunked(cases.frame(spark, rows).select(*id_columns(), "text"), 10_000).collect()
    sizes: dict = {}
    for r in got:
        sizes.setdefault(r.chunk, []).append(len(r.text))
    assert sum(map(len, sizes.values())) == 301 and len({r.row for r in got}) == 301
    assert all(sum(v) <= 10_000 or len(v) == 1 for v in sizes.values()) and len(sizes) < 90


def brute_lines(rows, run):
    docs = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows})
    first, gone = {}, {}
    for null, d, text in docs:
        lines = text.split("\n")
        lost = gone.setdefault((null, d, text), set())
        for i in range(len(lines) - run + 1):
            w = tuple(lines[i:i + run])
            if all(not x.strip(" ") for x in w):
                continue
            if w in first:
                lost.update(range(i, i + run))
            first.setdefault(w, (d, i))
    out = []
    for r in rows:
        lost, lines = gone[r[0] is None, r[0] or 0, r[1] or ""], (r[1] or "").split("\n")
        out.append((r[0], len(lines), len(lost), "\n".join(x for i, x in enumerate(lines) if i not in lost)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("run", [3, 2])
def test_lines_against_brute_force(spark, run):
    rows = cases.documents()
    out = line_dedup.delete_repeated_lines(cases.with_clashes(cases.frame(spark, rows)), run)
    assert "clash" in {r.node for r in out.collect()}  # other columns pass through
    assert cases.as_set(out, "doc_id", "n_lines", "n_removed", "text") == brute_lines(rows, run)


def test_matches_are_maximal(spark):
    common = "\n".join(f"line {i}" for i in range(6))
    rows = [(1, f"a\n{common}\nb", None, None, 0), (2, f"{common}\nc", None, None, 0), (3, f"line 1\nline 2\nline 3\nx\n{common}", None, None, 0)]
    got = cases.as_set(line_dedup.matched_runs(cases.frame(spark, rows)), "id", "start", "lines", "first_id", "first_start")
    assert got == [(2.0, 0.0, 6.0, 1.0, 1.0), (3.0, 0.0, 3.0, 1.0, 2.0), (3.0, 4.0, 6.0, 1.0, 1.0)]


def test_line_plan_is_native(spark):
    out = line_dedup.delete_repeated_lines(cases.frame(spark))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|ArrowEval", plan)


def ordered_jaccard(a: list, b: list, k: int = 5) -> float:
    def labelled(words):
        k_ = min(k, len(words))
        seen: dict[tuple, int] = {}
        out = []
        for i in range(len(words) - k_ + 1):
            s = tuple(words[i:i + k_])
            seen[s] = seen.get(s, 0) + 1
            out.append((s, seen[s]))
        return out if words else []

    x, y = labelled(a), labelled(b)
    if not x or not y:
        return 0.0
    row = [0] * (len(y) + 1)
    for i in x:
        before = 0
        for j, v in enumerate(y, 1):
            before, row[j] = row[j], before + 1 if v == i else max(row[j], row[j - 1])
    m = row[-1]
    return m / (len(x) + len(y) - m)


def near_rows():
    rng = random.Random(9)
    rows = []
    for _ in range(12):
        words = [f"v{rng.randrange(5000)}" for _ in range(rng.randint(30, 120))]
        for _ in range(rng.randint(1, 5)):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                at = rng.randrange(len(copy))
                copy[at:at + 1] = rng.choice([[], ["new"], ["new", "two"]])
            rows.append((len(rows), " ".join(copy), "en", "s", 0))
    return rows


def brute_classes(rows):
    words = [WORD.findall(r[1] or "") for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if (rows[i][1] or "") == (rows[j][1] or "") or ordered_jaccard(words[i], words[j]) >= 0.8:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    low: dict[int, int] = {}
    for i, r in enumerate(rows):
        k = INF if r[0] is None else r[0]
        low[find(i)] = min(low.get(find(i), INF), k)
    return sorted(((r[0], len(words[i]), None if low[find(i)] == INF else low[find(i)]) for i, r in enumerate(rows)), key=repr)


@pytest.mark.parametrize("rows", [cases.documents(), near_rows()], ids=["edges", "copies"])
def test_near_duplicates_against_brute_force(spark, rows):
    out = order_minhash.near_duplicates(spark, cases.with_clashes(cases.frame(spark, rows)))
    assert cases.as_set(out, "doc_id", "n_words", "class_id") == brute_classes(rows)
    kept = [r for r in out.collect() if r.kept]
    assert len(kept) == len({c for _, _, c in brute_classes(rows)})


def links_by_prefixes(texts: list[str]) -> list[tuple[int, int]]:
    """All links of 0.8 or more between different texts, exactly and without sketches.

    Similar texts share 0.8 of their labelled shingles, so each one's rarest fifth holds one of the other's.
    """
    docs = []
    for text in texts:
        words, seen, out = WORD.findall(text), {}, []
        size = min(5, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            shingle = " ".join(words[i:i + size])
            seen[shingle] = seen.get(shingle, 0) + 1
            out.append((shingle, seen[shingle]))
        docs.append(out)
    often = collections.Counter(x for d in docs for x in d)
    holders, tried, links = collections.defaultdict(list), set(), []
    for i, d in enumerate(docs):
        place = {x: p for p, x in enumerate(d)}
        rare = sorted(d, key=lambda x: (often[x], x))
        for x in rare[:len(rare) - (4 * len(rare) + 4) // 5 + 1]:
            for j in holders[x]:
                if (i, j) in tried or 10 * min(len(d), len(docs[j])) < 8 * max(len(d), len(docs[j])):
                    continue
                tried.add((i, j))
                tails: list[int] = []
                for y in docs[j]:
                    if y in place:
                        at = bisect.bisect_left(tails, place[y])
                        tails[at:at + 1] = [place[y]]
                common = len(tails)
                if 10 * common >= 8 * (len(d) + len(docs[j]) - common):
                    links.append((i, j))
            holders[x].append(i)
    return links


def recall_and_classes(spark, folder: str):
    """(links, links whose ends share a class, whether all classes equal brute force) of a folder's documents."""
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    texts = sorted({r.text or "" for r in rows})
    links = links_by_prefixes(texts)
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in links:
        root[find(i)] = find(j)
    number = {t: i for i, t in enumerate(texts)}
    low: dict[int, int] = {}
    for r in rows:
        c = find(number[r.text or ""])
        low[c] = min(low.get(c, INF), r.doc_id)
    got = {r.doc_id: r.class_id for r in order_minhash.op1_order_minhash(spark, folder).collect()}
    one = {number[r.text or ""]: r.doc_id for r in rows}
    found = sum(got[one[i]] == got[one[j]] for i, j in links)
    return len(links), found, got == {r.doc_id: low[find(number[r.text or ""])] for r in rows}


def test_links_of_a_whole_table_are_found(spark):
    links, found, equal = recall_and_classes(spark, f"{DATA}/sf0.1")
    assert links > 30 and found >= 0.9 * links
    assert equal


def test_one_document_of_each_class_stays(spark):
    rows = cases.documents()
    left = order_minhash.drop_near_duplicates(spark, cases.frame(spark, rows))
    assert left.columns == [c.split()[0] for c in cases.SCHEMA.split(", ")]
    assert left.count() == len({c for _, _, c in brute_classes(rows)})


def test_members_unlike_the_smallest_still_meet():
    """A passage shared by unlike texts puts them in one group; true copies in it are found."""
    rng = random.Random(2)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for _ in range(30):
        own = [f"o{rng.randrange(10**6)}" for _ in range(25)]
        texts += [passage + own, [*passage, *own[:-1], "z"]]
    assert all(ordered_jaccard(a, b) >= 0.8 for a, b in zip(texts[::2], texts[1::2], strict=True))


def test_shared_passage_does_not_link_others(spark):
    rng = random.Random(2)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for _ in range(40):
        own = [f"o{rng.randrange(10**6)}" for _ in range(40)]
        for words in (passage + own, [*passage, *own[:-1], "z"]):
            rows.append((len(rows), " ".join(words), "en", "s", 0))
    out = order_minhash.near_duplicates(spark, cases.frame(spark, rows))
    assert cases.as_set(out, "doc_id", "class_id") == [(i, (i // 2) * 2) for i in sorted(range(80), key=lambda i: repr((float(i), float(i // 2 * 2))))] or \
        {(r.doc_id, r.class_id) for r in out.collect()} == {(i, i // 2 * 2) for i in range(80)}


def template_family(pairs=120, template=430, shared=26, own=40):
    """Pairs on one template: similar to each other (0.852), unlike all others (0.768)."""
    rng = random.Random(5)
    words = [f"t{i}" for i in range(template)]
    rows = []
    for p in range(pairs):
        both = [f"s{p}_{i}" for i in range(shared)]
        cut = rng.randrange(100, template - 100)
        for side in "ab":
            mine = [f"{side}{p}_{i}" for i in range(own)]
            rows.append((len(rows), " ".join(words[:cut] + both + words[cut:] + mine), "en", "s", 0))
    return rows


@pytest.mark.parametrize("limits", [(1024, 1 << 20), (50, 1 << 20), (1024, 20000)], ids=["one", "members", "words"])
def test_every_pair_of_a_template_family_is_found(spark, monkeypatch, limits):
    """In one block, and in several by either limit."""
    monkeypatch.setattr(order_minhash, "BLOCK_NODES", limits[0])
    monkeypatch.setattr(order_minhash, "BLOCK_WORDS", limits[1])
    rows = template_family()
    words = [r[1].split() for r in rows]
    assert all(ordered_jaccard(words[i], words[i + 1]) >= 0.8 for i in range(0, 20, 2))
    assert all(ordered_jaccard(words[0], words[i]) < 0.8 for i in range(2, 20))
    # A large class beside them: copies of one text, each with another word at its end.
    rows += [(1000 + i, " ".join([*words[0][:300], *[f"z{j}" for j in range(200)], f"end{i}"]), "en", "s", 0) for i in range(120)]
    out = {(r.doc_id, r.class_id) for r in order_minhash.near_duplicates(spark, cases.frame(spark, rows)).collect()}
    assert out == {(i, i // 2 * 2) for i in range(240)} | {(1000 + i, 1000) for i in range(120)}


@pytest.mark.parametrize("n", [4, 8, 28, 40, 100, 396])
def test_texts_exactly_at_the_threshold_are_similar(n):
    """n of n * 5 / 4 shingles: with words put before, after or on both sides, and one text in place of words."""
    m = n * 5 // 4
    base = [f"b{i}" for i in range(n + 4)]
    more = [f"m{i}" for i in range(m - n)]
    pairs = [(base, more + base), (base, base + more), (base, more[:1] + base + more[1:])]
    common = (n + m) * 4 // 9
    if (n + m) * 4 % 9 == 0:
        pairs.append((base[:common + 4] + [f"x{i}" for i in range(n - common)], base[:common + 4] + [f"y{i}" for i in range(m - common)]))
    for a, b in pairs:
        assert ordered_jaccard(a, b) == 0.8
        x, y = (order_minhash.shingles(w, 5) for w in order_minhash._word_hashes([" ".join(a), " ".join(b)]))
        assert order_minhash.similarity(x, y, 0.8) == 0.8 == order_minhash.similarity(y, x, 0.8)


def test_no_size_at_the_threshold_is_lost_to_rounding():
    lost = 0
    for n in range(1, 120):
        for m in range(n, 120):
            common, rest = divmod((n + m) * 4, 9)
            if rest or common > n:
                continue
            a = np.arange(n, dtype=np.uint64)
            b = np.concatenate([a[:common], np.arange(1000, 1000 + m - common, dtype=np.uint64)])
            lost += order_minhash.similarity(a, b, 0.8) != 0.8
    assert lost == 0


@pytest.mark.parametrize("apply", [
    lambda s, d: substring_dedup.remove_repeated_words(s, d), lambda s, d: suffix_dedup.remove_repeated_bytes(s, d),
    lambda s, d: line_dedup.delete_repeated_lines(d), lambda s, d: order_minhash.near_duplicates(s, d),
    lambda s, d: order_minhash.drop_near_duplicates(s, d)])
def test_empty_tables(spark, apply):
    assert apply(spark, cases.empty(spark)).count() == 0


def test_window_must_double_up():
    with pytest.raises(ValueError, match="power of two"):
        substring_dedup._levels(5, 30)
