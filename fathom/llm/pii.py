"""Personal data: base patterns, and a character BiLSTM-CRF that adds spans.

Base patterns (email, ip, card, phone) are matched in every whole text, leftmost and
without overlap within a kind; matches that fail their test are dropped. A character-level
bidirectional LSTM with CRF transitions, written in numpy, is trained from labelled
spans: the base spans in ``fit_contexts`` contexts (a documented bound; chosen by a hash
of document and place among all contexts) and generated variants that the patterns do not
cover (phones without a plus, cards with other separators, spaced addresses), with
look-alikes such as hexadecimal keys as negatives.

All labelled spans hold a digit or an at sign, so a window without either has no
span; overlapping windows are laid over all others. Each is decoded; of the spans that all
windows of a text offer whole, the most central ones in their windows are taken as long as
they don't overlap. A span too long to lie whole in a window is read from the tags of all
windows together, each character's from the window it is most central in. Spans are
added where they touch no base span.

Edge cases: null text is empty and has no spans; equal rows get equal rows; very long
texts are windowed whole; ties between spans go to the one that starts first; null
doc_ids pass through; extra columns are not read; an empty table gives no rows.
Offsets count code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.session import lean, ship_package

from .common import id_columns, ids_of

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A run of digits matches from its first digit or not at all.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")
NOT_DIGIT = re.compile(r"[^0-9]")

WINDOW, STRIDE = 128, 32
FIT_WINDOW = 64  # of the windows trained from
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
ALPHABET = 98  # printable ASCII, then other white space, other letters, all else
SCHEMA = "doc_id long, kinds array<string>, starts array<int>, ends array<int>, added array<boolean>"


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, ordered."""
    if not TRIGGER.search(text):
        return []
    out, done = [], 0
    sign = text.find("@")
    while sign >= 0:
        start = sign
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        tail = DOMAIN.match(text, sign + 1) if start < sign else None
        if tail:
            done = tail.end()
            out.append((start, 0, done))
        sign = text.find("@", max(sign + 1, done))
    for m in IP.finditer(text):
        parts = [x.lstrip("0") or "0" for x in m[0].split(".")]
        if all(len(x) <= 3 and int(x) <= 255 for x in parts):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19 and passes_luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def encode(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.where((code >= 32) & (code < 127), code - 32, 97).astype(np.int64)
    out[code < 32] = 95
    out[(code >= 0xC0) & (code < 0x2000)] = 96
    return out


class Tagger:
    """Embedding, one LSTM in each direction, a linear layer and CRF transitions."""

    def __init__(self, embed: int = 12, hidden: int = 20, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.hidden = hidden

        def w(*shape):
            return rng.standard_normal(shape) / np.sqrt(shape[0])

        self.p = {"emb": rng.standard_normal((ALPHABET, embed)) * 0.5, "trans": np.zeros((TAGS, TAGS)),
                  "wo": w(2 * hidden, TAGS), "bo": np.zeros(TAGS)}
        for d in "fb":
            self.p |= {"w" + d: w(embed + hidden, 4 * hidden), "b" + d: np.zeros(4 * hidden)}
            self.p["b" + d][hidden:2 * hidden] = 1  # remember at first

    def _lstm(self, x: np.ndarray, d: str):
        b, t, _ = x.shape
        n = self.hidden
        w, bias = self.p["w" + d], self.p["b" + d]
        pre = x @ w[:-n] + bias
        h = c = np.zeros((b, n))
        hs, kept = np.zeros((b, t, n)), []
        steps = range(t) if d == "f" else range(t - 1, -1, -1)
        for i in steps:
            z = pre[:, i] + h @ w[-n:]
            gates = 1 / (1 + np.exp(-z[:, :3 * n]))
            g = np.tanh(z[:, 3 * n:])
            before_h, before_c = h, c
            c = gates[:, n:2 * n] * c + gates[:, :n] * g
            tc = np.tanh(c)
            h = gates[:, 2 * n:] * tc
            hs[:, i] = h
            kept.append((i, gates, g, before_h, before_c, tc))
        return hs, kept

    def emissions(self, ids: np.ndarray):
        x = self.p["emb"][ids]
        forward, backward = self._lstm(x, "f"), self._lstm(x, "b")
        h = np.concatenate([forward[0], backward[0]], axis=2)
        return h @ self.p["wo"] + self.p["bo"], (x, h, forward[1], backward[1])

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Best tag sequences of a batch of windows."""
        e, _ = self.emissions(ids)
        trans = self.p["trans"]
        best, back = e[:, 0], []
        for i in range(1, ids.shape[1]):
            scores = best[:, :, None] + trans
            back.append(scores.argmax(axis=1))
            best = scores.max(axis=1) + e[:, i]
        out = np.zeros(ids.shape, np.int64)
        out[:, -1] = best.argmax(axis=1)
        rows = np.arange(len(ids))
        for i in range(ids.shape[1] - 2, -1, -1):
            out[:, i] = back[i][rows, out[:, i + 1]]
        return out

    def loss_and_gradients(self, ids: np.ndarray, tags: np.ndarray):
        """Negative log-likelihood of the tags a window, and its gradients."""
        b, t = ids.shape
        e, (x, h, kept_f, kept_b) = self.emissions(ids)
        trans = self.p["trans"]

        def lse(a, axis):
            top = a.max(axis=axis, keepdims=True)
            return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))

        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0]
        for i in range(1, t):
            alpha[:, i] = lse(alpha[:, i - 1][:, :, None] + trans, 1) + e[:, i]
        for i in range(t - 2, -1, -1):
            beta[:, i] = lse(trans + (e[:, i + 1] + beta[:, i + 1])[:, None, :], 2)
        z = lse(alpha[:, -1], 1)
        rows, cols = np.arange(b)[:, None], np.arange(t)[None, :]
        gold = e[rows, cols, tags].sum() + trans[tags[:, :-1], tags[:, 1:]].sum()
        de = np.exp(alpha + beta - z[:, None, None])
        de[rows, cols, tags] -= 1
        pair = np.exp(alpha[:, :-1, :, None] + trans + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None])
        g = {"trans": pair.sum(axis=(0, 1))}
        np.add.at(g["trans"], (tags[:, :-1], tags[:, 1:]), -1)
        g["wo"], g["bo"] = np.einsum("btn,btk->nk", h, de), de.sum(axis=(0, 1))
        dh = de @ self.p["wo"].T
        n = self.hidden
        dx = np.zeros_like(x)
        for d, kept, own in (("f", kept_f, dh[:, :, :n]), ("b", kept_b, dh[:, :, n:])):
            w = self.p["w" + d]
            dz = np.zeros((b, t, 4 * n))
            carry_h = carry_c = np.zeros((b, n))
            g["w" + d] = np.zeros_like(w)
            for i, gates, cand, before_h, before_c, tc in reversed(kept):
                total = own[:, i] + carry_h
                into, keep, show = gates[:, :n], gates[:, n:2 * n], gates[:, 2 * n:]
                dc = carry_c + total * show * (1 - tc**2)
                step = np.concatenate([dc * cand * into * (1 - into), dc * before_c * keep * (1 - keep),
                                       total * tc * show * (1 - show), dc * into * (1 - cand**2)], axis=1)
                dz[:, i] = step
                carry_c, carry_h = dc * keep, step @ w[-n:].T
                g["w" + d][-n:] += before_h.T @ step
            g["w" + d][:-n] = np.einsum("bte,btk->ek", x, dz)
            g["b" + d] = dz.sum(axis=(0, 1))
            dx += dz @ w[:-n].T
        g["emb"] = np.zeros_like(self.p["emb"])
        np.add.at(g["emb"], ids, dx)
        return float(z.sum() - gold) / b, {k: v / b for k, v in g.items()}

    def fit(self, ids: np.ndarray, tags: np.ndarray, steps: int = 400, batch: int = 32, rate: float = 0.03) -> Tagger:
        rng = np.random.default_rng(8)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            rows = rng.integers(0, len(ids), batch)
            _, g = self.loss_and_gradients(ids[rows], tags[rows])
            norm = np.sqrt(sum((v**2).sum() for v in g.values()))
            slow = rate * (1 - 0.9 * step / steps)
            for k, v in g.items():
                v = v * min(1.0, 5.0 / (norm + 1e-9))
                first[k] += 0.1 * (v - first[k])
                second[k] += 0.01 * (v * v - second[k])
                self.p[k] -= slow * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
        return self


def _digits(rng, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n)))


def _luhn_number(rng, n: int) -> str:
    body = _digits(rng, n - 1)
    return next(body + str(d) for d in range(10) if passes_luhn(body + str(d)))


def _generated(rng) -> tuple[str, int | None]:
    """A string and its kind number; None: a look-alike that is not personal data."""
    pick = int(rng.integers(0, 12))
    word = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), int(rng.integers(3, 9))))
    if pick == 0:
        return f"{word}.{_digits(rng, 2)}@mail{_digits(rng, 1)}.example.com", 0
    if pick == 1:
        return f"{word} @ {word[::-1]}.org", 0
    if pick == 2:
        return ".".join(str(x) for x in rng.integers(0, 256, 4)), 1
    if pick == 3:
        return " . ".join(str(x) for x in rng.integers(0, 256, 4)), 1
    if pick == 4:
        return _luhn_number(rng, 16), 2
    if pick == 5:
        sep = str(rng.choice([".", "/", " - "]))
        n = _luhn_number(rng, 16)
        return sep.join(n[i:i + 4] for i in range(0, 16, 4)), 2
    if pick == 6:
        return f"+{_digits(rng, 1)} ({_digits(rng, 3)}) {_digits(rng, 3)}-{_digits(rng, 4)}", 3
    if pick == 7:
        return f"({_digits(rng, 3)}) {_digits(rng, 3)}-{_digits(rng, 4)}", 3
    if pick == 8:
        return "".join(rng.choice(list("0123456789abcdef"), int(rng.integers(16, 40)))), None
    if pick == 9:
        return _digits(rng, int(rng.integers(1, 6))), None
    if pick == 10:
        return f"{_digits(rng, 1)}.{_digits(rng, 1)}", None
    return f"{_digits(rng, 4)}-{_digits(rng, 2)}-{_digits(rng, 2)}", None


def training_windows(contexts: list[str], generated: int = 1600):
    """Ids and tags of labelled windows: base spans in context, and generated spans."""
    rng = np.random.default_rng(21)
    ids, tags = [], []

    def add(text: str, spans: list[tuple[int, int, int]], begin: int):
        code, tag = np.zeros(FIT_WINDOW, np.int64), np.zeros(FIT_WINDOW, np.int64)
        all_tags = np.zeros(len(text), np.int64)
        for s, kind, e in spans:
            all_tags[s:e] = 2 + 2 * kind
            all_tags[s] = 1 + 2 * kind
        part = encode(text)[begin:begin + FIT_WINDOW]
        code[:len(part)] = part
        tag[:len(part)] = all_tags[begin:begin + FIT_WINDOW]
        ids.append(code)
        tags.append(tag)

    for text in contexts:
        spans = base_spans(text)
        taken: list[tuple[int, int, int]] = []
        for s in spans:  # one tag a character
            if all(s[0] >= o[2] or s[2] <= o[0] for o in taken):
                taken.append(s)
        add(text, taken, max(0, (len(text) - FIT_WINDOW) // 2))
    words = [w for c in contexts for w in c.split() if not TRIGGER.search(w)] or ["the", "of", "and"]
    for _ in range(generated):
        piece, kind = _generated(rng)
        left = " ".join(rng.choice(words, 8)) + " "
        text = left + piece + str(rng.choice([" ", ", ", ". ", "\n"])) + " ".join(rng.choice(words, 8))
        spans = [] if kind is None else [(len(left), kind, len(left) + len(piece))]
        add(text, spans, max(0, len(left) - int(rng.integers(0, 40))))
    return np.array(ids), np.array(tags)


def reconciled_spans(texts: list[str], tagger: Tagger) -> list[list[tuple[int, int, int]]]:
    """Spans of each text, from overlapping windows around digits and at signs."""
    places, codes = [], []
    for i, text in enumerate(texts):
        last = -1
        for m in TRIGGER.finditer(text):
            for w in range(max(0, (m.start() - WINDOW) // STRIDE + 1), m.start() // STRIDE + 1):
                if w > last:
                    last = w
                    places.append((i, w * STRIDE))
    for i, begin in places:
        code = np.zeros(WINDOW, np.int64)
        part = encode(texts[i][begin:begin + WINDOW])
        code[:len(part)] = part
        codes.append(code)
    offered: list[list[tuple[float, int, int, int]]] = [[] for _ in texts]
    decoded: dict[int, list[tuple[int, np.ndarray]]] = {}
    cut_off = set()
    for lo in range(0, len(codes), 512):
        got = tagger.decode(np.array(codes[lo:lo + 512]))
        for (i, begin), tags in zip(places[lo:lo + 512], got, strict=True):
            size = min(WINDOW, len(texts[i]) - begin)
            decoded.setdefault(i, []).append((begin, tags[:size].astype(np.int8)))
            for s, kind, e in window_spans(tags[:size]):
                # A span cut off by its window is whole in another one, or longer than any holds.
                if (s > 0 or begin == 0) and (e < size or begin + size == len(texts[i])):
                    offered[i].append((abs(s + e - WINDOW), begin + s, kind, begin + e))
                else:
                    cut_off.add(i)
    for i in cut_off:
        offered[i] += [(2 * WINDOW, s, kind, e) for s, kind, e in window_spans(merged_tags(decoded[i], len(texts[i])))
                       if e - s >= WINDOW - STRIDE - 1]
    out = []
    for spans in offered:
        taken: list[tuple[int, int, int]] = []
        for _, s, kind, e in sorted(set(spans)):  # the most central first
            if all(s >= t[2] or e <= t[0] for t in taken):
                taken.append((s, kind, e))
        out.append(sorted(taken))
    return out


def merged_tags(windows: list[tuple[int, np.ndarray]], size: int) -> np.ndarray:
    """The tags of a text, each character's from the window it is most central in."""
    out, off = np.zeros(size, np.int8), np.full(size, WINDOW, np.float32)
    for begin, tags in windows:
        here = np.abs(np.arange(len(tags)) + 0.5 - WINDOW / 2)
        nearer = here < off[begin:begin + len(tags)]
        out[begin:begin + len(tags)][nearer] = tags[nearer]
        off[begin:begin + len(tags)][nearer] = here[nearer]
    return out


def window_spans(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the runs of tags of one kind; a begin tag starts a new one."""
    spans: list[list[int]] = []
    for at in np.flatnonzero(tags).tolist():
        kind, inside = (int(tags[at]) - 1) // 2, int(tags[at]) % 2 == 0
        if inside and spans and spans[-1][2] == at and spans[-1][1] == kind:
            spans[-1][2] = at + 1
        else:
            spans.append([at, kind, at + 1])
    return [(s, k, e) for s, k, e in spans]


def plausible(kind: int, piece: str) -> bool:
    """Whether a span found by the network passes its kind's own test."""
    digits = NOT_DIGIT.sub("", piece)
    if kind == 0:
        return len(piece) >= 6 and "@" in piece.strip("@ ") and "." in piece
    if kind == 1:
        numbers = re.findall("[0-9]+", piece)
        return len(numbers) == 4 and all(len(n) <= 3 and int(n) <= 255 for n in numbers)
    if kind == 2:
        return 12 <= len(digits) <= 19 and passes_luhn(digits)
    return 9 <= len(digits) <= 15


def added_spans(text: str, base: list, found: list) -> list[tuple[int, int, int]]:
    """Network spans that touch no base span, stand alone and pass their kind's test."""
    out = []
    for s, kind, e in found:
        while s < e and text[s].isspace():
            s += 1
        while e > s and text[e - 1].isspace():
            e -= 1
        cut = text[s:s + 1].isdigit() and text[s - 1:s].isdigit() or (
            text[e - 1:e].isdigit() and text[e:e + 1].isdigit())  # a part of a longer number
        if not cut and plausible(kind, text[s:e]) and all(s >= b[2] or e <= b[0] for b in base):
            out.append((s, kind, e))
    return out


def find_pii(spark: SparkSession, docs: DataFrame, fit_contexts: int = 1200) -> DataFrame:
    """All spans of every text: doc_id, kinds, starts, ends and added (by the network).

    Spans are ordered by start, then kind. ``fit_contexts`` bounds the contexts (a digit
    or an at sign and what is around it) whose base spans the network is trained from.
    """
    ship_package(spark)
    texts = docs.select(*id_columns(), F.coalesce("text", F.lit("")).alias("text"))
    # A share of the texts by hash first, so that no task sorts many contexts.
    share = min(1.0, 16 * fit_contexts / max(1, texts.count()))
    some = texts.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))).select(
        "doc_id", F.posexplode(F.expr("regexp_extract_all(text, '(?s).{0,40}[0-9@].{0,40}', 0)")).alias("place", "c"))
    chosen = some.withColumn("o", F.xxhash64("doc_id", "place")).orderBy("o", "doc_id", "place", "c").limit(fit_contexts).collect()
    tagger = Tagger().fit(*training_windows([r["c"] for r in chosen]))

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lo in range(0, len(frame), 2000):
                part = frame.iloc[lo:lo + 2000]
                strings = list(part["text"])
                rows = []
                for text, found in zip(strings, reconciled_spans(strings, tagger), strict=True):
                    base = base_spans(text)
                    more = added_spans(text, base, found)
                    every = sorted([(*s, False) for s in base] + [(*s, True) for s in more])
                    rows.append(([KINDS[s[1]] for s in every], [s[0] for s in every],
                                 [s[2] for s in every], [s[3] for s in every]))
                got = pd.DataFrame(rows, columns=["kinds", "starts", "ends", "added"])
                got.insert(0, "doc_id", ids_of(part))
                yield got

    return texts.mapInPandas(lean(find), SCHEMA)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    every = "transform(kinds, (k, i) -> concat(k, ':', starts[i], ':', ends[i]))"
    base = f"filter({every}, (s, i) -> NOT added[i])"
    counts = [F.expr(f"cast(size(filter(kinds, (k, i) -> k = '{k}' AND NOT added[i])) as bigint)").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.expr(f"sha2(cast(array_join({base}, ',') as binary), 256)").alias("base_sha256"),
                        F.expr(f"array_join({every}, ',')").alias("spans"), F.size("kinds").cast("long").alias("n_spans"))
