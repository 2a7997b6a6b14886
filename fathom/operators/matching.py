"""Order-dependent matching: each document is one group of a grouped map.

The choices of a step decide what later ones may take, so they can't be a join. A
document's groups and hints are its own, and bounded by its size.
"""

from __future__ import annotations

import difflib
import unicodedata
from bisect import bisect_left
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.session import ship_package

# Weights of a match and the score that accepts it.
OVERLAP_WEIGHT, TEXT_WEIGHT, ORDER_WEIGHT, ACCEPT = 0.55, 0.35, 0.10, 0.72
MATCH_SCHEMA = "doc string, hint int, first int, last int, score double"
ORDER_SCHEMA = "doc string, rank int, position int, region long"


def plain(value: str | None) -> str:
    return "".join(unicodedata.normalize("NFC", value or "").casefold().split())


def box_overlap(a, b) -> float:
    """Shared area by the smaller area of (left, bottom, right, top) boxes; equality if one has none."""
    least = min((a[2] - a[0]) * (a[3] - a[1]), (b[2] - b[0]) * (b[3] - b[1]))
    if least <= 0:
        return float(tuple(a) == tuple(b))
    return max(0.0, min(a[2], b[2]) - max(a[0], b[0])) * max(0.0, min(a[3], b[3]) - max(a[1], b[1])) / least


def _weighted(ratio: float, order: int, hint_order: int, shared: float | None) -> float:
    parts = [(TEXT_WEIGHT, ratio), (ORDER_WEIGHT, 1.0 / (1.0 + abs(order - hint_order)))]
    if shared is not None:
        parts.append((OVERLAP_WEIGHT, shared))
    return sum(w * s for w, s in parts) / sum(w for w, _ in parts)


def match_score(text: str, hint: str, order: int, hint_order: int, box, hint_box) -> float | None:
    """Weighted similarity of a candidate and a hint; None where their boxes don't meet.

    Weights are shared out anew where a box is missing.
    """
    shared = None
    if box is not None and hint_box is not None:
        shared = box_overlap(box, hint_box)
        if shared <= 0:
            return None
    return _weighted(difflib.SequenceMatcher(None, plain(text), plain(hint), autojunk=False).ratio(), order, hint_order, shared)


def _wider(a, b):
    if a is None or b is None:
        return a if b is None else b
    return min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3])


def _box(row, prefix=""):
    left = row[prefix + "left"]
    return None if pd.isna(left) else (left, row[prefix + "bottom"], row[prefix + "right"], row[prefix + "top"])


def _starts_alone(text: str | None) -> bool:
    """Whether normalising can't join a text to the one before it: nothing below U+0300, no Hangul syllable and no
    common ideograph composes with what stands before."""
    first = ord(text[0]) if text else 0
    return first < 0x300 or 0xAC00 <= first <= 0xD7A3 or 0x4E00 <= first <= 0x9FFF


def _ratio_at_most(one: int, other: int, common: int) -> float:
    return 2.0 * common / (one + other) if one + other else 1.0


class _Run:
    """A run of rows that grows at its end: its text, its box, and how many characters it has in common with a hint at most."""

    def __init__(self, hint_chars: Counter):
        self.texts, self.dense, self.size, self.box = [], [], 0, None
        self.hint_chars, self.left, self.common, self.apart = hint_chars, Counter(hint_chars), 0, True

    def add(self, row) -> None:
        self.box = _wider(self.box, row["_box"])
        self.apart = self.apart and (row["_alone"] or not self.texts)
        self.texts.append(row["text"])
        if self.apart:
            self._count(row["_dense"])
        else:
            self.left, self.size, self.common, self.dense = Counter(self.hint_chars), 0, 0, []
            self._count(plain("".join(self.texts)))

    def _count(self, dense: str) -> None:
        self.dense.append(dense)
        self.size += len(dense)
        for c in dense:
            if self.left[c] > 0:
                self.left[c] -= 1
                self.common += 1


#: What rounding may add to a bound.
SLACK = 1e-9


def _best_run(rows: list[dict], firsts: list[int], hint: dict, tail_alone: list[bool]):
    """(score, first, last) of the best run from one of ``firsts``, or None; the first one on ties.

    Runs are compared with the hint only where bounds on their likeness (by length, by characters, by boxes) could
    beat the best so far; a perfect one ends the search.
    """
    target, hint_box, best = plain(hint["text"]), _box(hint), None
    chars = Counter(target)
    matcher = difflib.SequenceMatcher(None, autojunk=False)
    for first in firsts:
        run = _Run(chars)
        order = rows[first]["position"]
        for last in range(first, len(rows)):
            row = rows[last]
            if row["kind"] in ("table", "alt_text", "text_box") or (row["kind"] == "caption" and hint["kind"] != "paragraph"):
                break
            if last > first and row["page"] != rows[first]["page"]:
                break
            run.add(row)
            least = ACCEPT if best is None else max(ACCEPT, best[0])
            shared = box_overlap(run.box, hint_box) if run.box is not None and hint_box is not None else None
            if shared is None or shared > 0:
                quick = _ratio_at_most(run.size, len(target), run.common)
                if _weighted(quick, order, hint["position"], shared) >= least - SLACK:
                    text = "".join(run.dense)
                    if text == target:
                        ratio = 1.0
                    else:
                        matcher.set_seqs(text, target)
                        ratio = matcher.ratio()
                    score = _weighted(ratio, order, hint["position"], shared)
                    if score >= ACCEPT and (best is None or score > best[0]):
                        best = score, first, last
                        if score >= 1.0:
                            return best
            # Longer runs are less like the hint once they are longer than it.
            if run.apart and tail_alone[last] and run.size >= len(target):
                most = _weighted(_ratio_at_most(run.size, len(target), len(target)), order, hint["position"], 1.0 if hint_box is not None else None)
                if most < (ACCEPT if best is None else max(ACCEPT, best[0])) - SLACK:
                    break
    return best


def _match_document(key, groups: pd.DataFrame, hints: pd.DataFrame) -> pd.DataFrame:
    rows = groups.sort_values("position").to_dict("records")
    by_page: dict = {}
    for i, row in enumerate(rows):
        row["_box"], row["_alone"], row["_dense"] = _box(row), _starts_alone(row["text"]), plain(row["text"])
        by_page.setdefault(row["page"], []).append(i)
    # Whether all rows after one start alone.
    tail_alone = [True] * len(rows)
    for i in range(len(rows) - 2, -1, -1):
        tail_alone[i] = tail_alone[i + 1] and rows[i + 1]["_alone"]
    out, cursor = [], 0
    for hint in hints.sort_values("position").to_dict("records"):
        page = [] if pd.isna(hint["page"]) else by_page.get(hint["page"], [])
        best = _best_run(rows, page[bisect_left(page, cursor):], hint, tail_alone)
        if best:
            out.append((key[0], hint["position"], rows[best[1]]["position"], rows[best[2]]["position"], best[0]))
            cursor = best[2] + 1
    return pd.DataFrame(out, columns=["doc", "hint", "first", "last", "score"])


def match_groups(groups: DataFrame, hints: DataFrame) -> DataFrame:
    """(doc, hint, first, last, score): runs of text groups that hints cover, in order and without reuse.

    Both: doc, position, page, kind, text, left, bottom, right, top. Each hint takes the best run from
    where the last one ended, if its score is 0.72 or more.
    """
    ship_package(groups.sparkSession)
    return groups.groupBy("doc").cogroup(hints.groupBy("doc")).applyInPandas(_match_document, MATCH_SCHEMA)


def _orders_of(doc: str, regions: list[int], edges: list[tuple[int, int]], limit: int):
    rank = {r: i for i, r in enumerate(regions)}
    after: dict[int, list[int]] = {r: [] for r in regions}
    waiting = dict.fromkeys(regions, 0)
    for a, b in edges:
        after[a].append(b)
        waiting[b] += 1
    ready = [r for r in regions if not waiting[r]]
    if not _acyclic(ready, dict(waiting), after):
        return []
    found: list[list[int]] = []
    order: list[int] = []
    # Each level holds the regions that may come next and the one tried; no recursion.
    levels: list[list] = [[ready, -1]]
    while levels and len(found) < limit:
        options, at = levels[-1]
        if at >= 0:
            for b in after[order.pop()]:
                waiting[b] += 1
        if at + 1 == len(options):
            levels.pop()
            continue
        levels[-1][1] = at + 1
        chosen = options[at + 1]
        order.append(chosen)
        for b in after[chosen]:
            waiting[b] -= 1
        if len(order) == len(regions):
            found.append(list(order))
        else:
            freed = [b for b in after[chosen] if not waiting[b]]
            levels.append([sorted([*(r for r in options if r != chosen), *freed], key=rank.get), -1])
    return [(doc, i, p, r) for i, one in enumerate(found) for p, r in enumerate(one)]


def _acyclic(ready: list[int], waiting: dict[int, int], after: dict[int, list[int]]) -> bool:
    queue, done = list(ready), 0
    while queue:
        done += 1
        for b in after[queue.pop()]:
            waiting[b] -= 1
            if not waiting[b]:
                queue.append(b)
    return done == len(waiting)


def topological_orders(regions: DataFrame, edges: DataFrame, limit: int = 5) -> DataFrame:
    """(doc, rank, position, region): the first ``limit`` orders of a document's regions that keep its
    edges, ties by the regions' own order; none for a cycle.

    ``regions``: doc, position, region. ``edges``: doc, before, after.
    """
    ship_package(regions.sparkSession)

    def work(key, r: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        names = r.sort_values("position")["region"].tolist()
        pairs = list(dict.fromkeys(zip(e["before"].tolist(), e["after"].tolist(), strict=True)))
        return pd.DataFrame(_orders_of(key[0], names, pairs, limit), columns=["doc", "rank", "position", "region"])

    return regions.groupBy("doc").cogroup(edges.groupBy("doc")).applyInPandas(work, ORDER_SCHEMA)


def best_tables(groups: DataFrame, hints: DataFrame) -> DataFrame:
    """(doc, hint, first, last, score) of table groups by table hints; as match_groups, for tables."""
    as_text = groups.where("kind = 'table'").withColumn("kind", F.lit("paragraph"))
    single = as_text.withColumn("page", F.coalesce("page", F.lit(0)))
    return match_groups(single, hints).where("first = last")
