"""Scalar functions on hand-made values."""

from __future__ import annotations

import hashlib
import json
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from fathom.functions import arrow, canonical_json, ids, versions
from fathom.functions import geometry as g
from fathom.functions import text as t


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(
        f"{k} {'int' if isinstance(v, int) and not isinstance(v, bool) else 'boolean' if isinstance(v, bool) else 'double' if isinstance(v, float) else 'string'}"
        for k, v in values.items()))
    return row.select(column.alias("x")).first()["x"]


PLANS = [  # current, changed, base, proposed, outcome, code, expected
    (None, True, None, None, "ALLOW", "NEW_V1", 1), (None, True, None, 1, "ALLOW", "NEW_V1", 1), (None, True, None, 2, "BLOCK", "VERSION_GAP", 1),
    (None, True, 1, 1, "BLOCK", "VERSION_STALE", 1), (3, True, 2, 4, "BLOCK", "VERSION_STALE", 4), (3, False, 3, None, "ALLOW", "NO_CHANGE", 3),
    (3, False, 3, 4, "BLOCK", "VERSION_NO_CHANGE", 3), (3, True, 3, 4, "ALLOW", "ADVANCE", 4), (3, True, 3, 3, "BLOCK", "VERSION_COLLISION", 4),
    (3, True, 3, 6, "BLOCK", "VERSION_GAP", 4), (999, True, 999, None, "BLOCK", "VERSION_LIMIT_REACHED", None), (1000, True, 1000, None, "BLOCK", "INVALID_VERSION", None)]


def test_version_plans(spark):
    df = spark.createDataFrame([(i, *p[:4]) for i, p in enumerate(PLANS)], "i int, c int, ch boolean, b int, p int")
    got = df.select("i", versions.plan_version(F.col("c"), F.col("ch"), F.col("b"), F.col("p")).alias("v")).orderBy("i").collect()
    assert [(r.v.outcome, r.v.code, r.v.expected) for r in got] == [p[4:] for p in PLANS]


@pytest.mark.parametrize(("value", "want"), [("a \t b\n\n  c  ", "a b\nc"), ("", ""), (" \x85 ", ""), ("x\r\ny", "x\ny")])
def test_canonical_whitespace(spark, value, want):
    assert one(spark, t.canonical_whitespace(F.col("v")), v=value) == want


def test_white_space_class_is_pythons(spark):
    codes = [c for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c, chr(c)) for c in codes], "c int, v string")
    white = {r.c for r in df.where(F.col("v").rlike(f"^[{t.WHITE}]$")).collect()}
    assert white == {c for c in codes if chr(c).isspace()}


@pytest.mark.parametrize(("value", "codes"), [
    ("plain text", []), ("a\tb", ["CONTROL_WHITESPACE_SEPARATOR"]), ("net _amount", ["IDENTIFIER_WHITESPACE_SPLIT"]),
    ("sales .orders", ["QUALIFIED_IDENTIFIER_WHITESPACE_SPLIT", "PUNCTUATION_WHITESPACE_BEFORE"]), ("at 12 : 30 today", ["PROTECTED_TOKEN_WHITESPACE_SPLIT", "PUNCTUATION_WHITESPACE_BEFORE"]),
    ("a , b", ["PUNCTUATION_WHITESPACE_BEFORE"]), ("f( x", ["PUNCTUATION_WHITESPACE_AFTER_OPEN"])])
def test_spacing_defects(spark, value, codes):
    assert one(spark, t.spacing_defects(F.col("v")), v=value) == codes


def test_spacing_states_round_trip(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab \n.") for _ in range(rng.randint(0, 40))) for _ in range(100)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, v string")
    got = df.select("i", "v", t.spacing_states(F.col("v")).alias("s"), t.without_whitespace(F.col("v")).alias("d"),
                    t.render_spacing(t.without_whitespace(F.col("v")), t.spacing_states(F.col("v"))).alias("r")).collect()
    for r in got:
        want, gap, seen = "", "", False
        for c in r.v:
            if c.isspace():
                gap += c
                continue
            if seen:
                want += "h" if "\n" in gap else "s" if gap else "n"
            gap, seen = "", True
        assert r.s == want and "".join(r.r.split()) == r.d


def test_changed_boundaries(spark):
    assert one(spark, t.changed_boundaries(F.col("a"), F.col("b")), a="nsn", b="nnh") == [1, 2]


SPACING, RECOGNITION = "SEMANTIC_OCR_CORRECTION_SPACING_INVALID", "SEMANTIC_OCR_CORRECTION_RECOGNITION_INVALID"


@pytest.mark.parametrize(("a", "b", "kind", "code"), [
    ("abc", "abc", "spacing", SPACING), ("a bc", "ab c", "spacing", None), ("abc", "abd", "spacing", SPACING), ("abc", "abd", "recognition", None), ("abc", "abc", "recognition", RECOGNITION),
    ("abc", "abcd", "recognition", RECOGNITION), ("a bc", "abc ", "recognition", RECOGNITION), ("abcdef", "xyzdef", "recognition", RECOGNITION)])
def test_edit_budget(spark, a, b, kind, code):
    assert one(spark, t.edit_budget_code(F.col("a"), F.col("b"), F.col("k")), a=a, b=b, k=kind) == code


@pytest.mark.parametrize(("value", "raw"), [("<b>x</b>", True), ("a < b", False), ("<!-- x\ny -->", True), ("<br/>", True), ("1<2>3", False)])
def test_raw_html(spark, value, raw):
    assert one(spark, t.has_raw_html(F.col("v")), v=value) is raw


def test_small_functions(spark):
    assert one(spark, t.escape_markdown(F.col("v")), v="a*b\\c") == "a\\*b\\\\c"
    assert one(spark, t.masked_preview(F.col("v")), v="secret  value") == "secr…alue"
    assert one(spark, t.masked_preview(F.col("v")), v="short") is None
    assert one(spark, t.normalize_header(F.col("v")), v=" Data  Type ") == "data_type"
    assert one(spark, t.qualified_identifier_repair(F.col("v")), v="a . b") == "a.b"
    assert one(spark, t.lone_syllable(F.col("v")), v="가 나다") is True
    for value, want in (("net _amount", True), ("net_ amount", True), ("가 나다", True), ("가나 다라", False), ("가나 다라 마", False), ("plain text", False), ("x가 나다", False)):
        assert one(spark, t.fragmented(F.col("v")), v=value) is want, value
    assert one(spark, t.form_locator(F.col("v"), F.col("w")), v="Ws. Sales", w=" T") == "unspecified|ws|sales|t"
    assert one(spark, t.form_locator(F.col("v"), F.col("w")), v="ws..x", w="t") is None
    assert one(spark, arrow.utf8_prefix(F.col("v"), F.col("n")), v="é€x", n=4) == "é"
    assert one(spark, t.url_policy_code(F.col("v"), ("h.com",)), v="https://h.com/a/../b") == "UNTRUSTED_ATTACHMENT_PATH"


def test_canonical_hashes_ignore_what_does_not_matter(spark):
    a = json.dumps({"b": 1, "a": "é", "generated_at": "now"})
    b = json.dumps({"a": unicodedata.normalize("NFD", "é"), "b": 1})
    assert canonical_json.canonical_json_hash(a) == canonical_json.canonical_json_hash(b)
    want = hashlib.sha256('{"a":"é","b":1}'.encode()).hexdigest()
    assert one(spark, arrow.canonical_hash(F.col("v")), v=a) == want
    assert one(spark, arrow.schema_hash(F.col("v")), v=json.dumps({"name": "x", "description": "y"})) == hashlib.sha256(b'{"name":"x"}').hexdigest()
    assert one(spark, arrow.canonical_hash(F.col("v")), v=json.dumps([1, 2])) != one(spark, arrow.canonical_hash(F.col("v")), v=json.dumps([2, 1]))


def test_ids(spark):
    assert one(spark, ids.span_id(F.col("h"), F.col("n")), h="ab", n=3) == "span_" + hashlib.sha256(b"ab:3").hexdigest()[:16]
    assert one(spark, ids.content_id("line", F.col("h"), F.col("n")), h="a", n=3) == "line_" + hashlib.sha256(b'["a","3"]').hexdigest()[:16]


def test_uuid7(spark):
    got = one(spark, arrow.uuid7(F.col("ms").cast("long"), F.unhex(F.col("e"))), ms="1704067200000", e="ffffffffffffffffffff")
    assert got == "018cc251-f400-7fff-bfff-ffffffffffff"


def test_geometry(spark):
    a, b = g.box(F.lit(0), F.lit(0), F.lit(2), F.lit(2)), g.box(F.lit(1), F.lit(1), F.lit(3), F.lit(3))
    row = spark.range(1).select(g.overlap_fraction(a, b).alias("f"), g.overlap_score(a, b).alias("s"), g.horizontal_overlap(a, b).alias("h"),
                                g.center_distance(a, b).alias("d"), g.same_baseline(a, b).alias("l"), g.overlap_score(a, g.box(F.lit(1), F.lit(1), F.lit(1), F.lit(1))).alias("z")).first()
    assert (row.f, row.s, row.h, row.d, row.l, row.z) == (0.25, 0.25, 0.5, 2.0, True, 0.0)
