"""Operators on hand-made rows: edges that the queries' tables don't have."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from fathom.functions import geometry as g
from fathom.operators import candidates, canonical, identity, layout, matching, metrics, registry, reports, sequences, spatial
from fathom.plans import model, reconstruct, sinks


def test_metric_texts(spark):
    df = spark.createDataFrame([("a", 1.5, 2, "x")], "campaign_id string, revenue double, engagement_count int, `order` string")
    d = metrics.Dataset.of("marketing_campaign", df)
    assert metrics.qualify(spark, "count(distinct CAMPAIGN_ID)", d) == "count(DISTINCT marketing_campaign.campaign_id)"
    assert "CAST(SUM(marketing_campaign.engagement_count) AS DECIMAL(38, 12))" in metrics.qualify(
        spark, "SUM(engagement_count) / NULLIF(SUM(engagement_count), 0)", d)
    assert "DECIMAL" not in metrics.qualify(spark, "SUM(revenue) / COUNT(*)", d)
    out = metrics.run_metrics(df, "marketing_campaign", {"m": metrics.qualify(spark, "SUM(engagement_count) / 4", d)})
    assert out.first()["m"] == 0.5 and out.dtypes[0][1].startswith("decimal")
    with pytest.raises(metrics.MetricError, match="METRIC_DATASET_NAME_AMBIGUOUS"):
        metrics.dataset_catalog([d, metrics.Dataset("MARKETING_CAMPAIGN", {}, {})])
    with pytest.raises(metrics.MetricError, match="LLM_METRIC_NAME_DUPLICATE"):
        metrics.compile_metrics(spark, [("A", "t", "COUNT(*)"), ("a", "t", "COUNT(*)")], {"t": df})


def test_relationships_do_not_fan_out(spark):
    many = spark.createDataFrame([(1, 10), (2, 10), (3, None)], "id int, k int")
    one = spark.createDataFrame([(10, "a"), (10, "b")], "key int, name string")
    assert metrics.with_dimension(many, one, [("k", "key")], ["name"]).count() == 3


def test_first_match_wins(spark):
    existing = spark.createDataFrame([("s", "c2", "x", ["n"], "ACTIVE"), ("s", "c1", "n", None, "RETIRED")], "scope string, id string, name string, aliases array<string>, status string")
    got = identity.match_named(spark.createDataFrame([("s", "N")], "scope string, name string"), existing, ["scope"], "id")
    assert {(r.name, r.id, r.code) for r in got.collect()} == {("N", "c1", "RETIRED_COLUMN_REUSE"), ("x", "c2", "RETIRED")}


def test_islands_of_nothing_and_of_one(spark):
    df = spark.createDataFrame([], "k int, o int, v string")
    assert sequences.equal_runs(df, ["k"], ["o"], "v").count() == 0
    one = spark.createDataFrame([(1, 1, None), (1, 2, None), (1, 3, "a")], "k int, o int, v string")
    assert [r.run for r in sequences.equal_runs(one, ["k"], ["o"], "v").orderBy("o").collect()] == [0, 0, 1]


def test_touching_pairs_without_extent(spark):
    box = "struct<left:double,bottom:double,right:double,top:double>"
    a = spark.createDataFrame([(1, (0.0, 0.0, 1.0, 1.0)), (2, (0.5, 0.5, 0.5, 0.5)), (3, (1.0, 0.0, 2.0, 1.0))], f"a int, x {box}").withColumn("p", F.lit(1))
    b = a.select(F.col("a").alias("b"), F.col("x").alias("y"), "p")
    got = {(r.a, r.b) for r in spatial.touching_pairs(a, b, ["p"], "x", "y").collect()}
    assert got == {(1, 1), (2, 2), (3, 3), (1, 2), (2, 1)}  # edges alone don't meet


def test_pairs_are_taken_once_whatever_the_bands(spark):
    box = "struct<left:double,bottom:double,right:double,top:double>"
    a = spark.createDataFrame([(i, (0.0, i / 64, 1.0, i / 64 + 0.25)) for i in range(40)], f"a int, x {box}").withColumn("p", F.lit(1))
    b = a.select(F.col("a").alias("b"), F.col("x").alias("y"), "p")
    want = sum(abs(i - j) < 16 for i in range(40) for j in range(40))
    for height in (0.01, 0.05, 1.0):
        rows = [(r.a, r.b) for r in spatial.touching_pairs(a, b, ["p"], "x", "y", height).collect()]
        assert len(rows) == len(set(rows)) == want


def atoms(spark, *lines: tuple[int, float, float, str]):
    rows, n = [], 0
    for page, left, top, text in lines:
        for i, c in enumerate(text):
            rows.append(("d", page, page, n, "space" if c == " " else "character", c, (left + i * 0.01, top - 0.02, left + i * 0.01 + 0.01, top)))
            n += 1
    return spark.createDataFrame(rows, "doc string, page int, region int, ordinal long, kind string, text string, box struct<left:double,bottom:double,right:double,top:double>")


def test_two_columns_and_repeated_headers(spark):
    rows = []
    for page in (1, 2):
        rows += [(page, 0.1, 0.98, "Header"), (page, 0.1, 0.80, "left one"), (page, 0.1, 0.775, "left two"), (page, 0.6, 0.80, "right one"), (page, 0.45, 0.04, str(page))]
    r = layout.regions(layout.with_columns(layout.lines(atoms(spark, *rows))))
    marked = layout.mark_repeated_edges(r, spark.createDataFrame([("d", 2)], "doc string, page_count int")).collect()
    assert {(x.page, x.text, x.edge) for x in marked} == {(p, *rest) for p in (1, 2) for rest in (
        ("Header", "page_header"), ("left oneleft two", None), ("right one", None), (str(p), "page_number"))}
    edges = layout.reading_edges(r).collect()
    assert len(edges) == len(marked) - 1 and {e.reason for e in edges} == {"next_page", "next_column", "same_column"}


def test_no_character_is_lost(spark):
    import random

    rng = random.Random(6)
    rows = [(1, rng.random() * 0.5, 0.1 + rng.random() * 0.8, "".join(rng.choice("ab c") for _ in range(rng.randint(1, 12)))) for _ in range(25)]
    a = atoms(spark, *rows)
    want = "".join(t for *_, t in rows).replace(" ", "")
    got = layout.line_islands(a).where("line IS NOT NULL").orderBy("ordinal").collect()
    assert "".join(r.text for r in got).replace(" ", "") == want


def test_reconstruction_keeps_all_text(spark):
    rows = []
    for page in (1, 2, 3):
        rows += [(page, 0.1, 0.98, "Head"), (page, 0.1, 0.80, f"1. Title {page}"), (page, 0.1, 0.60, "a plain paragraph of text that is long enough."), (page, 0.1, 0.40, "- one item"), (page, 0.45, 0.04, str(page))]
    r = reconstruct.reconstruct(atoms(spark, *rows))
    assert {x.text for x in r.regions.where("edge IS NOT NULL").collect()} == {"Head", "1", "2", "3"}
    c = r.coverage.first()
    assert (c.items, c.excluded, c.unmatched, c.duplicated, c.ratio) == (15, 6, 0, 0, 1.0)
    text = r.markdown.first()["markdown"]
    for page in (1, 2, 3):
        assert f"Title {page}" in text
    assert "Head" not in text and text.count("plain paragraph") == 3


def test_language_cells(spark):
    cells = spark.createDataFrame([(1, 1, "가 나다"), (1, 2, "plain text")], "table int, cell int, text string")
    props = spark.createDataFrame([(1, 1, 0, "가나다x"), (1, 1, 1, "가나다"), (1, 2, 0, "plaintext")], "table int, cell int, position int, text string")
    assert {(r.cell, r.text, r.changed) for r in candidates.language_cells(cells, props).collect()} == {(1, "가나다", True), (2, "plain text", False)}


def test_decisions(spark):
    rows = [(1, "a", 0.9, False, None, 0), (1, "b", 0.7, False, None, 0), (2, "a", 0.9, False, None, 0), (2, "b", 0.8, False, None, 0), (3, "a", 0.95, False, None, 1),
            (4, "a", 0.5, True, "s", 0), (4, "b", 0.9, True, "s", 0), (4, "c", 0.99, False, None, 0), (5, "a", 0.5, True, "s", 0), (5, "b", 0.4, True, "t", 0), (6, "a", 0.82, False, None, 0)]
    df = spark.createDataFrame(rows, "k int, candidate_id string, score double, proven boolean, signature string, defects int")
    got = {r.k: (r.outcome, r.candidate_id, r.confidence) for r in candidates.decide(df, ["k"]).collect()}
    assert got == {1: ("selected", "a", 0.9), 2: ("deferred", "a", 0.9), 3: ("deferred", "a", 0.95), 4: ("selected", "b", 1.0), 5: ("deferred", "a", 0.5), 6: ("selected", "a", 0.82)}


def test_grids(spark):
    tables = spark.createDataFrame([(1, 2, 2), (2, 1, 2), (3, 20000, 1), (4, 1, 1), (5, 1, 1)], "table int, row_count int, column_count int")
    cells = spark.createDataFrame([(1, 0, 0, 2, 0, 1), (1, 1, 0, 1, 1, 2), (1, 2, 1, 2, 1, 2), (2, 0, 0, 1, 0, 2), (2, 1, 0, 1, 1, 2), (4, 0, 0, 0, 0, 1)],
                                  "table int, cell int, start_row int, end_row int, start_column int, end_column int")
    assert {(r.table, r.code) for r in canonical.grid_findings(cells, tables).collect()} == {
        (2, "TABLE_GRID_OVERLAP"), (3, "TABLE_GRID_DIMENSIONS_INVALID"), (4, "TABLE_CELL_OUT_OF_BOUNDS"), (5, "TABLE_GRID_NOT_PARTITIONED")}


def test_topological_orders(spark):
    r = spark.createDataFrame([("a", i, i) for i in range(3)] + [("c", 0, 7), ("c", 1, 8)], "doc string, position int, region long")
    e = spark.createDataFrame([("a", 0, 2), ("c", 7, 8), ("c", 8, 7)], "doc string, before long, after long")
    rows = matching.topological_orders(r, e).orderBy("rank", "position").collect()
    assert [[x.region for x in rows if x.rank == k] for k in range(3)] == [[0, 1, 2], [0, 2, 1], [1, 0, 2]]
    assert {x.doc for x in rows} == {"a"}  # a cycle has no order


def test_alignment_takes_each_group_once(spark):
    schema = "doc string, position int, page int, kind string, text string, left double, bottom double, right double, top double"
    groups = spark.createDataFrame([("d", 0, 1, "paragraph", "alpha beta", None, None, None, None), ("d", 1, 1, "paragraph", "gamma", None, None, None, None), ("d", 2, 1, "alt_text", "gamma", None, None, None, None)], schema)
    hints = spark.createDataFrame([("d", 0, 1, "paragraph", "alpha betagamma", None, None, None, None), ("d", 1, 1, "paragraph", "gamma", None, None, None, None)], schema)
    assert [(r.hint, r.first, r.last) for r in matching.match_groups(groups, hints).collect()] == [(0, 0, 1)]


def test_reports_and_paths(spark):
    p = spark.createDataFrame([("products/k/sources/a",), ("products/k/product.yaml",), ("registry/x",), ("products",)], "path string")
    assert {(r.path, r.kind, r.product_key) for r in registry.classify_paths(p).collect()} == {
        ("products/k/sources/a", "source", "k"), ("products/k/product.yaml", "config", "k"), ("registry/x", "registry", None), ("products", "code", None)}
    none = spark.createDataFrame([], "product_id int, code string")
    assert reports.product_status(none, spark.createDataFrame([(1,)], "product_id int"), ("X",)).first()["status"] == "PASS"


def test_models_are_json(spark):
    products = spark.createDataFrame([("p", "P", 3, "")], "product_id string, name string, version int, description string")
    tables = spark.createDataFrame([("p", "t", 1, "orders", "c.s.orders", "")], "product_id string, table_id string, version int, dataset string, source string, description string")
    cols = spark.createDataFrame([("t", "c2", 2, "b", "INT64", True, False, ""), ("t", "c1", 1, "a", "INT64", False, True, "key")],
                                 "table_id string, column_id string, ordinal int, name string, data_type string, nullable boolean, primary_key boolean, description string")
    none = spark.createDataFrame([], "product_id string, relationship_id string, name string, from_dataset string, to_dataset string, from_column string, to_column string")
    met = spark.createDataFrame([("p", "m1", "n", "COUNT(*)", "")], "product_id string, metric_id string, name string, expression string, description string")
    got = json.loads(model.compile_models(products, tables, cols, none, met).first()["model"])
    dataset = got["semantic_model"][0]["datasets"][0]
    assert [f["name"] for f in dataset["fields"]] == ["a", "b"] and dataset["primary_key"] == ["a"] and "description" not in dataset
    assert json.loads(dataset["fields"][0]["custom_extensions"][0]["data"]) == {"attributes": {"data_type": "INT64", "nullable": False}, "id": "c1", "kind": "field"}
    assert "relationships" not in got["semantic_model"][0]


def test_bundles_are_reproducible(spark, tmp_path):
    a = spark.createDataFrame([("p", "b", b"2"), ("p", "a", b"1"), ("q", "x", b"3")], "product_id string, name string, content binary")
    first, again = sinks.release_bundle(a, "p"), sinks.release_bundle(a.orderBy(F.desc("name")), "p")
    assert first == again
    import hashlib

    good = {"a": hashlib.sha256(b"1").hexdigest(), "b": hashlib.sha256(b"2").hexdigest()}
    assert sinks.verify_bundle(first, good) is None
    assert sinks.verify_bundle(first, {**good, "c": ""}) == "RELEASE_BUNDLE_CONTENT_MISMATCH"
    assert sinks.verify_bundle(first, {**good, "a": "0"}) == "RELEASE_BUNDLE_HASH_MISMATCH"
    assert sinks.verify_bundle(b"no", good) == "RELEASE_BUNDLE_INVALID"
    sinks.write_json_atomically(str(tmp_path / "x.json"), sinks.result_envelope("c", {"n": 1}))
    assert json.loads((tmp_path / "x.json").read_text())["outputs"] == {"n": 1}
    for name, text in (("live", "old"), ("new", "fresh")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f").write_text(text)
    sinks.promote({str(tmp_path / "live"): str(tmp_path / "new")})
    assert (tmp_path / "live/f").read_text() == "fresh" and not list(tmp_path.glob("*.old"))
    with pytest.raises(OSError):
        sinks.promote({str(tmp_path / "live"): str(tmp_path / "missing")})
    assert (tmp_path / "live/f").read_text() == "fresh"


def test_box_outside_its_page(spark):
    page = g.box(F.lit(0), F.lit(0), F.lit(10), F.lit(10))
    row = spark.range(1).select(g.page_fraction(g.box(F.lit(-5), F.lit(5), F.lit(20), F.lit(6)), page).alias("a"),
                                g.page_fraction(g.box(F.lit(float("nan")), F.lit(5), F.lit(20), F.lit(6)), page).alias("b")).first()
    assert tuple(row.a) == (0.0, 0.5, 1.0, 0.6) and row.b is None


def test_long_chains_and_cycles_of_regions(spark):
    n = 1200
    regions = spark.createDataFrame([("a", i, i) for i in range(n)] + [("b", i, i) for i in range(3)], "doc string, position long, region long")
    edges = spark.createDataFrame([("a", i, i + 1) for i in range(n - 1)] + [("b", 0, 1), ("b", 1, 2), ("b", 2, 0)], "doc string, before long, after long")
    rows = matching.topological_orders(regions, edges).collect()
    assert [r.region for r in sorted(rows, key=lambda r: r.position)] == list(range(n)) and {r.doc for r in rows} == {"a"}


def test_topological_orders_are_the_first_of_all():
    import itertools

    for edges in ([], [(0, 3)], [(3, 0), (2, 1)], [(0, 1), (2, 3)], [(1, 0), (0, 2), (3, 2)]):
        want = [p for p in itertools.permutations(range(4)) if all(p.index(x) < p.index(y) for x, y in edges)][:5]
        got: dict = {}
        for _, rank, _, region in matching._orders_of("d", [0, 1, 2, 3], edges, 5):
            got.setdefault(rank, []).append(region)
        assert [tuple(got[k]) for k in sorted(got)] == want


def test_slots_are_never_shared(spark):
    from fathom.operators import sequences

    rows = [(1, i, w) for i, w in enumerate([None, 2, None, 2, 0, None, 5])] + [(2, i, None) for i in range(3)]
    got = sequences.next_free(spark.createDataFrame(rows, "k long, i long, w long"), ["k"], "w", "i").collect()
    for k in (1, 2):
        slots = [r.slot for r in got if r.k == k]
        assert len(set(slots)) == len(slots)
    assert {r.i: r.slot for r in got if r.k == 1 and r.i in (1, 4, 6)} == {1: 2, 4: 0, 6: 5}


def test_a_span_in_no_cell_rules_its_table_out(spark):
    from fathom.operators import spatial

    box = "struct<left:double,bottom:double,right:double,top:double>"
    spans = spark.createDataFrame([(1, 0, 10, (0.1, 0.1, 0.2, 0.2)), (1, 0, 11, (0.8, 0.8, 0.9, 0.9)), (1, 1, 12, (0.1, 0.1, 0.2, 0.2))], f"page int, tab int, span int, s {box}")
    cells = spark.createDataFrame([(1, 5, (0.0, 0.0, 0.5, 0.5))], f"page int, cell int, c {box}")
    got = {r.tab: (r.accepted, r.spans) for r in spatial.assign_exactly_once(spans, cells, ["page"], "span", "tab", "cell", "s", "c").collect()}
    assert got == {0: (False, 2), 1: (True, 1)}


def test_layout_only_white_space(spark):
    from fathom.operators import audits

    rows = [("d", 1, " ", "x"), ("d", 2, "a", "x"), ("d", 3, "\u3000\t", "x"), ("d", 4, "", "x"), ("d", 5, None, "x")]
    got = audits.layout_only(spark.createDataFrame(rows, "doc string, atom long, text string, decision_id string")).collect()
    assert [(r.atom, r.outcome) for r in sorted(got)] == [(1, "layout_only"), (3, "layout_only")]


def test_declared_tables_win_and_lose_no_text(spark):
    from fathom.operators import native_tables as n

    cell = "start_row int, spans array<string>"
    tables = spark.createDataFrame(
        [("a", 1, 1, 1, [(0, ["s1", "s2"])]),   # overlaps the next: one place
         ("a", 2, 1, 1, [(0, ["s2", "s3"])]),
         ("a", 3, 1, 1, [(0, ["s5"])]),          # agreed
         ("a", 9, 1, 1, [(0, [])]),              # blank, without a block
         ("b", 1, 1, 1, [(0, ["s0", "s2"])])],   # other text between
        f"doc string, table long, row_count int, column_count int, cells array<struct<{cell}>>")
    blocks = spark.createDataFrame(
        [("a", 0, "paragraph", None, None, None, ["s0", "s1"]), ("a", 1, "table", 1, 1, [(0, ["s2", "s3"])], []),
         ("a", 2, "table", 1, 1, [(0, ["s5"])], []), ("a", 3, "paragraph", None, None, None, ["s4"]),
         ("b", 0, "table", 1, 1, [(0, ["s0", "s2"])], [])],
        f"doc string, order long, kind string, row_count int, column_count int, cells array<struct<{cell}>>, spans array<string>")
    spans = spark.createDataFrame([(d, f"s{i}", 10 * i) for d, k in (("a", 6), ("b", 3), ("c", 1)) for i in range(k)], "doc string, span string, ordinal long")
    excluded = spark.createDataFrame([("a", "s3"), ("a", "s4"), ("c", "s0"), ("b", "s1")], "doc string, span string")
    out = n.enforce(tables, blocks, spans, excluded)
    got = sorted((r.doc, r.order, r.kind, r.spans) for r in out.blocks.collect())
    assert got == [("a", 0, "lossless", ["s1", "s2", "s3"]), ("a", 1, "paragraph", ["s4"]), ("a", 2, "table", ["s5"]), ("a", 3, "table", []),
                   ("b", 0, "lossless", ["s0", "s1", "s2"])]
    assert sorted((r.doc, r.span) for r in out.excluded.collect()) == [("a", "s4"), ("c", "s0")]
    assert [(r.doc, r.span) for r in out.leftover.collect()] == [("a", "s0")]
    none = n.enforce(tables.limit(0), blocks, spans, excluded)
    assert none.blocks.count() == 5 and none.excluded.count() == 4


def test_reconstruction_draws_hinted_tables(spark):
    rows = [(1, 0.1, 0.85, "A plain sentence that comes first."), (1, 0.1, 0.70, "name"), (1, 0.5, 0.70, "size"), (1, 0.1, 0.66, "bolt"), (1, 0.5, 0.66, "12"),
            (1, 0.1, 0.62, "nut"), (1, 0.1, 0.4, "Another sentence that ends it.")]
    box = "struct<left:double,bottom:double,right:double,top:double>"
    boxes = spark.createDataFrame([("d", 1, 1, (0.05, 0.58, 0.9, 0.72))], f"doc string, page int, hint_order int, box {box}")
    r = reconstruct.reconstruct(atoms(spark, *rows), table_boxes=boxes)
    got = r.markdown.first()["markdown"].replace("\\", "")
    assert got == ("A plain sentence that comes first.\n\n| name | size |\n| --- | --- |\n| bolt | 12 |\n| nut |  |\n\n"
                   "Another sentence that ends it.\n")
    c = r.coverage.first()
    assert (c.unmatched, c.duplicated, c.unknown) == (0, 0, 0)


def test_proven_tables_need_all_their_characters(spark):
    from fathom.operators import tables

    box = "struct<left:double,bottom:double,right:double,top:double>"
    chars, hints = [], []
    for doc, text, hint in (("same", "ab", "b a"), ("other", "ab", "ac"), ("short", "ab", "a"), ("outside", "ab", "ab")):
        for i, c in enumerate(text):
            left = 0.9 if doc == "outside" and i else 0.1 + 0.02 * i
            chars.append((doc, 1, i, c, (left, 0.5, left + 0.01, 0.52)))
        hints.append((doc, 1, 0, 0, 1, 0, 1, (0.05, 0.4, 0.5, 0.6), hint))
        hints.append((doc, 1, 1, 0, 1, 1, 2, None, ""))
    a = spark.createDataFrame(chars, f"doc string, block long, ordinal long, text string, box {box}")
    h = spark.createDataFrame(hints, f"doc string, block long, cell int, start_row int, end_row int, start_column int, end_column int, box {box}, text string")
    assert [(r.doc, r.score) for r in tables.proven_tables(a, h).collect()] == [("same", 1.0)]


def test_model_pieces_make_up_the_model(spark):
    products = spark.createDataFrame([(1, "P", 2, "a \"d\""), (2, None, 1, ""), (3, "Q", 1, None)], "product_id long, name string, version int, description string")
    tables = spark.createDataFrame([(1, f"t{i}", i, f"d{i}", "s", "" if i % 2 else "x\ny") for i in (3, 1, 2)] + [(2, "t9", 1, "d9", None, None), (7, "t0", 1, "d", "s", "")],
                                   "product_id long, table_id string, version int, dataset string, source string, description string")
    cols = spark.createDataFrame([("t1", f"c{i}", i, f"n{i}", "INT", True, i == 2, "é" if i else "") for i in (2, 0, 1)] + [("t9", "c", 1, "n", "INT", False, False, "")],
                                 "table_id string, column_id string, ordinal int, name string, data_type string, nullable boolean, primary_key boolean, description string")
    rel = spark.createDataFrame([(1, f"r{i}", "n", "d1", "d2", "a", "b") for i in (2, 1)],
                                "product_id long, relationship_id string, name string, from_dataset string, to_dataset string, from_column string, to_column string")
    met = spark.createDataFrame([(3, "m1", "n", "COUNT(*)", "d")], "product_id long, metric_id string, name string, expression string, description string")
    whole = {r.product_id: r.model for r in model.compile_models(products, tables, cols, rel, met).collect()}
    pieces = model.model_pieces(products, tables, cols, rel, met).collect()
    assert len(pieces) == 6 + 4 + 2 + 1
    assert {p: "".join(r.text for r in sorted(pieces, key=lambda r: (r.section, r.position)) if r.product_id == p) for p in whole} == whole
    assert all(json.loads(text)["version"] for text in whole.values())


def test_changesets_of_many_members_are_joined_by_key(spark):
    maps = spark.createDataFrame([(t, p) for t in (1, 2) for p in (1, 2)] + [(3, 1)], "table_id long, product_id long")
    changes = spark.createDataFrame([(1, 1, 10, 5), (1, 2, 10, 0), (2, 2, 10, 5), (1, 1, None, 5), (2, 1, 99, 5), (1, 1, 11, 1), (1, 3, None, 1), (1, 2, 12, 3)],
                                    "product_id long, table_id long, changeset_id long, pr_number int")
    sets = spark.createDataFrame([(10, [1, 1, 5], [1]), (11, [1], None), (12, None, [1])], "changeset_id long, table_ids array<long>, required_product_ids array<long>")
    found = registry.shared_table_findings(changes, maps, sets)
    assert sorted(map(tuple, found.collect())) == [
        (1, 1, "SHARED_TABLE_CHANGESET_REQUIRED"), (1, 2, "CHANGESET_NOT_FOUND"), (1, 2, "CHANGESET_PR_NUMBER_REQUIRED"), (1, 2, "CHANGESET_TABLE_NOT_INCLUDED"),
        (2, 1, "CHANGESET_NOT_FOUND"), (2, 2, "CHANGESET_PRODUCT_NOT_REQUIRED"), (2, 2, "CHANGESET_TABLE_NOT_INCLUDED")]
    assert "array_contains" not in found._jdf.queryExecution().optimizedPlan().toString()


def _every_run(groups, hints):
    """match_groups by trying every run."""
    rows, out, cursor = sorted(groups, key=lambda r: r["position"]), [], 0
    for h in sorted(hints, key=lambda r: r["position"]):
        best = None
        for first in range(cursor, len(rows)):
            for last in range(first, len(rows)):
                kind = rows[last]["kind"]
                if kind in ("table", "alt_text", "text_box") or (kind == "caption" and h["kind"] != "paragraph"):
                    break
                run = rows[first:last + 1]
                if len({r["page"] for r in run}) > 1:
                    break
                if run[0]["page"] != h["page"]:
                    continue
                boxes = [[r[s] for s in ("left", "bottom", "right", "top")] for r in run if r["left"] is not None]
                box = (min(b[0] for b in boxes), min(b[1] for b in boxes), max(b[2] for b in boxes), max(b[3] for b in boxes)) if boxes else None
                hint_box = None if h["left"] is None else (h["left"], h["bottom"], h["right"], h["top"])
                score = matching.match_score("".join(r["text"] for r in run), h["text"], rows[first]["position"], h["position"], box, hint_box)
                if score is not None and score >= matching.ACCEPT and (best is None or (-score, first, last) < best):
                    best = (-score, first, last)
        if best:
            out.append((h["position"], rows[best[1]]["position"], rows[best[2]]["position"], -best[0]))
            cursor = best[2] + 1
    return out


def test_bounds_lose_no_run():
    import random

    import pandas as pd

    rng, matched = random.Random(5), 0
    pieces = ["ab", "ab c", "é", "́x", "e", "가", "ᄀ", "ᅡ", "ᆨn", "", "Straße", "STRASSE", "long text of it", " b"]
    for _ in range(800):
        def row(i, pages):
            at = rng.randrange(8) / 8
            box = (None,) * 4 if rng.random() < 0.2 else (0.0, at, 1.0, at + rng.choice([0.0, 0.125, 0.25]))
            return {"doc": "d", "position": i, "page": rng.randrange(pages), "kind": rng.choice(["paragraph"] * 8 + ["caption", "table"]),
                    "text": "".join(rng.choices(pieces, k=rng.randrange(1, 3))), **dict(zip(("left", "bottom", "right", "top"), box, strict=True))}

        pages = rng.choice([1, 1, 2])
        groups, hints = [row(i, pages) for i in range(rng.randrange(1, 8))], [row(i, pages) for i in range(rng.randrange(1, 5))]
        for h in hints:
            if rng.random() < 0.7:
                at = rng.randrange(len(groups))
                h["text"] = "".join(g["text"] for g in groups[at:at + rng.randrange(1, 4)]) + rng.choice(["", "", "x"])
        got = matching._match_document(("d",), pd.DataFrame(groups), pd.DataFrame(hints))
        want = _every_run(groups, hints)
        assert [tuple(r[1:]) for r in got.itertuples(index=False)] == want
        matched += len(want)
    assert matched > 300


def test_equal_texts_are_found_without_trying_every_run():
    import time

    import pandas as pd

    rows = pd.DataFrame([("d", i, 1, "paragraph", f"{i}:" + "some words of a turn, " * 20, 0.0, 1 - i * 0.02, 1.0, 1.015 - i * 0.02) for i in range(400)],
                        columns=["doc", "position", "page", "kind", "text", "left", "bottom", "right", "top"])
    began = time.process_time()
    got = matching._match_document(("d",), rows, rows)
    assert got["first"].tolist() == list(range(400)) and (got["score"] == 1.0).all() and time.process_time() - began < 20


def _islands_by_definition(atoms):
    """(ordinal, line) of one region's atoms: its chunks, and where those without extent go."""
    import statistics

    atoms = sorted(atoms, key=lambda a: a[0])
    widths = [b[2] - b[0] for _, kind, b in atoms if kind == "character" and b and b[2] > b[0]]
    typical, chunk, last, before, at, solid = statistics.median(widths) if widths else 0.0, 0, None, None, [], set()
    for i, (_, kind, b) in enumerate(atoms):
        opens = before == "line_break"
        if last and kind != "line_break":
            least = min(last[3] - last[1], b[3] - b[1]) if b else 0
            same = least <= 0 or max(0.0, min(last[3], b[3]) - max(last[1], b[1])) / least >= 0.35
            opens = opens or not same or bool(typical > 0 and b and b[0] - last[2] > typical * layout.GAP_WIDTHS)
        chunk += bool(opens and i)
        at.append(chunk)
        if b and b[2] > b[0] and b[3] > b[1]:
            solid.add(chunk)
        last = None if kind == "line_break" else b if kind == "character" and b else last
        before = kind
    place = [max((c for c in solid if c <= x), default=min(solid, default=None)) for x in at]
    return sorted((a[0], p) for a, p in zip(atoms, place, strict=True))


def test_lines_are_as_defined_and_sorted_twice(spark):
    import random

    rng, rows = random.Random(3), []
    for region in range(60):
        x = y = 0.0
        for ordinal in range(rng.randrange(1, 25)):
            kind = rng.choice(["character"] * 6 + ["space", "line_break"])
            x, y = x + rng.choice([1.0, 1.0, 1.0, 12.0]), y + rng.choice([0.0] * 6 + [3.0])
            box = None if rng.random() < 0.15 else (x, y, x + rng.choice([0.0, 1.0, 1.0]), y + rng.choice([0.0, 2.0, 2.0]))
            rows.append(("d", 1, region, ordinal, kind, "x", box))
    df = spark.createDataFrame(rows, "doc string, page int, region long, ordinal long, kind string, text string, box struct<left:double,bottom:double,right:double,top:double>")
    found = layout.line_islands(df)
    got: dict = {}
    for r in found.collect():
        got.setdefault(r.region, []).append((r.ordinal, r.line))
    assert {k: sorted(v) for k, v in got.items()} == {k: _islands_by_definition([r[3:5] + r[6:] for r in rows if r[2] == k]) for k in got}
    plan = layout.line_islands(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 2 and plan.count("Exchange") == 1


def test_reconstruction_reads_characters_once(spark):
    r = reconstruct.reconstruct(atoms(spark, (1, 0.1, 0.8, "one two"), (1, 0.1, 0.6, "three")))
    for df in (r.regions, r.markdown, r.coverage):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "ordinal" not in plan and "fathom_marked" in df._jdf.queryExecution().executedPlan().toString()


def test_pages_are_dealt_to_all_tasks(spark):
    df = layout.with_columns(layout.lines(atoms(spark, *[(page, 0.1, 0.8, "text") for page in range(1, 40)])))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan  # its partitions aren't put together again
    assert df.count() == 39
