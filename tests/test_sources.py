"""Readers, streams and registry files."""

from __future__ import annotations

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from fathom.sources import config, forms, html, office, registry_json
from fathom.streaming import ingest

S = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def package(**parts: str) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name.replace("__", "/") + ".xml", text)
    return out.getvalue()


def workbook(rows: dict[int, list]) -> bytes:
    def cell(r, i, v):
        return f'<c r="{chr(65 + i)}{r}" t="inlineStr"><is><t>{v}</t></is></c>'

    body = "".join(f'<row r="{r}">{"".join(cell(r, i, v) for i, v in enumerate(vs) if v is not None)}</row>' for r, vs in rows.items())
    return package(xl__workbook=f'<workbook {S}><sheets><sheet name="one" sheetId="1"/></sheets></workbook>',
                   xl__worksheets__sheet1=f"<worksheet {S}><sheetData>{body}</sheetData></worksheet>")


def test_flat_dictionary(spark):
    head = ["Platform", "Catalog", "Schema", "Table", "Column", "Logical Name", "Data Type", "Nullable", "PK", "FK Table", "FK Column", "Description"]
    book = workbook({1: head, 2: ["BigQuery", "analytics", "sales", "orders", "order_id", "Order ID", "INT64", "N", "Y", None, None, "Unique"],
                     3: ["BigQuery", "analytics", "sales", "orders", "customer_id", None, "INT64", "N", "N", "customers", "customer_id", None],
                     4: ["BigQuery", "analytics", "sales", "orders", "half", None, "INT64", "N", "N", "customers", None, None]})
    cells = office.read_cells(spark.createDataFrame([("a", book)], "name string, content binary"))
    rows = office.flat_dictionary(cells).orderBy("row").collect()
    assert [(r.locator, r.column, r.primary_key, r.foreign_key, r.code, r.ordinal) for r in rows] == [
        ("bigquery|analytics|sales|orders", "order_id", True, None, None, 1),
        ("bigquery|analytics|sales|orders", "customer_id", False, "customers.customer_id", None, 2),
        ("bigquery|analytics|sales|orders", "half", False, None, "INCOMPLETE_FOREIGN_KEY", 3)]


def test_form_dictionary_stops_at_the_first_blank_row(spark):
    book = workbook({3: [None, "저장 플랫폼 및 세부 위치", "ws.marketing"], 4: [None, "테이블 명", "Campaign"],
                     13: [None, "컬럼명", "컬럼 설명(한글)", "TYPE", "KEY 여부", "NULL 허용"], 14: [None, "id", "key", "STRING", "PK, FK", "N"],
                     15: [None, "name", None, "STRING", None, "Y"], 18: [None, "residue", "x", "STRING", "PK", "N"]})
    cells = office.read_cells(spark.createDataFrame([("a", book)], "name string, content binary"))
    rows = office.form_dictionary(cells).orderBy("row").collect()
    assert [(r.locator, r.column, r.nullable, r.primary_key, r.ordinal) for r in rows] == [
        ("unspecified|ws|marketing|campaign", "id", False, True, 1), ("unspecified|ws|marketing|campaign", "name", True, False, 2)]


def test_broken_and_swollen_packages_are_rows(spark):
    bomb = package(xl__workbook="x" * 5_000_000)
    df = spark.createDataFrame([("broken", b"no zip"), ("bomb", bomb)], "name string, content binary")
    assert {r.name: r.code for r in office.read_cells(df).collect()} == {"broken": "ATTACHMENT_CONTAINER_MISMATCH", "bomb": "ATTACHMENT_ZIP_BOMB"}
    assert {r.name: r.code for r in office.read_blocks(df).collect()} == {"broken": "SEMANTIC_DOCX_UNREADABLE", "bomb": "DOCX_PART_COMPRESSION_RATIO_EXCEEDED"}


def test_document_blocks(spark):
    def p(text, props=""):
        return f"<w:p><w:pPr>{props}</w:pPr><w:r><w:t>{text}</w:t></w:r></w:p>"

    def tc(text, props=""):
        return f"<w:tc><w:tcPr>{props}</w:tcPr>{p(text)}</w:tc>"

    table = (f"<w:tbl><w:tr>{tc('a', '<w:gridSpan w:val=%s2%s/>' % (chr(34), chr(34)))}{tc('v', '<w:vMerge w:val=%srestart%s/>' % (chr(34), chr(34)))}</w:tr>"
             f"<w:tr>{tc('b')}{tc('c')}{tc('', '<w:vMerge/>')}</w:tr></w:tbl>")
    body = (p("Title", '<w:pStyle w:val="Heading1"/>') + p("item", '<w:numPr><w:ilvl w:val="1"/><w:numId w:val="3"/></w:numPr>')
            + f"<w:ins>{p('kept')}</w:ins><w:del>{p('gone')}</w:del>" + table)
    doc = package(word__document=f"<w:document {W}><w:body>{body}</w:body></w:document>")
    rows = office.read_blocks(spark.createDataFrame([("d", doc)], "name string, content binary")).orderBy("ordinal").collect()
    assert [(r.kind, r.level, r.text) for r in rows if r.kind != "cell"] == [("heading", 1, "Title"), ("list_item", 1, "item"), ("paragraph", None, "kept")]
    assert [(r.start_row, r.end_row, r.start_column, r.end_column, r.text) for r in rows if r.kind == "cell"] == [
        (0, 1, 0, 2, "a"), (0, 2, 2, 3, "v"), (1, 2, 0, 1, "b"), (1, 2, 1, 2, "c")]


def test_text_boxes_and_alternative_texts(spark):
    box = "<w:txbxContent><w:p><w:r><w:t>inside</w:t></w:r></w:p></w:txbxContent>"
    body = f'<w:p><w:r><w:t>outside</w:t><w:tab/><w:t>on</w:t></w:r><w:r><w:drawing><wp:docPr descr="a chart"/>{box}</w:drawing></w:r></w:p>'
    doc = package(word__document=f'<w:document {W} xmlns:wp="http://x/wp"><w:body>{body}</w:body></w:document>')
    rows = office.read_blocks(spark.createDataFrame([("d", doc)], "name string, content binary")).orderBy("ordinal").collect()
    assert [(r.kind, r.text) for r in rows] == [("paragraph", "outside\ton"), ("text_box", "inside"), ("alt_text", "a chart")]


def test_configuration(spark, tmp_path):
    yaml = pytest.importorskip("yaml")
    path = tmp_path / "product.yaml"
    path.write_text(yaml.safe_dump({"product_key": "k", "operation": "create", "tables": [{"locator": "A|b|c|d"}]}))
    row = config.read_config(spark, str(path)).first()
    assert (row.product_key, row.operation, row.tables[0].locator) == ("k", "create", "a|b|c|d")
    path.write_text(yaml.safe_dump({"product_key": "k", "operation": "retire"}))
    with pytest.raises(ValueError, match="RETIRE_NOT_SUPPORTED"):
        config.read_config(spark, str(path))


def test_html_items_and_generated_labels(spark):
    page = "<html><head><style>x</style></head><body><h1>T</h1><p>a <b>b</b></p><p>AI generated</p><p>gone</p><ul><li>one</li></ul></body></html>"
    items = html.html_items(spark.createDataFrame([(1, page), (2, None)], "page_id long, html string"))
    assert [(r.tag, r.text) for r in items.orderBy("item").collect()] == [("h1", "T"), ("p", "a b"), ("p", "AI generated"), ("p", "gone"), ("li", "one")]
    assert [r.text for r in html.without_generated(items).orderBy("item").collect()] == ["T", "a b", "one"]
    assert html.markdown(html.without_generated(items)).first()["markdown"] == "# T\n\na b\n\n- one"


def test_forms(spark):
    body = "### Key\r\nabc\r\n\r\n### Notes\n_No response_\n### Key\nagain\n### File\n[a.docx](https://x.org/f)"
    fields = forms.form_fields(spark.createDataFrame([(1, body), (2, None)], "form_id long, body string"))
    assert [(r.heading, r.value) for r in fields.orderBy("position").collect()] == [("Key", "abc"), ("Notes", ""), ("Key", "again"), ("File", "[a.docx](https://x.org/f)")]
    assert {(r.code, r.heading) for r in forms.form_findings(fields, ["Key", "Notes"]).collect()} == {("DUPLICATE_ISSUE_FIELD", "Key"), ("MISSING_ISSUE_FIELD", "Notes")}
    assert forms.attachments(fields).first()["url"] == "https://x.org/f"


def test_registry_files(spark, tmp_path):
    (tmp_path / "products").mkdir()
    (tmp_path / "products/a.json").write_text(json.dumps({"product_id": "prd_1", "product_key": "k", "version": 2, "status": "ACTIVE", "aliases": ["x"], "strange": 1}))
    assert registry_json.read_registry(spark, str(tmp_path), "products").first()["aliases"] == ["x"]
    assert [r.key for r in registry_json.unknown_keys(spark, str(tmp_path), "products").collect()] == ["strange"]


def test_streams_drain_once(spark, tmp_path):
    spark.range(10).select("id", F.lit(1).alias("v")).write.parquet(str(tmp_path / "in"))
    seen = []
    for _ in range(2):
        stream = ingest.stream_parquet(spark, str(tmp_path / "in"), "id long, v int")
        ingest.drain(stream, lambda batch, i: seen.append(batch.count()), str(tmp_path / "state")).awaitTermination()
    assert sum(seen) == 10
