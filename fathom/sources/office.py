"""Workbooks and word-processor packages, read from their parts with the standard library.

A reader takes binary rows (name, content) and runs as ``mapInPandas``: each package is
opened where its bytes are. Failures are rows with a code, not exceptions.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathom.session import ship_package

from fathom.functions import text as t

MOST_PART, MOST_TOTAL, MOST_RATIO = 16 * 1024 * 1024, 32 * 1024 * 1024, 100
SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
CELL_SCHEMA = "name string, sheet string, row int, col int, value string, code string"
BLOCK_SCHEMA = ("name string, ordinal int, kind string, level int, text string, table int, start_row int, end_row int, "
                "start_column int, end_column int, code string")

# Headers of the flat dictionary layout and labels of the form layout.
FLAT_HEADERS = ("platform", "catalog", "schema", "table", "column", "data_type", "nullable", "pk")
FORM_LABELS = {"column": "컬럼명", "description": "컬럼_설명", "data_type": "type", "key": "key_여부", "nullable": "null_허용"}
FORM_METADATA = {"저장_플랫폼_및_세부_위치": "location", "테이블_명": "table", "테이블_설명": "description"}


DOCUMENT_CODES = {"INVALID": "SEMANTIC_DOCX_UNREADABLE", "PART_TOO_LARGE": "DOCX_PART_TOO_LARGE",
                  "RATIO": "DOCX_PART_COMPRESSION_RATIO_EXCEEDED", "TOTAL_TOO_LARGE": "DOCX_TOTAL_TOO_LARGE"}
WORKBOOK_CODES = {"INVALID": "ATTACHMENT_CONTAINER_MISMATCH", "PART_TOO_LARGE": "ATTACHMENT_TOO_LARGE",
                  "RATIO": "ATTACHMENT_ZIP_BOMB", "TOTAL_TOO_LARGE": "ATTACHMENT_TOO_LARGE"}


class PackageError(ValueError):
    """A package that must not be opened; its text says why."""


def _code(e: Exception, codes: dict[str, str]) -> str:
    return codes[str(e) if isinstance(e, PackageError) else "INVALID"]


def package_parts(content: bytes) -> zipfile.ZipFile:
    """The package, if no part is suspiciously large."""
    try:
        package = zipfile.ZipFile(io.BytesIO(content))
    except zipfile.BadZipFile as e:
        raise PackageError("INVALID") from e
    total = 0
    for info in package.infolist():
        total += info.file_size
        if info.file_size > MOST_PART:
            raise PackageError("PART_TOO_LARGE")
        if info.file_size > MOST_RATIO * max(1, info.compress_size):
            raise PackageError("RATIO")
        if total > MOST_TOTAL:
            raise PackageError("TOTAL_TOO_LARGE")
    return package


def _column_number(reference: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n


def sheet_cells(content: bytes) -> Iterator[tuple[str, int, int, str]]:
    """(sheet, row, column, value) of every non-empty cell; rows and columns from 1."""
    package = package_parts(content)
    names = package.namelist()
    strings = []
    if "xl/sharedStrings.xml" in names:
        for si in ElementTree.fromstring(package.read("xl/sharedStrings.xml")).iter(SHEET + "si"):
            strings.append("".join(x.text or "" for x in si.iter(SHEET + "t")))
    book = ElementTree.fromstring(package.read("xl/workbook.xml"))
    titles = [s.get("name") for s in book.iter(SHEET + "sheet")]
    sheets = sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n)[0]))
    for title, part in zip(titles, sheets, strict=False):
        for c in ElementTree.fromstring(package.read(part)).iter(SHEET + "c"):
            kind, v = c.get("t"), c.find(SHEET + "v")
            if kind == "inlineStr":
                value = "".join(x.text or "" for x in c.iter(SHEET + "t"))
            elif v is None or v.text is None:
                continue
            else:
                value = strings[int(v.text)] if kind == "s" else v.text
            if value.strip():
                ref = c.get("r")
                yield title, int(re.search(r"\d+", ref)[0]), _column_number(ref), value


def read_cells(files: DataFrame) -> DataFrame:
    """Cells of workbooks (name, content)."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for name, content in zip(frame["name"], frame["content"], strict=True):
                try:
                    rows += [(name, *cell, None) for cell in sheet_cells(bytes(content))]
                except (PackageError, KeyError, ElementTree.ParseError) as e:
                    rows.append((name, None, None, None, None, _code(e, WORKBOOK_CODES)))
            yield pd.DataFrame(rows, columns=["name", "sheet", "row", "col", "value", "code"]).astype(
                {"row": "Int32", "col": "Int32"})

    ship_package(files.sparkSession)
    return files.select("name", "content").mapInPandas(read, CELL_SCHEMA)


def flat_dictionary(cells: DataFrame) -> DataFrame:
    """Column rows of sheets in the flat layout: header in row 1, a column a row.

    Returns name, sheet, row, locator, ordinal, column, logical_name, data_type, nullable,
    primary_key, foreign_key, description, code. Sheets without all required headers give no
    rows; a foreign key with one half, or a missing value, is a code.
    """
    heads = cells.where("row = 1").select("name", "sheet", "col", t.normalize_header(F.col("value")).alias("header"))
    sound = heads.groupBy("name", "sheet").agg(F.collect_set("header").alias("h")).where(
        F.size(F.array_except(F.array(*[F.lit(h) for h in FLAT_HEADERS]), F.col("h"))) == 0).select("name", "sheet")
    body = cells.where("row > 1").join(heads, ["name", "sheet", "col"]).join(sound, ["name", "sheet"], "left_semi")
    r = body.groupBy("name", "sheet", "row").agg(F.map_from_entries(F.collect_list(F.struct("header", t.trimmed(F.col("value")).alias("v")))).alias("m"))

    def at(h):
        return F.try_element_at(F.col("m"), F.lit(h))

    fk_t, fk_c = at("fk_table"), at("fk_column")
    missing = F.lit(False)
    for h in FLAT_HEADERS:
        missing = missing | at(h).isNull()
    code = (F.when(missing, "MISSING_DICTIONARY_VALUE").when(fk_t.isNull() != fk_c.isNull(), "INCOMPLETE_FOREIGN_KEY")
            .when(t.as_boolean(at("nullable")).isNull() | t.as_boolean(at("pk")).isNull(), "INVALID_BOOLEAN_VALUE"))
    w = Window.partitionBy("name", "locator").orderBy("sheet", "row")
    out = r.select("name", "sheet", "row", F.lower(F.concat_ws("|", at("platform"), at("catalog"), at("schema"), at("table"))).alias("locator"),
                   at("column").alias("column"), at("logical_name").alias("logical_name"), at("data_type").alias("data_type"),
                   t.as_boolean(at("nullable")).alias("nullable"), t.as_boolean(at("pk")).alias("primary_key"),
                   F.when(fk_t.isNotNull() & fk_c.isNotNull(), F.concat_ws(".", fk_t, fk_c)).alias("foreign_key"),
                   at("description").alias("description"), code.alias("code"))
    return out.withColumn("ordinal", F.row_number().over(w))


def form_dictionary(cells: DataFrame, deepest: int = 50) -> DataFrame:
    """Column rows of sheets in the form layout: metadata above a labelled header row.

    The header is the first of the top ``deepest`` rows with all five labels (a label of a
    description may go on after its word). Rows end at the first blank one; what lies below
    is ignored. Returns name, sheet, row, locator, ordinal, column, data_type, nullable,
    primary_key and description; the layout never yields a foreign key.
    """
    c = cells.where("row IS NOT NULL").withColumn("header", t.normalize_header(F.col("value")))
    field = None
    for name, label in FORM_LABELS.items():
        hit = F.col("header").startswith(label) if name == "description" else F.col("header") == label
        field = F.when(hit, name) if field is None else field.when(hit, name)
    labelled = c.where(F.col("row") <= deepest).withColumn("field", field).where("field IS NOT NULL")
    head = labelled.groupBy("name", "sheet", "row").agg(F.count_distinct("field").alias("n")).where(
        F.col("n") == len(FORM_LABELS)).groupBy("name", "sheet").agg(F.min("row").alias("head"))
    places = labelled.join(head, ["name", "sheet"]).where("row = head").groupBy("name", "sheet", "head", "field").agg(F.max("col").alias("col"))
    body = c.join(places, ["name", "sheet", "col"]).where("row > head").groupBy("name", "sheet", "head", "row").agg(
        F.map_from_entries(F.collect_list(F.struct("field", t.trimmed(F.col("value")).alias("v")))).alias("m"))
    w = Window.partitionBy("name", "sheet").orderBy("row")
    # A blank row has no cells, so the run of adjacent rows from the header on counts.
    body = body.withColumn("ordinal", F.row_number().over(w)).where("row = head + ordinal")
    above = form_metadata(c).join(head, ["name", "sheet"]).where("row < head")
    kinds = F.create_map(*[F.lit(x) for kv in FORM_METADATA.items() for x in kv])
    meta = above.withColumn("kind", kinds[t.normalize_header(F.col("label"))]).where("kind IS NOT NULL").groupBy("name", "sheet").agg(
        F.map_from_entries(F.collect_list(F.struct("kind", "value"))).alias("meta"))

    def at(k):
        return F.try_element_at(F.col("m"), F.lit(k))

    place = t.form_locator(F.try_element_at("meta", F.lit("location")), F.try_element_at("meta", F.lit("table")))
    return body.join(meta, ["name", "sheet"], "left").select(
        "name", "sheet", "row", place.alias("locator"), "ordinal", at("column").alias("column"), at("data_type").alias("data_type"),
        t.as_boolean(at("nullable")).alias("nullable"),
        F.array_contains(F.regexp_extract_all(F.upper(F.coalesce(at("key"), F.lit(""))), F.lit("[A-Z]+"), F.lit(0)), "PK").alias("primary_key"),
        at("description").alias("description"))


def form_metadata(cells: DataFrame) -> DataFrame:
    """(name, sheet, row, label, value): each cell with its right neighbour's value."""
    right = cells.select("name", "sheet", "row", (F.col("col") - 1).alias("col"), F.col("value").alias("right"))
    return cells.join(right, ["name", "sheet", "row", "col"]).select("name", "sheet", "row", F.col("value").alias("label"), F.col("right").alias("value"))


def dictionary_findings(columns: DataFrame, descriptions: DataFrame) -> DataFrame:
    """(locator, code): repeated columns, and tables with several descriptions."""
    twice = columns.groupBy("locator", F.lower("column").alias("c")).count().where("count > 1").select(
        "locator", F.lit("DUPLICATE_DICTIONARY_COLUMN").alias("code")).distinct()
    several = descriptions.groupBy("locator").agg(F.count_distinct("description").alias("n")).where("n > 1").select(
        "locator", F.lit("CONFLICTING_DICTIONARY_TABLE_DESCRIPTION").alias("code"))
    return twice.unionByName(several)


def _paragraph_text(p) -> str:
    """Text of a paragraph's own runs; that of text boxes in it is apart."""
    out = []

    def walk(e):
        if e.tag in (WORD + "txbxContent", WORD + "del", WORD + "moveFrom"):
            return
        if e.tag == WORD + "t":
            out.append(e.text or "")
        elif e.tag == WORD + "tab" and e.get(WORD + "val") is None:
            out.append("\t")
        elif e.tag in (WORD + "br", WORD + "cr"):
            out.append("\n")
        for child in e:
            walk(child)

    walk(p)
    return re.sub("\r\n?", "\n", "".join(out))


def _auxiliary_texts(p) -> Iterator[tuple[str, str]]:
    """(kind, text) of a paragraph's text boxes and alternative texts."""
    for box in p.iter(WORD + "txbxContent"):
        text = "\n".join(_paragraph_text(inner) for inner in box.iter(WORD + "p"))
        if text.strip():
            yield "text_box", text
    seen = set()
    for e in p.iter():
        note = e.get("descr") if e.tag.endswith("}docPr") else None
        if note and note.strip() and note not in seen:
            seen.add(note)
            yield "alt_text", note


def _visible(container) -> Iterator:
    for e in container:
        if e.tag in (WORD + "del", WORD + "moveFrom"):
            continue
        if e.tag in (WORD + "ins", WORD + "moveTo", WORD + "sdt", WORD + "sdtContent", WORD + "customXml"):
            yield from _visible(e)
        else:
            yield e


def _grid(table) -> list[tuple[int, int, int, int, str]]:
    """(start_row, end_row, start_column, end_column, text) of a table's cells, merges resolved."""
    cells, above = [], {}
    for r, tr in enumerate(e for e in _visible(table) if e.tag == WORD + "tr"):
        k, now = 0, {}
        before = tr.find(f"{WORD}trPr/{WORD}gridBefore")
        if before is not None:
            k = int(before.get(WORD + "val"))
        for tc in (e for e in _visible(tr) if e.tag == WORD + "tc"):
            span, merge = tc.find(f"{WORD}tcPr/{WORD}gridSpan"), tc.find(f"{WORD}tcPr/{WORD}vMerge")
            wide = int(span.get(WORD + "val")) if span is not None else 1
            if merge is not None and merge.get(WORD + "val", "continue") == "continue" and k in above:
                cells[above[k]][1] = r + 1
                now[k] = above[k]
            else:
                text = "\n".join(_paragraph_text(p) for p in tc.iter(WORD + "p"))
                cells.append([r, r + 1, k, k + wide, text])
                if merge is not None:
                    now[k] = len(cells) - 1
            k += wide
        above = now
    return [tuple(c) for c in cells]


def document_blocks(content: bytes) -> Iterator[tuple]:
    """(ordinal, kind, level, text, table, grid...) of the visible blocks of a document."""
    package = package_parts(content)
    body = ElementTree.fromstring(package.read("word/document.xml")).find(WORD + "body")
    n = tables = 0
    for e in _visible(body):
        if e.tag == WORD + "p":
            style, listed = e.find(f"{WORD}pPr/{WORD}pStyle"), e.find(f"{WORD}pPr/{WORD}numPr")
            name = style.get(WORD + "val") if style is not None else ""
            level = None
            kind = "caption" if name == "Caption" else "paragraph"
            if listed is not None and (listed.find(WORD + "numId") is None or listed.find(WORD + "numId").get(WORD + "val") != "0"):
                at = listed.find(WORD + "ilvl")
                kind, level = "list_item", int(at.get(WORD + "val")) if at is not None else 0
            elif m := re.fullmatch(r"Heading(\d)", name):
                kind, level = "heading", int(m[1])
            text = _paragraph_text(e)
            if text.strip():
                yield n, kind, level, text, None, None, None, None, None
                n += 1
            for aside, note in _auxiliary_texts(e):
                yield n, aside, None, note, None, None, None, None, None
                n += 1
        elif e.tag == WORD + "tbl":
            for a, b, c, d, text in _grid(e):
                yield n, "cell", None, text, tables, a, b, c, d
                n += 1
            tables += 1


def read_blocks(files: DataFrame) -> DataFrame:
    """Blocks and table cells of word-processor documents (name, content)."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for name, content in zip(frame["name"], frame["content"], strict=True):
                try:
                    rows += [(name, *b, None) for b in document_blocks(bytes(content))]
                except (PackageError, KeyError, ElementTree.ParseError) as e:
                    rows.append((name, *[None] * 9, _code(e, DOCUMENT_CODES)))
            got = pd.DataFrame(rows, columns=[x.split()[0] for x in BLOCK_SCHEMA.split(", ")])
            yield got.astype({c: "Int32" for c in ("ordinal", "level", "table", "start_row", "end_row", "start_column", "end_column")})

    ship_package(files.sparkSession)
    return files.select("name", "content").mapInPandas(read, BLOCK_SCHEMA)


def numbering_formats(numbers: DataFrame, abstract: DataFrame, overrides: DataFrame) -> DataFrame:
    """(num, level, format): the list format of each number and level; overrides win."""
    base = numbers.join(abstract, "abstract").select("num", "level", F.col("format").alias("base"))
    return base.join(overrides.select("num", "level", F.col("format").alias("over")), ["num", "level"], "full_outer").select(
        "num", "level", F.coalesce("over", "base").alias("format"))
