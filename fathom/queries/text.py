"""Text functions over documents, conversations and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions import arrow, ids
from fathom.functions import text as t
from fathom.sources import html

from .base import Registry, table

R = Registry()
QUERIES, ORACLE_SQL = R.queries, R.sql

W = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
LINES = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


def _turns(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", "text")


@R.add(rf"""SELECT doc_id, sha256(array_to_string(list_filter([trim(regexp_replace(x, '[\t\x20\x0b\x0c]+', ' ', 'g')) FOR x IN
  string_split_regex(text, '{LINES}')], lambda x: x <> ''), chr(10))) AS canonical FROM documents""")
def text_canonical_whitespace(spark, sf):
    return _docs(spark, sf).select("doc_id", ids.sha256_hex(t.canonical_whitespace(F.col("text"))).alias("canonical"))


@R.add(rf"""SELECT doc_id, sha256(regexp_replace(regexp_replace(replace(text, ',', ' ,') || ' ( ok )', '[{W}]+([%℃°,:;.!?)}}\]])', '\1', 'g'),
  '([(\{{\[])[{W}]+', '\1', 'g')) AS repaired FROM documents""")
def text_punctuation_rules(spark, sf):
    """Every text, its commas moved off their words first."""
    made = F.concat(F.regexp_replace("text", ",", " ,"), F.lit(" ( ok )"))
    return _docs(spark, sf).select("doc_id", ids.sha256_hex(t.punctuation_rules(made)).alias("repaired"))


@R.add(rf"SELECT doc_id, sha256(regexp_replace(text, '[{W}]+', '', 'g')) AS dense FROM documents")
def text_without_whitespace(spark, sf):
    return _docs(spark, sf).select("doc_id", ids.sha256_hex(t.without_whitespace(F.col("text"))).alias("dense"))


@R.add(rf"""WITH x AS (SELECT p_partkey, replace(p_name, ' ', ' . ') AS v FROM part),
d AS (SELECT *, regexp_replace(v, '[{W}]+', '', 'g') AS dense FROM x)
SELECT p_partkey, CASE WHEN dense <> v AND regexp_full_match(dense, '[A-Za-z_][A-Za-z0-9_]*(?:\.[A-Za-z0-9_]+)+') THEN dense END AS repaired FROM d""")
def text_identifier_repair(spark, sf):
    made = F.regexp_replace("p_name", " ", " . ")
    return table(spark, sf, "part").select("p_partkey", t.qualified_identifier_repair(made).alias("repaired"))


@R.add(rf"""WITH x AS (SELECT conv_id, turn, regexp_replace(text, '^[{W}]+|[{W}]+$', '', 'g') AS v FROM conversations),
m AS (SELECT *, regexp_replace(regexp_replace(v, '[{W}]*\n[{W}]*', chr(1), 'g'), '[{W}]+', chr(2), 'g') AS k FROM x)
SELECT conv_id, turn, array_to_string([CASE WHEN k[i + 1] = chr(1) THEN 'h' WHEN k[i + 1] = chr(2) THEN 's' WHEN k[i] IN (chr(1), chr(2)) THEN ''
  ELSE 'n' END FOR i IN range(1, length(k))], '') AS states FROM m""")
def text_spacing_states(spark, sf):
    return _turns(spark, sf).select("conv_id", "turn", t.spacing_states(F.col("text")).alias("states"))


@R.add(rf"""SELECT conv_id, turn, regexp_replace(regexp_replace(regexp_replace(text, '^[{W}]+|[{W}]+$', '', 'g'), '[{W}]*\n[{W}]*', chr(10), 'g'),
  '[^\S\n]+', ' ', 'g') AS rendered FROM conversations""")
def text_render_spacing(spark, sf):
    text = F.col("text")
    return _turns(spark, sf).select("conv_id", "turn", t.render_spacing(t.without_whitespace(text), t.spacing_states(text)).alias("rendered"))


@R.add("SELECT p_partkey, regexp_replace(lower(trim(replace(p_type, chr(160), ' '))), '[\\s]+', '_', 'g') AS header FROM part")
def text_header_normalize(spark, sf):
    return table(spark, sf, "part").select("p_partkey", t.normalize_header(F.col("p_type")).alias("header"))


@R.add(rf"""WITH x AS (SELECT doc_id, trim(regexp_replace(text, '[{W}]+', ' ', 'g')) AS v FROM documents)
SELECT doc_id, CASE WHEN length(v) >= 8 THEN left(v, 4) || '…' || right(left(v, 24), 4) END AS preview FROM x""")
def text_masked_preview(spark, sf):
    return _docs(spark, sf).select("doc_id", t.masked_preview(F.col("text")).alias("preview"))


@R.add(r"""SELECT conv_id, turn, regexp_replace(text, '([!-/:-@\[-`\{-~])', '\\\1', 'g') AS escaped FROM conversations""")
def text_markdown_escape(spark, sf):
    return _turns(spark, sf).select("conv_id", "turn", t.escape_markdown(F.col("text")).alias("escaped"))


@R.add(r"""WITH e AS (SELECT doc_id, regexp_replace(text, '([!-/:-@\[-`\{-~])', '\\\1', 'g') AS x FROM documents)
SELECT doc_id, sha256(replace(x, chr(10), '  ' || chr(10))) AS inline_hash, sha256(replace(x, chr(10), ' ')) AS cell_hash FROM e""")
def text_escapes(spark, sf):
    text = F.col("text")
    return _docs(spark, sf).select("doc_id", ids.sha256_hex(t.escape_inline(text)).alias("inline_hash"),
                                   ids.sha256_hex(t.escape_table_value(text)).alias("cell_hash"))


@R.add(r"""SELECT doc_id, sha256(replace(replace(text, chr(10), chr(13) || chr(10)), chr(13) || chr(10), chr(10))) AS plain FROM documents""")
def text_line_ends(spark, sf):
    made = F.regexp_replace("text", "\n", "\r\n")
    return _docs(spark, sf).select("doc_id", ids.sha256_hex(t.normalize_line_ends(made)).alias("plain"))


@R.add(rf"""SELECT doc_id,
  len(regexp_extract_all(text, '[A-Za-z][A-Za-z0-9+.-]*://[A-Za-z0-9._~:/?#@!$&''()*+,;=%-]+'))::INT AS urls,
  len(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,63}}'))::INT AS emails,
  len(regexp_extract_all(text, '\d{{4}}[-/.]\d{{1,2}}[-/.]\d{{1,2}}'))::INT AS dates,
  len(regexp_extract_all(text, '\d{{1,2}}:\d{{2}}(?::\d{{2}})?'))::INT AS times,
  len(regexp_extract_all(text, '[A-Za-z][A-Za-z0-9]*(?:_[A-Za-z0-9]+)+'))::INT AS identifiers FROM documents""")
def text_protected_tokens(spark, sf):
    """Counts of the five token patterns that need no look-around."""
    names = ("urls", "emails", "dates", "times", "identifiers")
    return _docs(spark, sf).select("doc_id", *[
        F.size(F.regexp_extract_all("text", F.lit(p), F.lit(0))).alias(n) for n, p in zip(names, t.PROTECTED_TOKENS, strict=False)])


@R.add(None)
def text_all_protected_tokens(spark, sf):
    """All seven patterns; two look around, which the oracle's expressions can't."""
    return _docs(spark, sf).select("doc_id", t.protected_tokens(F.col("text")).alias("tokens"))


OTHER = W.replace(r"\t-\r", r"\t\x0b-\r").replace(r"\x1c-\x20", r"\x1c-\x1f")
Q = r"[A-Za-z_][A-Za-z0-9_]*(?:\.[A-Za-z0-9_]+)+"
LOOSE = [p.replace("[W]", f"[{W}]").replace("'", "''") for p in t.LOOSE_TOKENS]
ANY_LOOSE = " OR ".join(f"len(list_filter(regexp_extract_all(x, '{p}'), lambda m: regexp_matches(m, '[{W}]'))) > 0" for p in LOOSE)


@R.add(rf"""WITH m AS (SELECT conv_id, turn, text || CASE turn % 6 WHEN 0 THEN ' a _b' WHEN 1 THEN chr(10) || 'ab . cd' WHEN 2 THEN ' 12 : 30 ,' WHEN 3
  THEN ' ( x' WHEN 4 THEN chr(9) ELSE '' END AS v FROM conversations),
l AS (SELECT *, string_split_regex(v, '{LINES}') AS ls FROM m)
SELECT conv_id, turn, array_to_string(list_filter([
  CASE WHEN regexp_matches(v, '[{OTHER}]') THEN 'CONTROL_WHITESPACE_SEPARATOR' END,
  CASE WHEN len(list_filter(ls, lambda x: regexp_matches(x, '[{W}]_|_[{W}]'))) > 0 THEN 'IDENTIFIER_WHITESPACE_SPLIT'
   WHEN len(list_filter(ls, lambda x: regexp_replace(x, '[{W}]+', '', 'g') <> regexp_replace(x, '^[{W}]+|[{W}]+$', '', 'g')
     AND regexp_full_match(regexp_replace(x, '[{W}]+', '', 'g'), '{Q}'))) > 0 THEN 'QUALIFIED_IDENTIFIER_WHITESPACE_SPLIT'
   WHEN len(list_filter(ls, lambda x: {ANY_LOOSE})) > 0 THEN 'PROTECTED_TOKEN_WHITESPACE_SPLIT' END,
  CASE WHEN len(list_filter(ls, lambda x: regexp_matches(x, '[{W}]+[%℃°,:;.!?)}}\]]'))) > 0 THEN 'PUNCTUATION_WHITESPACE_BEFORE' END,
  CASE WHEN len(list_filter(ls, lambda x: regexp_matches(x, '[(\{{\[][{W}]+'))) > 0 THEN 'PUNCTUATION_WHITESPACE_AFTER_OPEN' END],
  lambda c: c IS NOT NULL), ',') AS codes FROM l""")
def text_spacing_defects(spark, sf):
    tail = (F.when(F.col("turn") % 6 == 0, " a _b").when(F.col("turn") % 6 == 1, "\nab . cd").when(F.col("turn") % 6 == 2, " 12 : 30 ,")
            .when(F.col("turn") % 6 == 3, " ( x").when(F.col("turn") % 6 == 4, "\t").otherwise(""))
    return _turns(spark, sf).select("conv_id", "turn", F.array_join(t.spacing_defects(F.concat("text", tail)), ",").alias("codes"))


HTML = t.RAW_HTML.replace("'", "''")


@R.add(f"SELECT page_id, regexp_matches(html, '{HTML}') AS html_flag, regexp_matches(url, '{HTML}') AS url_flag FROM pages")
def text_raw_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", t.has_raw_html(F.col("html")).alias("html_flag"), t.has_raw_html(F.col("url")).alias("url_flag"))


@R.add("""WITH x AS (SELECT doc_id, text || CASE doc_id % 5 WHEN 0 THEN ' AKIA' || upper(left(md5(doc_id::VARCHAR), 16))
  WHEN 1 THEN ' -----BEGIN RSA PRIVATE KEY-----' WHEN 2 THEN ' ghp_' || md5(doc_id::VARCHAR) || 'abcdefgh' ELSE '' END AS v FROM documents)
SELECT doc_id, array_to_string(list_filter([
  CASE WHEN regexp_matches(v, 'gh[pousr]_[A-Za-z0-9]{36,255}') THEN 'hosting_token' END,
  CASE WHEN regexp_matches(v, 'sk-[A-Za-z0-9_-]{20,}') THEN 'provider_key' END,
  CASE WHEN regexp_matches(v, 'AKIA[0-9A-Z]{16}') THEN 'access_key' END,
  CASE WHEN regexp_matches(v, '-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----') THEN 'private_key' END], lambda c: c IS NOT NULL), ',') AS kinds FROM x""")
def text_secret_scan(spark, sf):
    """Every document, with a secret appended to three in five."""
    key = F.md5(F.col("doc_id").cast("string"))
    tail = (F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit(" AKIA"), F.upper(F.substring(key, 1, 16))))
            .when(F.col("doc_id") % 5 == 1, " -----BEGIN RSA PRIVATE KEY-----")
            .when(F.col("doc_id") % 5 == 2, F.concat(F.lit(" ghp_"), key, F.lit("abcdefgh"))).otherwise(""))
    return _docs(spark, sf).select("doc_id", F.array_join(t.secret_kinds(F.concat("text", tail)), ",").alias("kinds"))


@R.add("""SELECT conv_id, turn, 'span_' || left(sha256(sha256(text) || ':' || turn::VARCHAR), 16) AS span_id,
  'line_' || left(sha256('["' || conv_id || '","' || turn || '"]'), 16) AS line_id FROM conversations""")
def text_content_ids(spark, sf):
    return _turns(spark, sf).select("conv_id", "turn", ids.span_id(ids.sha256_hex(F.col("text")), F.col("turn")).alias("span_id"),
                                    ids.content_id("line", F.col("conv_id"), F.col("turn")).alias("line_id"))


@R.add("SELECT doc_id, sha256(nfc_normalize(text)) AS nfc_hash FROM documents")
def text_nfc(spark, sf):
    return _docs(spark, sf).select("doc_id", ids.sha256_hex(arrow.nfc("text")).alias("nfc_hash"))


@R.add(None)
def text_comparison_key(spark, sf):
    """NFC, case-folded, without white space; case folding has no SQL function."""
    return _docs(spark, sf).select("doc_id", ids.sha256_hex(arrow.comparison_key("text")).alias("key_hash"))


@R.add(rf"""WITH x AS (SELECT conv_id, turn, text AS a, CASE turn % 4 WHEN 0 THEN text WHEN 1 THEN replace(text, 'th', 'tb')
  WHEN 2 THEN replace(text, ' ', '  ') ELSE text || 'x' END AS b, CASE WHEN turn % 4 = 2 THEN 'spacing' ELSE 'recognition' END AS kind FROM conversations),
c AS (SELECT *, length(regexp_replace(a, '[{W}]+', '', 'g')) AS visible, CASE WHEN length(a) = length(b)
  THEN len(list_filter(range(1, length(a) + 1), lambda i: a[i] <> b[i])) END AS changes FROM x)
SELECT conv_id, turn, CASE WHEN kind = 'spacing' AND (a = b OR regexp_replace(a, '[{W}]+', '', 'g') <> regexp_replace(b, '[{W}]+', '', 'g'))
  THEN 'SEMANTIC_OCR_CORRECTION_SPACING_INVALID' WHEN kind <> 'spacing' AND (a = b OR length(a) <> length(b) OR changes > greatest(1, least(4, (visible * 15) // 100)))
  THEN 'SEMANTIC_OCR_CORRECTION_RECOGNITION_INVALID' END AS code FROM c""")
def text_edit_budget(spark, sf):
    text, turn = F.col("text"), F.col("turn") % 4
    made = (F.when(turn == 0, text).when(turn == 1, F.regexp_replace(text, "th", "tb")).when(turn == 2, F.regexp_replace(text, " ", "  "))
            .otherwise(F.concat(text, F.lit("x"))))
    kind = F.when(turn == 2, "spacing").otherwise("recognition")
    return _turns(spark, sf).select("conv_id", "turn", t.edit_budget_code(text, made, kind).alias("code"))


@R.add(r"""WITH x AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS h FROM pages)
SELECT page_id, CASE WHEN NOT url LIKE 'https://%' THEN 'ATTACHMENT_HTTPS_REQUIRED' WHEN h LIKE '%@%' THEN 'ATTACHMENT_CREDENTIALS_FORBIDDEN'
  WHEN regexp_matches(h, ':[0-9]+$') THEN 'ATTACHMENT_PORT_FORBIDDEN' WHEN h NOT IN ('example.com', 'www.example.com') THEN 'UNTRUSTED_ATTACHMENT_HOST'
  WHEN url LIKE '%?%' OR url LIKE '%#%' THEN 'ATTACHMENT_QUERY_FORBIDDEN' END AS code FROM x""")
def text_url_policy(spark, sf):
    return table(spark, sf, "pages").select("page_id", t.url_policy_code(F.col("url"), ("example.com", "www.example.com")).alias("code"))


@R.add(r"""SELECT p_partkey, least(6, len(list_filter(string_split((p_partkey % 3) || '.' || p_size || CASE WHEN p_size % 2 = 0 THEN '.4.' ELSE '' END, '.'), lambda x: x <> '')) + 1)::INT AS level,
  CASE WHEN p_size % 4 = 0 THEN true WHEN p_size % 4 = 1 THEN false END AS flag, 'unspecified|ws|' || lower(p_brand) || '|' || lower(trim(p_name)) AS locator,
  lower(p_brand) AS schema_part, CASE WHEN p_size % 2 = 0 THEN 'CODE_' || p_size ELSE 'unknown' END AS token,
  CASE WHEN p_size % 2 = 0 THEN '***' ELSE p_name END AS shown FROM part""")
def text_small_parsers(spark, sf):
    """Heading levels, booleans, locators, tokens and redaction of values made from parts."""
    p, size = table(spark, sf, "part"), F.col("p_size")
    number = F.concat_ws(".", (F.col("p_partkey") % 3).cast("string"), size.cast("string"), F.when(size % 2 == 0, "4."))
    word = F.when(size % 4 == 0, " Yes").when(size % 4 == 1, "N").otherwise("perhaps")
    locator = t.form_locator(F.concat(F.lit("WS."), F.col("p_brand")), F.col("p_name"))
    return p.select("p_partkey", t.heading_level(number).alias("level"), t.as_boolean(word).alias("flag"), locator.alias("locator"),
                    t.parse_locator(locator)["schema_name"].alias("schema_part"),
                    t.safe_token(F.concat(F.when(size % 2 == 0, "CODE_").otherwise("code "), size.cast("string"))).alias("token"),
                    t.sensitive_redaction(F.when(size % 2 == 0, "api_key").otherwise("p_name"), F.col("p_name")).alias("shown"))


@R.add(r"""SELECT doc_id, text LIKE '%=%' OR regexp_matches(text, '\b[A-Z][A-Z0-9_]*\s*\(') AS formula FROM documents""")
def text_formula(spark, sf):
    return _docs(spark, sf).select("doc_id", t.looks_like_formula(F.col("text")).alias("formula"))


@R.add("""SELECT event_id, sha256('{"event_type":"' || event_type || '","user_id":' || user_id || '}') AS hash,
  sha256('{"event_type":"' || event_type || '"}') AS schema_hash FROM events""")
def text_canonical_hash(spark, sf):
    """Canonical JSON hashes: sorted keys, volatile and descriptive keys left out."""
    e = table(spark, sf, "events")
    doc = F.to_json(F.struct("user_id", "event_type", F.lit("now").alias("generated_at")))
    plain = F.to_json(F.struct("event_type", F.lit("x").alias("description")))
    return e.select("event_id", arrow.canonical_hash(doc).alias("hash"), arrow.schema_hash(plain).alias("schema_hash"))


@R.add(None)
def text_sequence_ratio(spark, sf):
    """Ratcliff-Obershelp similarity of a turn and the next; no SQL function has it."""
    c = _turns(spark, sf)
    n = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("next"))
    return c.join(n, ["conv_id", "turn"]).select("conv_id", "turn", F.round(arrow.sequence_ratio("text", "next"), 9).alias("ratio"))


@R.add("""SELECT event_id, length(uuid) AS n, uuid[15] AS version, prefix FROM (SELECT event_id,
  '018cc251-f400-7000-8000-000000000000' AS uuid, 'prd_' AS prefix FROM events)""")
def text_uuid7(spark, sf):
    """Version 7 identifiers from a clock and entropy of the row."""
    made = arrow.uuid7((F.lit(1704067200000) + F.col("event_id")).cast("long"), F.unhex(F.substring(F.md5(F.col("event_id").cast("string")), 1, 20)))
    return table(spark, sf, "events").select("event_id", F.length(made).cast("long").alias("n"), F.substring(made, 15, 1).alias("version"),
                                             F.lit("prd_").alias("prefix"))


@R.add(None)
def html_evidence(spark, sf):
    """Text blocks of every page, with bounded excerpts, generated ones left out."""
    items = html.html_items(table(spark, sf, "pages"))
    return html.evidence(html.without_generated(items)).select("page_id", "item", "level", "tag", "excerpt")


@R.add(None)
def html_markdown(spark, sf):
    return html.markdown(html.html_items(table(spark, sf, "pages")))
