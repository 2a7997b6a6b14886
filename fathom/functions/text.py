"""Text functions as Column expressions; nothing here leaves the JVM.

White space is Unicode white space (Java's ``\\s`` knows ASCII only), so patterns spell
the class out. Null in gives null out, unless a function says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters and patterns that decide results.
WHITE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
IDENTIFIER = r"[A-Za-z][A-Za-z0-9]*(?:_[A-Za-z0-9]+)+"
QUALIFIED_IDENTIFIER = r"[A-Za-z_][A-Za-z0-9_]*(?:\.[A-Za-z0-9_]+)+"
CLOSING = r"%℃°,:;.!?)}\]"
OPENING = r"({\["
PROTECTED_TOKENS = (
    r"[A-Za-z][A-Za-z0-9+.-]*://[A-Za-z0-9._~:/?#@!$&'()*+,;=%-]+",
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,63}",
    r"\d{4}[-/.]\d{1,2}[-/.]\d{1,2}",
    r"\d{1,2}:\d{2}(?::\d{2})?",
    IDENTIFIER,
    r"(?<![A-Za-z0-9])(?=[A-Za-z0-9-]{4,})(?=[A-Za-z0-9-]*[A-Za-z])(?=[A-Za-z0-9-]*\d)"
    r"[A-Za-z0-9]+(?:-[A-Za-z0-9]+)*(?![A-Za-z0-9])",
    r"(?i)(?<![A-Za-z0-9])\d+(?:[.,]\d+)?(?:%|℃|°[CF]|kg|mg|g|km|cm|mm|m|ms|s|h|Hz|KB|MB|GB|TB)(?![A-Za-z0-9])",
)
LOOSE_TOKENS = (
    r"[A-Za-z][A-Za-z0-9+.-]*[W]*:[W]*/[W]*/[W]*[A-Za-z0-9._~:/?#@!$&'()*+,;=%-]+",
    r"[A-Za-z0-9._%+-]+[W]*@[W]*[A-Za-z0-9-]+(?:[W]*\.[W]*[A-Za-z0-9-]+)+",
    r"\d{4}[W]*[-/.][W]*\d{1,2}[W]*[-/.][W]*\d{1,2}",
    r"\d{1,2}[W]*:[W]*\d{2}(?:[W]*:[W]*\d{2})?",
)
RAW_HTML = r"(?s)<(?:(?:/?[A-Za-z][A-Za-z0-9-]*(?:\s[^<>]*?)?\s*/?)|(?:!--.*?--)|(?:![A-Z][^<>]*)|(?:\?.*?\?))>"
SENSITIVE_KEY = r"(?i)(?:^|[_-])(?:api[_-]?key|authorization|credential|password|secret|token)(?:$|[_-])"
SECRETS = {
    "hosting_token": r"gh[pousr]_[A-Za-z0-9]{36,255}",
    "provider_key": r"sk-[A-Za-z0-9_-]{20,}",
    "access_key": r"AKIA[0-9A-Z]{16}",
    "private_key": r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----",
}
ASCII_PUNCTUATION = r"!\"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~"


def _lit(pattern: str) -> Column:
    return F.lit(pattern)


def replace(value: Column, pattern: str, by: str) -> Column:
    return F.regexp_replace(value, _lit(pattern), _lit(by))


def trimmed(value: Column) -> Column:
    """Without white space at either end."""
    return replace(value, f"^[{WHITE}]+|[{WHITE}]+$", "")


def without_whitespace(value: Column) -> Column:
    return replace(value, f"[{WHITE}]+", "")


def split_lines(value: Column) -> Column:
    return F.split(value, LINE_END)


def canonical_whitespace(value: Column) -> Column:
    """Runs of blanks become one space, lines are trimmed, empty lines go."""
    lines = F.transform(split_lines(value), lambda x: trimmed(replace(x, r"[\t\x20\x0b\x0c]+", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def punctuation_rules(value: Column) -> Column:
    """No white space before closing or after opening punctuation."""
    closed = replace(value, f"[{WHITE}]+([{CLOSING}])", "$1")
    return replace(closed, f"([{OPENING}])[{WHITE}]+", "$1")


def qualified_identifier_repair(value: Column) -> Column:
    """The text without white space where that is a dotted identifier; otherwise null."""
    dense = without_whitespace(value)
    return F.when((dense != value) & dense.rlike(f"^(?:{QUALIFIED_IDENTIFIER})$"), dense)


def spacing_states(value: Column) -> Column:
    """A letter for each pair of adjacent visible characters: n none, s space, h line break."""
    inner = trimmed(value)
    marked = replace(replace(inner, f"[{WHITE}]*\\n[{WHITE}]*", "\x01"), f"[{WHITE}]+", "\x02")
    marked = replace(marked, "(?<=[^\x01\x02])(?=[^\x01\x02])", "\x03")
    return F.translate(replace(marked, "[^\x01-\x03]", ""), "\x01\x02\x03", "hsn")


def render_spacing(dense: Column, states: Column) -> Column:
    """Visible characters with their boundary states written out again."""
    chars = F.split(dense, "")
    marks = F.transform(F.split(states, ""), lambda s: F.when(s == "s", " ").when(s == "h", "\n").otherwise(""))
    return F.array_join(F.zip_with(chars, marks, lambda c, m: F.concat(c, F.coalesce(m, F.lit("")))), "")


def changed_boundaries(before: Column, after: Column) -> Column:
    """Indexes at which two state strings of equal length differ."""
    differs = F.zip_with(F.split(before, ""), F.split(after, ""), lambda a, b: a != b)
    numbered = F.transform(differs, lambda d, i: F.when(d, i))
    return F.filter(numbered, lambda i: i.isNotNull())


def _any_line(value: Column, pattern: str) -> Column:
    return F.exists(split_lines(value), lambda x: x.rlike(pattern))


def protected_tokens(value: Column) -> Column:
    """All occurrences of tokens that spacing must not split, pattern by pattern."""
    found = [F.regexp_extract_all(value, _lit(p), F.lit(0)) for p in PROTECTED_TOKENS]
    return F.flatten(F.array(*found))


def has_qualified_split(value: Column) -> Column:
    return F.exists(split_lines(value), lambda x: F.coalesce(
        (without_whitespace(x) != trimmed(x)) & without_whitespace(x).rlike(f"^(?:{QUALIFIED_IDENTIFIER})$"), F.lit(False)))


def has_token_split(value: Column) -> Column:
    """A token that only matches with white space inside it."""
    def split(line: Column) -> Column:
        checks = []
        for loose in LOOSE_TOKENS:
            pattern = loose.replace("[W]", f"[{WHITE}]")
            checks.append(F.exists(F.regexp_extract_all(line, _lit(pattern), F.lit(0)),
                                   lambda m: m.rlike(f"[{WHITE}]")))
        out = checks[0]
        for c in checks[1:]:
            out = out | c
        return out

    return F.exists(split_lines(value), split)


def spacing_defects(value: Column) -> Column:
    """Codes of spacing defects, in a fixed order."""
    split = _any_line(value, f"[{WHITE}]_|_[{WHITE}]")
    qualified = has_qualified_split(value)
    other_white = WHITE.replace(r"\t-\r", r"\t\x0b-\r").replace(r"\x1c-\x20", r"\x1c-\x1f")
    codes = F.array(
        F.when(value.rlike(f"[{other_white}]"), "CONTROL_WHITESPACE_SEPARATOR"),
        F.when(split, "IDENTIFIER_WHITESPACE_SPLIT")
        .when(qualified, "QUALIFIED_IDENTIFIER_WHITESPACE_SPLIT")
        .when(has_token_split(value), "PROTECTED_TOKEN_WHITESPACE_SPLIT"),
        F.when(_any_line(value, f"[{WHITE}]+[{CLOSING}]"), "PUNCTUATION_WHITESPACE_BEFORE"),
        F.when(_any_line(value, f"[{OPENING}][{WHITE}]+"), "PUNCTUATION_WHITESPACE_AFTER_OPEN"))
    return F.array_compact(codes)


def fragmented(value: Column) -> Column:
    """Two Hangul words of which one is a single syllable, or an identifier split by white space."""
    pairs = F.regexp_extract_all(value, _lit(f"(?<![가-힣A-Za-z0-9_])([가-힣]+)[{WHITE}]+([가-힣]+)"), F.lit(0))
    lone = F.exists(pairs, lambda m: m.rlike(f"^[가-힣][{WHITE}]|[{WHITE}][가-힣]$"))
    split = value.rlike(rf"\b[A-Za-z0-9]+[{WHITE}]+[A-Za-z0-9]*_[A-Za-z0-9_]*\b|\b[A-Za-z0-9_]*_[A-Za-z0-9_]*[{WHITE}]+[A-Za-z0-9]+\b")
    return lone | split


def lone_syllable(value: Column) -> Column:
    """A token that is one Hangul syllable."""
    return F.exists(F.split(value, f"[{WHITE}]+"), lambda t: t.rlike("^[가-힣]$"))


def looks_like_formula(value: Column) -> Column:
    return value.contains("=") | value.rlike(r"\b[A-Z][A-Z0-9_]*\s*\(")


def edit_budget_code(source: Column, corrected: Column, kind: Column) -> Column:
    """Null for an edit within its budget, else why not.

    Spacing edits keep the visible characters. Recognition edits keep length and white
    space and change 1 to max(1, min(4, 15 % of the visible characters)) characters.
    """
    a, b = F.split(source, ""), F.split(corrected, "")
    changes = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x != y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x)
    blank = f"^[{WHITE}]$"
    moved = F.exists(F.zip_with(a, b, lambda x, y: (x != y) & (x.rlike(blank) | y.rlike(blank))), lambda m: m)
    visible = F.char_length(without_whitespace(source))
    budget = F.greatest(F.lit(1), F.least(F.lit(4), F.floor(visible * 15 / 100).cast("int")))
    spacing = (source == corrected) | (without_whitespace(source) != without_whitespace(corrected))
    recognition = (F.char_length(source) != F.char_length(corrected)) | moved | (changes == 0) | (changes > budget)
    return (F.when((kind == "spacing") & spacing, "SEMANTIC_OCR_CORRECTION_SPACING_INVALID")
            .when((kind != "spacing") & recognition, "SEMANTIC_OCR_CORRECTION_RECOGNITION_INVALID"))


def has_raw_html(value: Column) -> Column:
    return value.rlike(RAW_HTML)


def escape_markdown(value: Column) -> Column:
    return replace(value, f"([{ASCII_PUNCTUATION}])", r"\\$1")


def escape_inline(value: Column) -> Column:
    """Escaped, with a hard break at each line end."""
    return F.array_join(F.transform(F.split(value, "\n"), escape_markdown), "  \n")


def escape_table_value(value: Column) -> Column:
    """Escaped, on one line."""
    return F.array_join(F.transform(F.split(value, "\n"), escape_markdown), " ")


def list_item(value: Column, depth: Column, base: int = 0) -> Column:
    """A list item indented four spaces for each level above ``base``."""
    return F.concat(F.repeat(F.lit("    "), depth - base), F.lit("- "), escape_inline(value))


def masked_preview(value: Column) -> Column:
    """First and last four of at most 24 characters, white space collapsed; null under 8."""
    plain = trimmed(replace(value, f"[{WHITE}]+", " "))
    return F.when(F.char_length(plain) >= 8, F.concat(
        F.substring(plain, 1, 4), F.lit("…"), F.right(F.substring(plain, 1, 24), F.lit(4))))


def normalize_header(value: Column) -> Column:
    return replace(F.lower(trimmed(F.translate(value, "\u00a0", " "))), f"[{WHITE}]+", "_")


def as_boolean(value: Column) -> Column:
    """y, yes, true, 1 and their opposites, in any case; anything else is null."""
    v = F.lower(trimmed(value))
    return F.when(v.isin("y", "yes", "1", "true"), True).when(v.isin("n", "no", "0", "false"), False)


def form_locator(location: Column, table: Column) -> Column:
    """``platform|catalog|schema|table`` of a dotted location; two parts lack the platform."""
    parts = F.transform(F.split(F.lower(location), r"\."), trimmed)
    leaf = F.lower(trimmed(table))
    bad = F.exists(parts, lambda p: (p == "") | p.contains("|")) | (leaf == "") | leaf.contains("|")
    return (F.when(bad, F.lit(None).cast("string")).when(F.size(parts) == 2, F.concat_ws("|", F.lit("unspecified"), parts[0], parts[1], leaf))
            .when(F.size(parts) == 3, F.concat_ws("|", parts[0], parts[1], parts[2], leaf)))


def heading_level(number: Column) -> Column:
    """Level of a section number such as 1.2.3: its parts plus one, at most 6."""
    parts = F.filter(F.split(number, r"\."), lambda p: p != "")
    return F.least(F.lit(6), F.size(parts) + 1)


def normalize_line_ends(value: Column) -> Column:
    return replace(value, "\r\n?", "\n")


def parse_locator(value: Column) -> Column:
    """Struct of the four parts of a locator; null for any other number of parts."""
    p = F.split(value, r"\|")
    return F.when(F.size(p) == 4, F.struct(p[0].alias("source_system"), p[1].alias("catalog"),
                                           p[2].alias("schema_name"), p[3].alias("table_name")))


def safe_token(value: Column) -> Column:
    """An upper-case code, or "unknown"."""
    return F.when(value.rlike(r"^[A-Z][A-Z0-9_]{0,127}$"), value).otherwise("unknown")


def url_policy_code(url: Column, hosts: tuple[str, ...]) -> Column:
    """Null for an allowed attachment address, else the first rule it breaks."""
    def part(name):
        return F.try_parse_url(url, F.lit(name))

    authority = F.coalesce(part("AUTHORITY"), F.lit(""))
    return (F.when(F.coalesce(part("PROTOCOL"), F.lit("")) != "https", "ATTACHMENT_HTTPS_REQUIRED")
            .when(authority.contains("@"), "ATTACHMENT_CREDENTIALS_FORBIDDEN")
            .when(authority.rlike(":[0-9]+$"), "ATTACHMENT_PORT_FORBIDDEN")
            .when(~F.coalesce(part("HOST"), F.lit("")).isin(*hosts), "UNTRUSTED_ATTACHMENT_HOST")
            .when(part("QUERY").isNotNull() | part("REF").isNotNull(), "ATTACHMENT_QUERY_FORBIDDEN")
            .when(F.coalesce(part("PATH"), F.lit("")).rlike(r"(^|/)\.\.?(/|$)|%|//"), "UNTRUSTED_ATTACHMENT_PATH"))


def sensitive_redaction(key: Column, value: Column) -> Column:
    """"***" for values under names that hold secrets."""
    return F.when(key.rlike(SENSITIVE_KEY), "***").otherwise(value)


def secret_kinds(value: Column) -> Column:
    """Kinds of secrets found in a text."""
    return F.array_compact(F.array(*[F.when(value.rlike(p), kind) for kind, p in SECRETS.items()]))
