"""The few functions without a built-in equivalent, as Arrow-batched UDFs."""

from __future__ import annotations

import difflib
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathom.functions.canonical_json import DESCRIPTIVE_KEYS, VOLATILE_KEYS, canonical_json_hash

@F.pandas_udf(T.StringType())
def nfc(value: pd.Series) -> pd.Series:
    """Unicode normalisation form C."""
    return value.map(lambda v: None if v is None else unicodedata.normalize("NFC", v))


@F.pandas_udf(T.StringType())
def comparison_key(value: pd.Series) -> pd.Series:
    """NFC, case-folded, without white space."""
    return value.map(lambda v: None if v is None else "".join(unicodedata.normalize("NFC", v).casefold().split()))


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity; 0 where either is null."""
    return pd.Series([0.0 if x is None or y is None else difflib.SequenceMatcher(None, x, y, autojunk=False).ratio()
                      for x, y in zip(a, b, strict=True)])


@F.pandas_udf(T.StringType())
def canonical_hash(document: pd.Series) -> pd.Series:
    """SHA-256 of a JSON text with NFC strings, sorted keys and no volatile keys."""
    return document.map(canonical_json_hash)


@F.pandas_udf(T.StringType())
def schema_hash(document: pd.Series) -> pd.Series:
    """As canonical_hash, without descriptive keys."""
    return document.map(lambda v: canonical_json_hash(v, VOLATILE_KEYS + DESCRIPTIVE_KEYS))


@F.pandas_udf(T.StringType())
def uuid7(milliseconds: pd.Series, entropy: pd.Series) -> pd.Series:
    """UUID version 7 from a time in milliseconds and 10 bytes of entropy."""
    out = []
    for ms, e in zip(milliseconds, entropy, strict=True):
        bits = int.from_bytes(e, "big") & ((1 << 74) - 1)
        n = (int(ms) & ((1 << 48) - 1)) << 80 | 7 << 76 | (bits >> 62) << 64 | 2 << 62 | bits & ((1 << 62) - 1)
        h = f"{n:032x}"
        out.append("-".join((h[:8], h[8:12], h[12:16], h[16:20], h[20:])))
    return pd.Series(out)


@F.pandas_udf(T.StringType())
def utf8_prefix(value: pd.Series, most: pd.Series) -> pd.Series:
    """The longest prefix of at most so many UTF-8 bytes."""
    return pd.Series([None if v is None else v.encode()[:int(n)].decode(errors="ignore")
                      for v, n in zip(value, most, strict=True)])

