"""Documents that try an operator's edges."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHES = ("row", "chunk", "node", "key", "size", "start", "src", "bucket", "copies", "low", "score", "x", "words",
           "n_lines", "n_removed", "text_hash", "hash", "id", "shard", "block", "spans", "least", "band", "cell", "v", "valid")


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    out = []
    for i in range(n):
        out.append("w%03x" % rng.randrange(vocabulary))
        out.append("\n" if i % 11 == 10 else " ")
    return "".join(out).strip()


def documents(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    base = [prose(rng, n) for n in (60, 120, 300, 45, 80)]
    passage = prose(rng, 70)
    texts = [None, "", " \n ", "one", "two words", "é€😀 ñandú \x00 nul\x0bvt", *base, base[0], base[0], base[1][:len(base[1]) // 2],
             base[2] + " tail", base[3] + " " + passage, passage + "\n" + base[4], "start " + passage + " end", "a" * 900, "ab " * 500,
             prose(rng, 4000), "same\nsame\nsame\nsame\nsame\nsame", "l1\nl2\nl3\nl4", "x\nl1\nl2\nl3\nl4\ny"]
    words = base[2].split(" ")
    words[150] = "changed"
    texts.append(" ".join(words))
    rows = [(i * 3 - 5, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, len(t or "")) for i, t in enumerate(texts)]
    rows.append((None, base[1], None, None, None))
    rows.append((rows[8][0], rows[8][1], "fr", "s9", None))  # the same id and text again
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(3)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHES if c not in df.columns])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def as_set(df, *names):
    from tests.conftest import plain

    return sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)
