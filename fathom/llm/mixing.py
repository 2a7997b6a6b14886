"""Mixing sources to target weights, with DataFrame operations only.

The words of each source, in a fixed document order, are cut into blocks of
``block_words``. Sources get target sizes by weight, capped at ``cap`` times their
size. An output shard has ``shard_blocks`` places, and each place draws a source by a
hash of its number, with a chance in proportion to the source's target in blocks: the
shard's source counts are multinomial. A shard takes as many slots of a source as it drew
places, following those of the shards before it. Slot j of a source is index ``j mod
blocks`` of pass ``j div blocks``; a keyed pseudorandom permutation (swap-or-not, a new
key in each pass) maps the index to a block, and blocks are joined by index with the
document pieces they consist of. A short last block keeps its place at the end of each
pass; slots after pass ``cap`` are not filled, so no document is taken more often.

With N places a source of share p gets its target with a relative standard deviation of
sqrt((1 - p) / (p N)), which falls with the size of the corpus.

No step gathers a source in one task: document starts are prefix sums over
(source, bucket of documents) plus prefix sums over the buckets' totals.

Edge cases: null or empty text has size 0 and is taken 0 times; a very long text is
many blocks; a null source is a source of its own, last in order; equal rows are separate
documents with the same columns, ties of doc_id are ordered by size; null doc_ids order
first in their bucket; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, shuffle_partitions

CYCLE = (5, 2, 1)
BLOCK_WORDS, SEED = 128, 20240607
ROUNDS = 24
PRIME = 2147483647
DOCS_A_BUCKET = 512
SHARDS_A_GROUP = 1024
CELL = 1 << 20
FOLDS = ((1103515245, 12345), (630360016, 777), (1397204094, 99))
SPLIT = r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    return F.when(source.isNull(), "-").otherwise(F.concat(F.lit("+"), source))


def place_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, source, src, size, start): where each document's words begin in its source.

    Texts are read once: sizes, and then places, are written to the shared folder.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    sized = scratch.save(docs.select("doc_id", "source", _source_key(F.col("source")).alias("src"),
                                     word_count(F.col("text")).alias("size")), "sizes")
    count = sized.count()
    buckets = max(1, -(-count // DOCS_A_BUCKET))
    sized = sized.withColumn("bucket", F.expr(
        f"(pmod(coalesce(cast(doc_id as bigint), 0), {PRIME}) * 48271 + size * 69621) % {PRIME} % {buckets}"))
    inside = (Window.partitionBy("src", "bucket").orderBy("doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sized = sized.withColumn("local", F.sum("size").over(inside) - F.col("size"))
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sized.groupBy("src", "bucket").agg(F.sum("size").alias("n"))
              .select("src", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    placed = (sized.join(starts, ["src", "bucket"])
              .select("doc_id", "source", "src", "size", (F.col("base") + F.col("local")).alias("start")))
    return scratch.save(placed, "placed")


def targets(placed: DataFrame, share: float = 1.5, cap: int = 2, cycle=CYCLE) -> DataFrame:
    """(src, source_size, target) by weight, no target above ``cap`` times its source.

    Sources in code-point order, null last, weigh ``cycle`` in turn. Taking sources by
    their capped size a unit of weight, those below the common level are held
    at their cap and the others share what is left by weight, as repeated resharing does.
    """
    sizes = placed.groupBy("src").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("src") == "-", "src")
    weights = F.array(*[F.lit(w) for w in cycle])
    weighed = (sizes.withColumn("rank", F.row_number().over(order).cast("long"))
               .withColumn("weight", weights[((F.col("rank") - 1) % len(cycle)).cast("int")]))
    by_level = Window.orderBy(F.expr(f"{cap} * source_size / weight"), "rank")
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (weighed
             .withColumn("held", F.coalesce(F.sum(cap * F.col("source_size")).over(earlier), F.lit(0)))
             .withColumn("open", F.sum("weight").over(rest))
             .withColumn("wanted", F.lit(float(share)) * F.sum("source_size").over(everything))
             .withColumn("level", (F.col("wanted") - F.col("held")) / F.col("open"))
             .withColumn("full", cap * F.col("source_size") <= F.col("level") * F.col("weight")))
    common = F.min(F.when(~F.col("full"), F.struct(F.expr(f"{cap} * source_size / weight"),
                                                   F.col("rank"), F.col("level")))).over(everything)
    return (level.withColumn("common", common["level"])
            .select("src", "source_size", "rank",
                    F.when(F.col("full") | F.col("common").isNull(),
                           (cap * F.col("source_size")).cast("double"))
                    .otherwise(F.least((cap * F.col("source_size")).cast("double"),
                                       F.col("common") * F.col("weight"))).alias("target")))


def _permuted(slot: str, domain: str, key: str) -> str:
    """SQL: swap-or-not permutation of [0, domain) by an integer key."""
    pivot = f"(({key} + r * 1103515245) % {PRIME} * 48271 % {PRIME}) % {domain}"
    mirror = f"pmod({pivot} - x, {domain})"
    return f"""aggregate(sequence(cast(0 as bigint), cast({ROUNDS - 1} as bigint)), {slot},
      (x, r) -> CASE WHEN ((greatest(x, {mirror}) % {PRIME} * 69621 + ({key} + r * 40692) % {PRIME})
        % {PRIME} * 16807 % {PRIME}) div 65536 % 2 = 1 THEN {mirror} ELSE x END)"""


def draws(goals: DataFrame, block_words: int, shard_blocks: int, seed: int, cap: int = 2) -> DataFrame:
    """(src, shard, slot, pass, block): every block of the mix, by shard.

    Each of a shard's ``shard_blocks`` places draws a source on its own, with a
    chance in proportion to the source's target in blocks, so the shard's source counts
    are multinomial. Counts before a shard, summed in two levels, give the slots that
    the shard takes of each source.
    """
    spark = goals.sparkSession
    n = goals.selectExpr("src", "source_size", "rank", f"source_size div {block_words} AS whole",
                         f"cast(ceil(source_size / {block_words}) as bigint) AS blocks",
                         "target").where("target > 0")
    by_rank = Window.orderBy("rank")
    everything = by_rank.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n = n.withColumn("upto", F.sum(F.expr("target * blocks / source_size")).over(
        by_rank.rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("total", F.max("upto").over(everything))
    n = n.withColumn("to", F.floor(F.col("upto") / F.col("total") * PRIME + 0.5).cast("long"))
    n = n.withColumn("from", F.coalesce(F.lag("to").over(by_rank), F.lit(0)))
    places = n.agg(F.expr("cast(round(coalesce(max(total), 0)) as bigint)").alias("places"))
    # One row a range of shards first, so that no task unrolls a large mix alone.
    shards = places.where("places > 0").withColumn("shard", F.explode(F.expr(
        f"sequence(cast(0 as bigint), (places - 1) div {shard_blocks})")))
    shards = shards.repartition(shuffle_partitions(spark), "shard")
    drawn = shards.withColumn("place", F.explode(F.expr(
        f"sequence(shard * {shard_blocks}, least((shard + 1) * {shard_blocks}, places) - 1)")))
    drawn = drawn.selectExpr("shard", f"(place % {PRIME} * 48271 + place div {PRIME} * 16807 + {seed}) % {PRIME} AS u")
    for times, plus in FOLDS:
        drawn = drawn.selectExpr("shard", f"((u ^ (u div 32768)) * {times} + {plus}) % {PRIME} AS u")
    # A source is found by the cell of its interval that holds the draw.
    intervals = n.where("from < to").withColumn("cell", F.explode(F.expr(f"sequence(from div {CELL}, (to - 1) div {CELL})")))
    drawn = drawn.withColumn("cell", F.expr(f"u div {CELL}")).join(
        intervals.select("src", "from", "to", "cell"), "cell").where("u >= from AND u < to")
    counts = shard_counts(drawn)
    counts = Scratch(spark, "mixing_draws").save(counts.withColumn("group", F.expr(f"shard div {SHARDS_A_GROUP}")), "counts")
    inside = Window.partitionBy("src", "group").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("src").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.groupBy("src", "group").agg(F.sum("draws").alias("n")).select(
        "src", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    counts = counts.withColumn("local", F.coalesce(F.sum("draws").over(inside), F.lit(0))).join(bases, ["src", "group"])
    each = counts.join(n, "src").selectExpr(
        "src", "shard", "whole", "blocks", "base + local AS low",
        f"least(base + local + draws, {cap} * blocks) AS high", f"(rank * 7919 + {seed}) % {PRIME} AS key").where("low < high")
    each = each.repartition(shuffle_partitions(spark), "src", "shard").withColumn(
        "slot", F.explode(F.expr("sequence(low, high - 1)")))
    each = each.selectExpr("*", "slot div blocks AS pass", "slot % blocks AS x").selectExpr(
        "*", f"(key + pass * 15485863) % {PRIME} AS passkey")
    return each.selectExpr("src", "shard", "slot", "pass",
                           f"CASE WHEN x = whole THEN x ELSE {_permuted('x', 'whole', 'passkey')} END AS block")


def shard_counts(drawn: DataFrame) -> DataFrame:
    """(shard, src, draws): the source counts of every output shard."""
    return drawn.groupBy("shard", "src").agg(F.count("*").alias("draws"))


def block_pieces(placed: DataFrame, block_words: int) -> DataFrame:
    """(src, start, size, doc_id, block, at, first, n): document pieces of each block."""
    spans = placed.where("size > 0").withColumn("block", F.explode(F.expr(
        f"sequence(start div {block_words}, (start + size - 1) div {block_words})")))
    return spans.selectExpr(
        "src", "start", "size", "doc_id", "block",
        f"greatest(start - block * {block_words}, 0) AS at",
        f"greatest(block * {block_words} - start, 0) AS first",
        f"least(start + size, (block + 1) * {block_words}) - greatest(start, block * {block_words}) AS n")


def mix_sources(placed: DataFrame, goals: DataFrame, block_words: int = BLOCK_WORDS,
                shard_blocks: int = 1024, seed: int = SEED) -> DataFrame:
    """The mix, a row for each document piece of each block.

    Columns: shard, src, slot, pass, block, at (place of the piece in its block), doc_id,
    start (the document's, which with src names it), first (its first word taken, from
    0) and words (taken from there). Order by shard and a hash of slot to write it.
    """
    drawn = draws(goals, block_words, shard_blocks, seed)
    pieces = block_pieces(placed, block_words)
    # Both sides grow with the corpus, though they are unrolled from small tables.
    return drawn.hint("merge").join(pieces.hint("merge"), ["src", "block"]).select(
        "shard", "src", "slot", "pass", "block", "at", "doc_id", "start", "first", F.col("n").alias("words"))


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as documents: for each pass, the words of each document that it takes.

    Returns the columns doc_id, text, lang, source, n_chars; a document taken in two
    passes has two rows, one not taken has none.
    """
    placed = place_documents(docs)
    mix = mix_sources(placed, targets(placed), block_words)
    spans = mix.groupBy("src", "start", "pass").agg(
        F.sort_array(F.collect_list(F.struct("first", "words"))).alias("spans"))
    # A document's row is named by (src, start) in the mix and found again by its id and size.
    named = spans.join(placed.where("size > 0"), ["src", "start"]).select(
        "src", F.col("doc_id").alias("id"), F.col("size").alias("words"), "pass", "spans",
        F.row_number().over(Window.partitionBy("src", "doc_id", "size", "pass").orderBy("start")).alias("nth"))
    rows = docs.select("doc_id", "text", "lang", "source", _source_key(F.col("source")).alias("from"),
                       word_count(F.col("text")).alias("size"))
    nth = Window.partitionBy("from", "doc_id", "size").orderBy(F.xxhash64("text"))
    rows = rows.where("size > 0").withColumn("row", F.row_number().over(nth))
    out = rows.join(named, (F.col("from") == F.col("src")) & F.col("doc_id").eqNullSafe(F.col("id"))
                    & (F.col("size") == F.col("words")) & (F.col("row") == F.col("nth")))
    taken = F.expr("aggregate(spans, cast(0 as bigint), (n, s) -> n + s.words)")
    # A document taken whole keeps its own spacing.
    out = out.withColumn("text", F.when(taken == F.col("size"), F.col("text")).otherwise(F.expr(f"""
        array_join(flatten(transform(spans, s -> slice({SPLIT}, cast(s.first + 1 as int), cast(s.words as int)))), ' ')""")))
    return out.select("doc_id", "text", "lang", "source",
                      F.char_length("text").cast("long").alias("n_chars"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    placed = place_documents(docs)
    goals = targets(placed)
    taken = mix_sources(placed, goals).groupBy("src", "start").agg(F.sum("words").alias("words"))
    # Empty documents share a start with the next one, and are taken 0 times.
    return (placed.join(goals, "src")
            .withColumn("key", F.when(F.col("size") > 0, F.col("start")))
            .join(taken.withColumnRenamed("start", "key"), ["src", "key"], "left")
            .select("doc_id", "size", "source_size", "target",
                    F.coalesce("words", F.lit(0)).cast("long").alias("taken")))


def _oracle() -> str:
    step = "d0"
    rounds = []
    for r in range(ROUNDS):
        pivot = f"(((passkey + {r * 1103515245}) % {PRIME} * 48271 % {PRIME}) % whole)"
        rounds.append(f"""p{r} AS (SELECT *, (({pivot} - x) % whole + whole) % whole AS y{r} FROM {step}),
d{r + 1} AS (SELECT * EXCLUDE (x, y{r}), CASE WHEN ((((greatest(x, y{r}) % {PRIME}) * 69621
  + (passkey + {r * 40692}) % {PRIME}) % {PRIME} * 16807 % {PRIME}) // 65536) % 2 = 1 THEN y{r} ELSE x END AS x FROM p{r})""")
        step = f"d{r + 1}"
    size = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT"
    folds = "".join(f"u{i + 1} AS (SELECT place, (xor(u, u // 32768) * {t} + {c}) % {PRIME} AS u FROM u{i}),\n"
                    for i, (t, c) in enumerate(FOLDS))
    return f"""
WITH s AS (SELECT doc_id, coalesce('+' || source, '-') AS src, {size} AS size FROM documents),
sb AS (SELECT *, (((coalesce(doc_id, 0) % {PRIME}) + {PRIME}) % {PRIME} * 48271 + size * 69621) % {PRIME}
    % greatest(1, (SELECT (count(*) + {DOCS_A_BUCKET - 1}) // {DOCS_A_BUCKET} FROM documents)) AS bucket FROM s),
placed AS (SELECT doc_id, src, size, sum(size) OVER (PARTITION BY src ORDER BY bucket, doc_id NULLS FIRST, size
  ROWS UNBOUNDED PRECEDING)::BIGINT - size AS start FROM sb),
w AS (SELECT src, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY src = '-', src) AS rank FROM s GROUP BY src),
w2 AS (SELECT *, [5, 2, 1][(rank - 1) % 3 + 1] AS weight FROM w),
w3 AS (SELECT *, 2 * source_size / weight AS r FROM w2),
lv AS (SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER (ORDER BY r, rank
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
  / sum(weight) OVER (ORDER BY r, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w3),
fl AS (SELECT *, 2 * source_size <= level * weight AS full_ FROM lv),
cm AS (SELECT *, (SELECT level FROM fl WHERE NOT full_ ORDER BY r, rank LIMIT 1) AS common FROM fl),
goals AS (SELECT src, source_size, rank, CASE WHEN full_ OR common IS NULL THEN (2 * source_size)::DOUBLE
  ELSE least((2 * source_size)::DOUBLE, common * weight) END AS target FROM cm),
n AS (SELECT src, source_size, rank, source_size // {BLOCK_WORDS} AS whole, (source_size + {BLOCK_WORDS - 1}) // {BLOCK_WORDS} AS blocks,
  target FROM goals WHERE target > 0),
n2 AS (SELECT *, sum(target * blocks / source_size) OVER (ORDER BY rank ROWS UNBOUNDED PRECEDING) AS upto FROM n),
n3 AS (SELECT *, floor(upto / (SELECT max(upto) FROM n2) * {PRIME} + 0.5)::BIGINT AS to_ FROM n2),
n4 AS (SELECT *, coalesce(lag(to_) OVER (ORDER BY rank), 0) AS from_, (rank * 7919 + {SEED}) % {PRIME} AS key FROM n3),
u0 AS (SELECT place, (place % {PRIME} * 48271 + place // {PRIME} * 16807 + {SEED}) % {PRIME} AS u
  FROM (SELECT unnest(range(round(coalesce((SELECT max(upto) FROM n2), 0))::BIGINT)) AS place)),
{folds}t AS (SELECT src, least(count(*), 2 * any_value(blocks)) AS slots FROM u{len(FOLDS)} JOIN n4 ON u >= from_ AND u < to_ GROUP BY src),
e AS (SELECT src, whole, blocks, key, unnest(range(slots)) AS slot FROM t JOIN n4 USING (src)),
e2 AS (SELECT *, slot % blocks AS x, (key + (slot // blocks) * 15485863) % {PRIME} AS passkey FROM e),
d0 AS (SELECT * FROM e2 WHERE x < whole),
{", ".join(rounds)},
drawn AS (SELECT src, x AS block FROM {step} UNION ALL SELECT src, x FROM e2 WHERE x = whole),
pc AS (SELECT src, start, size, unnest(range(start // {BLOCK_WORDS}, (start + size - 1) // {BLOCK_WORDS} + 1)) AS block FROM placed WHERE size > 0),
pn AS (SELECT src, start, block, least(start + size, (block + 1) * {BLOCK_WORDS}) - greatest(start, block * {BLOCK_WORDS}) AS n FROM pc),
tk AS (SELECT src, start, sum(n)::BIGINT AS taken FROM drawn JOIN pn USING (src, block) GROUP BY src, start)
SELECT doc_id, size, source_size, target, CASE WHEN size > 0 THEN coalesce(taken, 0) ELSE 0 END::BIGINT AS taken
FROM placed JOIN goals USING (src) LEFT JOIN tk USING (src, start)
"""


ORACLE_SQL = _oracle()
