"""Mixing sources to target weights, with a hypergeometric splitting tree over output shards.

DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkatlas.runtime import stored

WEIGHTS = (3, 1, 2)
# Words of the mix for each word of the input, and the most copies of a document.
SHARE = 1.5
MOST_COPIES = 2
# The tree has 2 ** LEVELS leaves at least, the output shards, and more where a shard would have over SHARD_WORDS words.
LEVELS = 3
SHARD_WORDS = 1 << 25
# So many blocks on average go to a shard; blocks of all sources have about the same number of words.
SHARD_BLOCKS = 32
# The block that a source draws in part is found by so many digits of the key, then by twice as many.
CUT_DIGITS = 2
SEED = 7

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def draw_key(doc_id: Column, text: Column, seed: int) -> Column:
    """A hash that puts the documents of a source in random order; equal ranges of it are the blocks."""
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("?"), F.coalesce(text.cast("string"), F.lit(""))))
    return F.md5(F.concat(F.lit(f"{seed}|"), name))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``: one row per source in and out.

    Sources by code point, null last, weigh ``weights`` in turn.  What exceeds
    ``MOST_COPIES`` times a source's size is shared among the others again,
    until none is above.  The table of sources is small: it is ranked in one task.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.lit(list(weights)), (rank % len(weights) + 1).cast("int"))
    ranked = stored(sizes.withColumn("w", weight).withColumn("cap", MOST_COPIES * F.col("source_size")))
    total, parts = ranked.agg(F.sum("source_size"), F.sum("w")).first()
    level = share * total / parts if parts else None
    while level is not None:
        above = F.col("cap") <= F.lit(level) * F.col("w")
        caps, free = ranked.agg(
            F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("w"))), F.lit(0))
        ).first()
        raised = (share * total - caps) / free if free else None
        if raised == level:
            break
        level = raised
    scaled = F.lit(level).cast("double") * F.col("w")
    return ranked.select("source", "source_size", F.least(F.col("cap").cast("double"), scaled).alias("target"))


def _half(quotas: Column, node: Column, seed: int) -> Column:
    """How many blocks of each source go to the left child of a node.

    The node's blocks go one by one, each to the left with the probability
    (places left on the left) / (blocks left), so the counts are one exact draw
    of the multivariate hypergeometric distribution.
    """
    total = F.aggregate(quotas, F.lit(0).cast("long"), lambda a, x: a + x["quota"])
    start = F.struct(
        F.floor(total / 2).alias("free"), total.alias("rest"), F.array().cast("array<bigint>").alias("taken")
    )

    def chance(a: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), node, a["rest"]), F.lit(1 << 40)) / F.lit(float(1 << 40))

    def one(a: Column, _: Column) -> Column:
        left = (chance(a) * a["rest"] < a["free"]).cast("long")
        return F.struct((a["free"] - left).alias("free"), (a["rest"] - 1).alias("rest"))

    def each(a: Column, x: Column) -> Column:
        blocks = F.when(x["quota"] > 0, F.sequence(F.lit(1).cast("long"), x["quota"])).otherwise(F.array().cast("array<bigint>"))
        after = F.aggregate(blocks, F.struct(a["free"].alias("free"), a["rest"].alias("rest")), one)
        # Bound once, so that the inner loop runs once.
        return F.element_at(
            F.transform(
                F.array(after),
                lambda e: F.struct(
                    e["free"].alias("free"),
                    e["rest"].alias("rest"),
                    F.concat(a["taken"], F.array(a["free"] - e["free"])).alias("taken"),
                ),
            ),
            1,
        )

    return F.aggregate(quotas, start, each)["taken"]


def _left(entry: Column, taken: Column) -> Column:
    return F.struct(entry["source"].alias("source"), taken.alias("quota"))


def _right(entry: Column, taken: Column) -> Column:
    return F.struct(entry["source"].alias("source"), (entry["quota"] - taken).alias("quota"))


def split_quotas(quotas: DataFrame, levels: int = LEVELS, seed: int = SEED) -> DataFrame:
    """``shard, source, quota`` from ``source, quota``: the leaves of the splitting tree.

    The quotas of one node are one row; there are as many entries as sources.
    """
    entry = F.struct("source", F.col("quota").cast("long").alias("quota"))
    nodes = quotas.agg(F.array_sort(F.collect_list(entry)).alias("quotas")).withColumn("node", F.lit(1).cast("long"))
    for _ in range(levels):
        halved = nodes.withColumn("left", _half(F.col("quotas"), F.col("node"), seed))
        sides = []
        for side in (0, 1):
            child = F.zip_with("quotas", "left", _right if side else _left)
            sides.append(F.struct((F.col("node") * 2 + side).alias("node"), child.alias("quotas")))
        nodes = stored(halved.select(F.explode(F.array(*sides)).alias("n")).select("n.quotas", "n.node"))
    shard = (F.col("node") - (1 << levels)).cast("int").alias("shard")
    return nodes.select(shard, F.explode("quotas").alias("q")).select("shard", "q.source", "q.quota")


def _running(table: DataFrame, key: str) -> DataFrame:
    """``before`` and ``after``: sums of ``words`` along ``key`` in each source."""
    after = F.sum("words").over(Window.partitionBy("source").orderBy(key))
    return table.withColumn("after", after).withColumn("before", F.col("after") - F.col("words"))


def _same_source(a: str, b: str) -> Column:
    return F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))


def _cuts(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, source_size, target, rounds, rest, cut``.

    Every document is drawn ``rounds`` times, and once more if its key is at
    most ``cut``; these documents together have about ``rest`` words.  The
    block that is drawn in part is found in the sums of blocks, then its part
    in the sums of smaller blocks, and only that one is looked at row by row.
    """
    full = F.col("source_size") > 0
    rounds = F.when(full, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    plan = targets.withColumn("rounds", rounds)
    plan = stored(plan.withColumn("rest", F.col("target") - F.col("rounds") * F.col("source_size")).withColumn("prefix", F.lit("")))
    rows = sized
    for digits in (CUT_DIGITS, 2 * CUT_DIGITS):
        blocks = rows.groupBy("source", F.substring("key", 1, digits).alias("block")).agg(F.sum("size").alias("words"))
        joined = _running(blocks, "block").alias("b").join(plan.alias("p"), _same_source("b", "p"))
        part = joined.where("after > rest AND before <= rest").select(
            *(F.col(f"p.{c}") for c in ("source", "source_size", "target", "rounds")),
            (F.col("rest") - F.col("before")).alias("rest"),
            F.col("block").alias("prefix"),
        )
        part = part.groupBy("source").agg(*(F.min_by(c, "prefix").alias(c) for c in ("source_size", "target", "rounds", "rest", "prefix")))
        # A source with nothing to draw beyond its rounds has no such block.
        part = stored(part)
        rows = sized.alias("s").join(part.alias("p"), _same_source("s", "p") & F.col("s.key").startswith(F.col("p.prefix")))
        rows = rows.select("s.*")
        plan = part
    last = _running(rows.groupBy("source", "key").agg(F.sum("size").alias("words")), "key").alias("k")
    # The document that crosses the rest is drawn if that comes nearer.
    last = last.join(plan.alias("p"), _same_source("k", "p")).where("before + after <= 2 * rest")
    cut = last.groupBy(F.col("p.source").alias("source")).agg(F.max("key").alias("key"))
    plan = plan.alias("p").join(cut.alias("c"), _same_source("p", "c"), "left")
    plan = plan.select(F.col("p.source").alias("source"), F.coalesce("key", "prefix").alias("cut"))
    rest = F.col("target") - F.col("rounds") * F.col("source_size")
    return stored(
        targets.withColumn("rounds", rounds).withColumn("rest", rest).alias("t").join(plan.alias("p"), _same_source("t", "p"), "left")
        .select("t.*", F.coalesce("p.cut", F.lit("")).alias("cut"))
    )


def tree_levels(words: float, shard_words: int = SHARD_WORDS) -> int:
    """Levels of the tree for a mix of so many words."""
    return max(LEVELS, math.ceil(math.log2(max(words / shard_words, 1))))


def _with_blocks(cuts: DataFrame, words: float, levels: int) -> DataFrame:
    """``cuts`` with the number of ``blocks`` of each source, in proportion to its size."""
    block_words = max(words / (SHARD_BLOCKS << levels), 1.0)
    return cuts.withColumn("blocks", F.greatest(F.ceil(F.col("source_size") / block_words), F.lit(1)).cast("long"))


def _block(key: Column, blocks: Column) -> Column:
    """The number of a key's block, from 0: ascending with the key."""
    return F.shiftrightunsigned(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * blocks, 32)


def _shards(sized: DataFrame, cuts: DataFrame, levels: int, seed: int) -> DataFrame:
    """``source, block, draws``: the copies of each block with their shards.

    A source's block draws stand in random order, and the shards take their
    quotas from it one after the other.
    """
    keyed = sized.alias("s").join(cuts.alias("c"), _same_source("s", "c"))
    keyed = keyed.select("s.source", "s.key", "c.rounds", "c.cut", _block(F.col("s.key"), F.col("c.blocks")).alias("block"))
    # The columns of the source are the same in all rows of a block.
    blocks = keyed.groupBy("source", "block", "rounds", "cut").agg(F.min("key").alias("least"))
    copies = F.col("rounds") + (F.col("least") <= F.col("cut")).cast("int")
    draws = blocks.where(copies > 0).select("source", "block", F.explode(F.sequence(F.lit(1), copies)).alias("copy"))
    order = Window.partitionBy("source").orderBy(F.md5(F.concat_ws("|", F.lit(seed), "block", "copy")))
    draws = stored(draws.withColumn("place", F.row_number().over(order)))
    quotas = draws.groupBy("source").agg(F.count("*").alias("quota"))
    leaves = split_quotas(quotas, levels, seed)
    upto = F.sum("quota").over(Window.partitionBy("source").orderBy("shard"))
    places = leaves.withColumn("upto", upto).where("quota > 0").select(
        "source", "shard", F.explode(F.sequence(F.col("upto") - F.col("quota") + 1, F.col("upto"))).alias("place")
    )
    same = _same_source("d", "l") & (F.col("d.place") == F.col("l.place"))
    placed = draws.alias("d").join(places.alias("l"), same).select("d.source", "block", "copy", "shard")
    entry = F.array_sort(F.collect_list(F.struct("copy", "shard"))).alias("draws")
    return stored(placed.groupBy("source", "block").agg(entry))


def drawn(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
    columns: bool = False,
) -> DataFrame:
    """``doc_id, size, source_size, target, draws`` for every row of ``docs(doc_id, text, source)``.

    ``draws`` lists the copies of the row in the mix, each with its output
    shard.  With ``columns`` the struct ``row`` of all columns of ``docs`` comes too.
    There are ``2 ** LEVELS`` shards, and twice as many as long as one would
    have over ``shard_words`` words on average.

    A null text has size 0.  A null source is a source, the last.  Rows that
    repeat a ``doc_id`` in a source are drawn together; rows without an id are
    told apart by their text.  An empty table gives an empty result.
    """
    key = draw_key(F.col("doc_id"), F.col("text"), seed).alias("key")
    source = F.col("source").cast("string").alias("source")
    base = docs.select("doc_id", source, key, word_count(F.col("text")).alias("size"))
    sized = stored(base)
    sizes = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    targets = source_targets(sizes, weights, share)
    words = targets.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    levels = tree_levels(words, shard_words)
    cuts = _with_blocks(_cuts(sized, targets), words, levels)
    shards = _shards(sized, cuts, levels, seed)
    rows = sized
    if columns:
        rows = docs.select("doc_id", source, key, F.lit(0).cast("long").alias("size"), F.struct(*docs.columns).alias("row"))
    # One row per source, and about SHARD_BLOCKS per shard: Spark broadcasts them only as far as their sizes allow.
    rows = rows.alias("r").join(cuts.alias("c"), _same_source("r", "c"))
    block = _block(F.col("r.key"), F.col("c.blocks")) == F.col("b.block")
    rows = rows.join(shards.alias("b"), _same_source("r", "b") & block, "left")
    copies = F.col("c.rounds") + (F.col("r.key") <= F.col("c.cut")).cast("int")
    draws = F.filter(F.coalesce("b.draws", F.array().cast("array<struct<copy:int,shard:int>>")), lambda d: d["copy"] <= copies)
    kept = [F.col("r.row")] if columns else []
    return rows.select("r.doc_id", "r.size", "c.source_size", "c.target", draws.alias("draws"), *kept)


def mixed(docs: DataFrame, weights=WEIGHTS, share=SHARE, shard_words=SHARD_WORDS, seed=SEED) -> DataFrame:
    """The mix: ``docs`` with one row per drawn copy, and ``mix_copy, mix_shard, mix_order``.

    ``mix_order`` is the random place of a row within its shard.  Columns of
    ``docs`` with these names are replaced.
    """
    rows = drawn(docs, weights, share, shard_words, seed, columns=True).select("row", F.explode("draws").alias("d"))
    added = ("mix_copy", "mix_shard", "mix_order")
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in added]
    name = F.coalesce(F.col("row")["doc_id"].cast("string"), F.col("row")["text"].cast("string"), F.lit(""))
    order = F.xxhash64(F.lit(seed), "d.copy", name)
    return rows.select(*kept, F.col("d.copy").alias("mix_copy"), F.col("d.shard").alias("mix_shard"), order.alias("mix_order"))


def write_shards(mix: DataFrame, path: str) -> None:
    """One folder per output shard, its rows in their random order; a task writes a shard of bounded size."""
    mix.repartition("mix_shard").sortWithinPartitions("mix_shard", "mix_order").write.partitionBy("mix_shard").parquet(path)


# The targets and draws of ``drawn`` in DuckDB; the shard of a copy does not show in the words taken.
ORACLE = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '?' || coalesce(text, ''))) AS key
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2 * CAST(sum(size) AS BIGINT) AS cap,
         ([3, 1, 2])[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1] AS w
  FROM sized GROUP BY source),
levels AS (
  SELECT 0 AS i, 1.5::DOUBLE * sum(source_size)::DOUBLE / sum(w)::DOUBLE AS lam FROM src
  UNION ALL
  SELECT i + 1, (SELECT (1.5::DOUBLE * sum(source_size)::DOUBLE - coalesce(sum(cap) FILTER (cap <= levels.lam * w), 0)::DOUBLE)
                        / nullif(coalesce(sum(w) FILTER (cap > levels.lam * w), 0)::DOUBLE, 0) FROM src)
  FROM levels WHERE i < 60 AND lam IS NOT NULL),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, coalesce((SELECT arg_max(coalesce(lam, 1e300), i) FROM levels) * w, cap::DOUBLE)) AS target
  FROM src),
runs AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS rounds,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key RANGE UNBOUNDED PRECEDING) AS after,
         sum(s.size) OVER (PARTITION BY s.source, s.key) AS tie
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (rounds + CASE WHEN after - tie + after <= 2 * (target - rounds * source_size) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM runs
"""
