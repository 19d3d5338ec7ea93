"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. Sizes are summed by source and targets follow from weights and caps.
2. The documents of a source are dealt into blocks by a keyed hash. A block holds
   about ``BLOCK_WORDS`` words; the number of blocks follows from the source's size,
   so that a source with a third of all rows is many blocks, not one group.
3. A target is a number of whole passes over a source and a part of one more pass, a
   run of its blocks in permuted order. The last block of the run is taken in part,
   document by document. These draws are the source's exact quota of blocks.
4. The quotas are split down a binary tree over the output shards. At each node the
   left half gets its exact share of the node's blocks, drawn without replacement
   from all of them, so that the counts by source are multivariate hypergeometric.
5. Each shard takes the next blocks of a source's permuted order, as many as its
   quota says: blocks are disjoint, and passes over the same block lie far apart.
6. Documents are ordered by a keyed hash inside their shard.

Everything is built of DataFrame functions. The tables of blocks and draws are the
only ones a window sees by source or by node; with a block of at least one part in
``MAX_BLOCKS`` of the whole, they have a bounded number of rows. Reruns agree, as all
choices are hashes of a seed and of the rows themselves.

Null texts have size zero, a null source is a source of its own and comes last,
repeated rows are documents of their own, an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partatlas.llm.quality import words_of
from partatlas.session import materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
BLOCK_WORDS = 1 << 14
BLOCK_DOCS = 1 << 12
MAX_BLOCKS = 1 << 20
BLOCKS_PER_SHARD = 64
SEED = 9


def _key(*parts: Column | str) -> Column:
    return F.xxhash64(F.lit(SEED), *parts)


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``size`` and ``key``, the hash that orders documents."""
    return docs.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        F.size(words_of(F.col("text"))).cast("long").alias("size"), _doc_key().alias("key"))


def _doc_key() -> Column:
    return _key("doc_id", "source", "text")


def targets(sized: DataFrame) -> DataFrame:
    """One row per source: ``source_size``, ``target`` and ``n_blocks``.

    Sources in order of code points, null last, weigh 3, 1, 2, 3, … and share
    ``SHARE`` times all sizes. Shares above ``CAP`` times a source's size stop there
    and the excess goes to the others by weight. With sources in order of cap by
    weight, the ones that stop are a prefix; its end is found from running sums.
    The table has one row per source.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    everything = Window.partitionBy(F.lit(0))
    position = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in WEIGHTS]), position % len(WEIGHTS))
    weighed = by_source.select(
        "*", weight.alias("weight"), (CAP * F.col("source_size")).cast("double").alias("cap"),
        F.sum("source_size").over(everything).alias("all_size"), F.sum("n_docs").over(everything).alias("all_docs"))
    by_cap = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    left = SHARE * F.col("all_size") - F.coalesce(F.sum("cap").over(before), zero)
    weights_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), zero)
    level = weighed.select("*", (left / weights_left).alias("level"))
    # The first source that its share does not fill sets the level for the rest.
    fits = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(
        (F.col("cap") / F.col("weight")).alias("at"), F.col("level").alias("level")))).over(everything)
    block_words = F.greatest(F.lit(BLOCK_WORDS), F.ceil(F.col("all_size") / MAX_BLOCKS))
    block_docs = F.greatest(F.lit(BLOCK_DOCS), F.ceil(F.col("all_docs") / MAX_BLOCKS))
    return level.select(
        "source", "source_size",
        F.least(F.col("cap"), fits["level"] * F.col("weight")).alias("target"),
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words), F.ceil(F.col("n_docs") / block_docs))
        .cast("long").alias("n_blocks"))


def block_draws(blocks: DataFrame, plan: DataFrame) -> DataFrame:
    """Draws of blocks that fill each target: ``source``, ``block``, ``pass``, ``part``
    (words to take, null for all) and ``turn``, the place in the source's order."""
    order = Window.partitionBy("source").orderBy(_key("source", "block"), "block")
    run = order.rowsBetween(Window.unboundedPreceding, -1)
    passes = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1))).cast("int")
    placed = blocks.alias("b").join(plan.alias("p"), F.col("b.source").eqNullSafe(F.col("p.source"))).select(
        "b.source", "block", "words", passes.alias("passes"),
        (F.col("target") - passes * F.col("source_size")).alias("rest"))
    placed = placed.select("*", F.coalesce(F.sum("words").over(run), F.lit(0)).alias("upto"))
    more = F.col("rest") > F.col("upto")
    drawn = placed.select(
        "source", "block", "words", "upto", "rest",
        F.explode(F.sequence(F.lit(0), F.col("passes"))).alias("pass"), "passes",
    ).filter((F.col("pass") < F.col("passes")) | more).select(
        "source", "block", "pass",
        F.when((F.col("pass") == F.col("passes")) & (F.col("rest") < F.col("upto") + F.col("words")),
               F.col("rest") - F.col("upto")).alias("part"))
    turn = Window.partitionBy("source").orderBy("pass", _key("source", "block"), "block")
    return drawn.select("*", F.row_number().over(turn).alias("turn"))


def split_quotas(draws: DataFrame, n_shards: int) -> DataFrame:
    """``source``, ``turn`` and ``shard``: the quotas of blocks split down the tree.

    A node is a range of shards, ``low`` up to ``high``. It keeps the exact share of
    its slots for its left half, drawn by a keyed hash, and passes on the rest.
    """
    slots = draws.select("source", "turn", F.lit(0).alias("low"), F.lit(n_shards).alias("high"))
    level = 0
    while 1 << level < n_shards:
        node = Window.partitionBy("low", "high")
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        quota = F.floor(F.count("*").over(node) * (middle - F.col("low")) / (F.col("high") - F.col("low")))
        drawn = F.row_number().over(node.orderBy(_key(F.lit(level), "source", "turn"), "source", "turn"))
        wide = F.col("high") - F.col("low") > 1
        slots = slots.select("*", middle.alias("middle"), (drawn <= quota).alias("left")).select(
            "source", "turn",
            F.when(wide & ~F.col("left"), F.col("middle")).otherwise(F.col("low")).alias("low"),
            F.when(wide & F.col("left"), F.col("middle")).otherwise(F.col("high")).alias("high"))
        level += 1
    in_shard = Window.partitionBy("source").orderBy("low", "turn")
    return slots.select("source", F.row_number().over(in_shard).alias("turn"), F.col("low").alias("shard"))


def draw_documents(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``key``, ``size``, ``source_size``,
    ``target`` and ``shards``, the output shard of each time the mix takes it."""
    sized = materialize(sizes(docs), "mix-sizes")
    plan = materialize(targets(sized), "mix-targets")
    dealt = sized.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source"))).select(
        "d.*", "source_size", "target", F.pmod("key", "n_blocks").alias("block"))
    blocks = dealt.groupBy("source", "block").agg(F.sum("size").alias("words"))
    draws = materialize(block_draws(blocks, plan), "mix-draws")
    n_shards = max(1, -(-draws.count() // BLOCKS_PER_SHARD))
    slots = split_quotas(draws, n_shards)
    placed = draws.alias("a").join(
        slots.alias("s"),
        F.col("a.source").eqNullSafe(F.col("s.source")) & (F.col("a.turn") == F.col("s.turn")),
    ).groupBy("a.source", "block").agg(F.sort_array(F.collect_list(F.struct("shard", "pass", "part"))).alias("draws"))
    within = Window.partitionBy("source", "block").orderBy(_key("key"), "doc_id")
    ordered = dealt.select("*", F.coalesce(
        F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("upto"))
    # Of a block taken in part, documents stay while half of the next one still fits.
    fits = lambda x: x["part"].isNull() | (F.col("upto") + F.col("size") / 2 <= x["part"])
    return ordered.alias("o").join(
        placed.alias("q"),
        F.col("o.source").eqNullSafe(F.col("q.source")) & (F.col("o.block") == F.col("q.block")), "left",
    ).select(
        "doc_id", "key", "size", "source_size", "target",
        F.transform(F.filter(F.coalesce("draws", F.array().cast("array<struct<shard:int,pass:int,part:double>>")), fits),
                    lambda x: x["shard"]).alias("shards"))


def mix_table(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` of every document."""
    return draw_documents(docs.select("doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself: column ``row`` holds a document's columns, once for each time it
    is taken, beside its ``shard``; rows are partitioned by shard and shuffled inside.
    """
    # A null id gets a name of its own, so that grouping and join need one shuffle of rows.
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name")
    drawn = draw_documents(docs.select("doc_id", "source", "text")).groupBy("key", name).agg(
        F.flatten(F.collect_list("shards")).alias("shards")).filter(F.size("shards") > 0)
    rows = docs.select(
        _doc_key().alias("key"), name, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    # Rows that repeat an id and a text stand for as many draws.
    one = rows.groupBy("key", "name").agg(F.first("row").alias("row"))
    return (
        one.join(drawn, ["key", "name"])
        .select("row", "key", F.posexplode("shards").alias("time", "shard"))
        .repartition("shard")
        .sortWithinPartitions("shard", _key("shard", "key", "time"), "key", "time")
        .select("shard", "row")
    )


def mix_rows(docs: DataFrame) -> DataFrame:
    """The mix with the columns of ``docs``."""
    return mix(docs).select("row.*")
