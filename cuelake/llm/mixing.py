"""Mix sources to target weights: fixed blocks, drawn per output shard, joined by index.

Words of a source are packed, in an order given by hashes, into blocks of `block` words. The mix
is a sequence of slots, dealt to output shards; every slot draws a source and takes one block of it.
Draws are multinomial conditioned on the totals that meet the targets: a keyed permutation of all
slots deals each source's share out, so that the counts of a shard are random and their sums are
exact. The n-th slot of a source maps, through that source's pseudorandom permutation of block
indexes (another one for each pass), to the block it takes. All of it is arithmetic on indexes,
so reruns agree, shards can be made apart, and no source, however large, is sorted or held.

Texts are read once, for their sizes; the rest moves numbers. A hot source is split: offsets are
sums inside (source, hash range) chunks plus sums over chunks; blocks join on (source, index).

Defined cases: a null or empty text has size 0 and is never taken; a null source is a source of its
own, last in order; repeated rows are packed one by one; null ids are kept; an empty table gives no
rows; if all sizes are 0, targets are 0; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cuelake.llm.common import SPACE, read, stage

BLOCK = 64
SHARD = 4096
CHUNKS = 4096
ROUNDS = 12


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, mark): mark orders the rows of a source."""
    size = F.coalesce(F.regexp_count("text", F.lit(SPACE)), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), size.alias("size"), F.xxhash64("doc_id").alias("mark"))


def targets(rows: DataFrame, cap: int = 3) -> DataFrame:
    """(source, rank, n_docs, source_size, target): weights 1, 2, 3, repeating, by code point order.

    Sharing an excess again until none is above its cap ends at min(cap, level * weight) with one
    level for all: sources in the order of cap / weight, the level is where running sums meet the
    total. Only one row per source meets in a task.
    """
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = per.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("weight", (F.col("rank") % 3 + 1).cast("long")).withColumn("cap", F.col("source_size") * cap)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    # The first source, in this order, that its level leaves below the cap fixes the level.
    held = ranked.withColumn("level", level)
    held = held.withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct((F.col("cap") / F.col("weight")).alias("at"), F.col("rank"), F.col("level").alias("level")))).over(every)["level"])
    target = F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")))
    return held.select("source", F.col("rank").cast("long").alias("rank"), "source_size", target.alias("target"))


def plan(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """targets() with n_blocks, n_slots (those the source fills) and first_slot."""
    t = targets(rows).withColumn("n_blocks", F.ceil(F.col("source_size") / block).cast("long"))
    whole = F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0)).cast("long")
    rest = F.col("target") - whole * F.col("source_size")
    t = t.withColumn("n_slots", whole * F.col("n_blocks") + F.least(F.col("n_blocks"), F.round(rest / block).cast("long")))
    return t.withColumn("first_slot", F.coalesce(F.sum("n_slots").over(Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long"))


def pieces(rows: DataFrame, plans: DataFrame, block: int = BLOCK) -> DataFrame:
    """(rank, index, start, doc_id, n): the n words of a row that lie in block `index` of its source.

    `start` is the row's first word within its source, and names the row.
    """
    chunk = F.pmod("mark", F.lit(CHUNKS))
    laid = rows.join(plans.select("source", "rank"), rows["source"].eqNullSafe(plans["source"])).select("rank", "doc_id", "size", "mark", chunk.alias("chunk"))
    laid = laid.where("size > 0")
    sums = laid.groupBy("rank", "chunk").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("rank").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("rank", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("rank", "chunk").orderBy("mark", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    laid = laid.withColumn("off", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(sums, ["rank", "chunk"])
    laid = laid.select("rank", "doc_id", "size", (F.col("base") + F.col("off")).alias("start"))
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    cut = laid.withColumn("index", F.explode(F.sequence(first, last)))
    n = F.least(F.col("start") + F.col("size"), (F.col("index") + 1) * block) - F.greatest("start", F.col("index") * block)
    return cut.select("rank", "index", "start", "doc_id", "size", n.alias("n"))


def permuted(index: str, n: str, keys: str, rounds: int = ROUNDS) -> Column:
    """A pseudorandom permutation of 0..n-1 applied to `index`, exact for every n.

    Each round pairs x with k - x mod n and swaps the pair or not, by one bit of a keyed hash of
    the pair. A fold over the rounds keeps the expression small.
    """
    other = f"pmod(pmod(xxhash64(r, 'pair', {keys}), {n}) - x, {n})"
    return F.expr(f"aggregate(sequence(1, {rounds}), {index}, (x, r) -> if((xxhash64(r, greatest(x, {other}), {keys}) & 1L) = 1L, {other}, x))")


def slots(spark: SparkSession, plans: DataFrame, shard: int = SHARD, seed: int = 11) -> DataFrame:
    """(shard, slot, rank, pass, index): what each slot of each output shard takes."""
    total = plans.agg(F.coalesce(F.sum("n_slots"), F.lit(0))).first()[0]
    wide = max(1, total // 1024)  # ranges of draws, to look a source up by equality
    drawn = spark.range(total).select(F.col("id").alias("at"), F.lit(total).cast("long").alias("total"), F.lit(seed).alias("seed"))
    drawn = drawn.withColumn("draw", permuted("at", "total", "seed")).withColumn("cell", F.floor(F.col("draw") / wide))
    held = plans.where("n_slots > 0").select("rank", "n_blocks", "n_slots", "first_slot")
    held = held.withColumn("cell", F.explode(F.sequence(F.floor(F.col("first_slot") / wide), F.floor((F.col("first_slot") + F.col("n_slots") - 1) / wide))))
    own = drawn.join(held, "cell").where("draw >= first_slot AND draw < first_slot + n_slots")
    own = own.withColumn("nth", F.col("draw") - F.col("first_slot"))
    own = own.select("at", "rank", "n_blocks", F.floor(F.col("nth") / F.col("n_blocks")).alias("pass"), (F.col("nth") % F.col("n_blocks")).alias("k"), "seed")
    own = own.withColumn("index", permuted("k", "n_blocks", "rank, pass, seed"))
    return own.select(F.floor(F.col("at") / shard).alias("shard"), (F.col("at") % shard).alias("slot"), "rank", "pass", "index")


def mixed(spark: SparkSession, docs: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, plans, mix); mix has, for each slot, the pieces of rows it takes:
    (shard, slot, rank, index, start, doc_id, size, n), start - within the source - naming the row."""
    rows = stage(sized(docs), "sizes")
    plans = stage(plan(rows, block), "plan")
    mix = slots(spark, plans).join(pieces(rows, plans, block), ["rank", "index"])
    return rows, plans, mix


def taken(spark: SparkSession, docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row."""
    rows, plans, mix = mixed(spark, docs, block)
    counts = mix.groupBy("rank", "start", "doc_id", "size").agg(F.sum("n").alias("taken"))
    # A row that no slot touches still comes back: rows and takes are summed by row, not joined.
    base = pieces(rows, plans, block).where(F.col("index") == F.floor(F.col("start") / block)).select("rank", "start", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    each = base.union(counts).groupBy("rank", "start", "doc_id", "size").agg(F.sum("taken").alias("taken"))
    none = rows.where("size = 0").join(plans.select("source", "rank"), rows["source"].eqNullSafe(plans["source"])).select("rank", F.lit(None).cast("long").alias("start"), "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    return each.union(none).join(plans.select("rank", "source_size", "target"), "rank").select("doc_id", "size", "source_size", "target", "taken")


def mixture(spark: SparkSession, docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix as word ranges: (shard, slot, source, doc_id, first_word, n_words), words from 0.

    A slot's ranges, in the order of `first_word` within its documents, make one block.
    """
    _, plans, mix = mixed(spark, docs, block)
    first = F.greatest(F.col("index") * block - F.col("start"), F.lit(0))
    return mix.select("shard", "slot", "rank", "doc_id", first.alias("first_word"), F.col("n").alias("n_words")).join(plans.select("rank", "source"), "rank").select("shard", "slot", "source", "doc_id", "first_word", "n_words")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(spark, read(spark, sf_dir, "documents"))
