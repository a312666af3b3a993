"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations.

Each source's documents are shuffled into a stream of words, gone through up to twice
and cut into blocks of equal length. The schedule is a sequence of slots: points of the
golden-ratio sequence fall into the sources' cumulative shares, the slots of a source
are ranked, and the slot of rank ``k`` takes the source's block ``k``. So at every
length of the schedule each source has its share, and its number of blocks is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docflow.llm.common import WORD, staged

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
#: The sources share this multiple of all words, and a source at most this of its own.
TOTAL, MOST = 1.5, 2
#: Words of a block.
BLOCK = 1024
#: The golden ratio's fraction in 32 bits.
GOLDEN, RANGE = 1640531527, 1 << 32
#: Equal intervals of the unit range in which a slot looks for its source.
BINS = 4096
#: Slots ranked within one group.
CHUNK = 1 << 16
SEED = "mix"


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``.

    Sources by code point, null last, weigh 5, 2, 1, repeating. They share ``TOTAL``
    times all words; no target exceeds ``MOST`` times its source, the excess goes to the
    others by weight. That is one level for all: a source gets weight times level or its
    own maximum, and the sources that get their maximum are those with the least room per
    weight. Totals of sources are whole numbers, so the result does not depend on order.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    number = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (number - 1) % len(WEIGHTS) + 1)
    weighed = sources.withColumn("weight", weight.cast("long")).withColumn("room", MOST * F.col("source_size"))
    by_room = W.orderBy(F.col("room") / F.col("weight"), "weight", F.col("source").asc_nulls_last())
    before, everything = by_room.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    left = (F.lit(round(TOTAL * 2)) * F.sum("source_size").over(everything) - 2 * F.coalesce(F.sum("room").over(before), F.lit(0))) / F.lit(2.0)
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    # Rooms only grow relative to weights, so once one source has enough room, all later ones have.
    open_share = left / weights
    closed = F.col("room") <= F.col("weight") * open_share
    levelled = weighed.withColumn("open_share", F.when(~closed, open_share))
    level = F.first("open_share", ignorenulls=True).over(by_room.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    target = F.least(F.col("room").cast("double"), F.coalesce(F.col("weight") * level, F.col("room").cast("double")))
    return levelled.select("source", "source_size", target.alias("target"))


def _running(rows: DataFrame, value: str, keys: list[str], part: str, order: list) -> DataFrame:
    """``rows`` with ``before``: the sum of ``value`` over earlier rows of the same keys.

    Two levels of windows: within a part of a key, and over the parts' sums, so that a
    key with very many rows is no single group.
    """
    parts = rows.groupBy(*keys, part).agg(F.sum(value).alias("_sum"))
    earlier = W.partitionBy(*keys).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select(*keys, part, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    within = W.partitionBy(*keys, part).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    summed = rows.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return summed.join(offsets, [*keys, part]).withColumn("before", F.col("_offset") + F.col("_within")).drop("_offset", "_within")


def schedule(spark: SparkSession, quotas: DataFrame) -> DataFrame:
    """``slot, source_no, rank`` from ``source_no, blocks``: exactly ``blocks`` slots each.

    The golden-ratio points give every source its number of slots but for a few. Slots
    beyond a source's blocks go, in their order, to the blocks that are left over.
    """
    total = quotas.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0]
    until = F.sum("blocks").over(W.orderBy("source_no"))
    # Whole-number shares of the 32-bit range; decimals keep the product exact.
    edge = lambda c: F.floor(c.cast("decimal(20,0)") * RANGE / max(total, 1)).cast("long")
    shares = quotas.select("source_no", "blocks", edge(until - F.col("blocks")).alias("low"), edge(until).alias("high")).where("high > low")
    width = RANGE // BINS
    binned = shares.withColumn("bin", F.explode(F.expr(f"sequence(low div {width}, (high - 1) div {width})")))
    slots = spark.range(total).toDF("slot").withColumn("point", (F.col("slot") % RANGE * GOLDEN) % RANGE)
    slots = slots.withColumn("bin", F.expr(f"point div {width}"))
    placed = slots.join(binned, "bin").where("point >= low AND point < high").select("slot", "source_no", "blocks", F.lit(1).alias("one"))
    placed = placed.withColumn("chunk", F.expr(f"slot div {CHUNK}"))
    ranked = staged(_running(placed, "one", ["source_no"], "chunk", ["slot"]).withColumnRenamed("before", "rank"), "slots")
    kept = ranked.where("rank < blocks").select("slot", "source_no", "rank")
    filled = kept.groupBy("source_no").agg(F.count("*").alias("filled"))
    missing = quotas.join(filled, "source_no", "left").withColumn("filled", F.coalesce("filled", F.lit(0))).where("filled < blocks")
    missing = missing.select("source_no", F.explode(F.expr("sequence(filled, blocks - 1)")).alias("rank"))
    # The discrepancy of the sequence bounds these two: some slots per source.
    number = lambda *order: F.row_number().over(W.orderBy(*order))
    surplus = ranked.where("rank >= blocks").select("slot", number("slot").alias("n"))
    moved = missing.withColumn("n", number("source_no", "rank")).join(surplus, "n").select("slot", "source_no", "rank")
    return kept.unionByName(moved)


def mixed(docs: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The mix as documents and as a schedule.

    First: ``doc_id, key, size, source_size, target, taken, first_slot, slots`` per row of
    ``docs``, where ``key`` is a hash of the text and ``taken`` counts the words that the mix
    takes, repeats included: 0 to twice its size. ``slots`` is the number of pieces in which
    they are taken, and ``first_slot`` the first slot with one; null if there is none.
    Second: ``slot, source, rank, doc_id, start, words``: in slot order, the words from
    ``start`` of a document that the slot takes. A source's words are its target, rounded
    down. Reads ``doc_id``, ``text`` and ``source``; a null text or one without words has
    size 0 and is in no slot; a null source is a source of its own and the last; repeated
    rows are separate documents; an empty table gives no rows.
    """
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    order = F.md5(F.concat_ws("|", F.lit(SEED), F.col("doc_id").cast("string")))
    rows = staged(docs.select("doc_id", F.xxhash64("text").alias("key"), "source", size.alias("size"), order.alias("order")), "sizes")
    named = staged(targets(rows).withColumn("source_no", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))), "targets")
    limits = named.select("source_no", F.floor("target").cast("long").alias("limit"), "source_size")
    quotas = limits.select("source_no", F.ceil(F.col("limit") / block).cast("long").alias("blocks"))
    slots = schedule(spark, quotas)
    numbered = rows.join(named, rows["source"].eqNullSafe(named["source"])).drop(named["source"])
    filled = numbered.where("size > 0").withColumn("part", F.substring("order", 1, 4))
    streams = _running(filled, "size", ["source_no"], "part", ["order", "doc_id", "size", "key"])
    # Both rounds of the stream, cut at the target, then into blocks.
    rounds = streams.withColumn("round", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("first", F.expr("before + round * source_size"))
    rounds = rounds.withColumn("end", F.expr("least(first + size, cast(floor(target) AS bigint))")).where("end > first")
    pieces = rounds.withColumn("rank", F.explode(F.expr(f"sequence(first div {block}, (end - 1) div {block})")))
    pieces = pieces.withColumn("from", F.greatest("first", F.col("rank") * block)).withColumn("to", F.least("end", (F.col("rank") + 1) * block))
    taken = pieces.join(slots, ["source_no", "rank"]).withColumn("words", F.col("to") - F.col("from"))
    plan = taken.select("slot", "source", "rank", "doc_id", (F.col("from") - F.col("first")).alias("start"), "words")
    # ``before`` is another one for each document with words of a source.
    sums = taken.groupBy("source_no", "before").agg(
        F.sum("words").alias("taken"), F.min("slot").alias("first_slot"), F.count("*").alias("slots")
    )
    columns = ["doc_id", "key", "size", "source_size", "target"]
    none = F.lit(0).cast("long")
    counted = streams.join(sums, ["source_no", "before"], "left").select(
        *columns, F.coalesce("taken", none).alias("taken"), "first_slot", F.coalesce("slots", none).alias("slots")
    )
    empty = numbered.where("size = 0").select(*columns, none.alias("taken"), F.lit(None).cast("long").alias("first_slot"), none.alias("slots"))
    return counted.unionByName(empty), plan
