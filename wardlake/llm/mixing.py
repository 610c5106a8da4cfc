"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations alone."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlake.llm.common import DOCUMENT_COLUMNS, WORD, checkpointed, row_key, table

WEIGHTS = (5.0, 2.0, 1.0)
MOST_EPOCHS = 3
BLOCK_WORDS = 256
#: So many sources at most are broadcast to their documents; more are joined by a shuffle.
FEW = 50_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


@dataclass
class Mix:
    """stream: every row once, with doc_id, source, key, size, first (its place in its source's shuffled stream of words) and
    its source's source_size, target, goal (target in whole words) and slots.
    pieces: position, key, rank, doc_id, first, epoch, start, length: the words that each slot of the schedule takes."""

    stream: DataFrame
    pieces: DataFrame


def running(df: DataFrame, order: list[Column], place: str, **sums: str) -> DataFrame:
    """df with `place`, the row's number from 0 in this order, and for each new name the sum of a column over the rows before
    it. Rows are cut into ranges of the order, and only the ranges' totals meet in one task."""
    cut = checkpointed(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    parts = Window.partitionBy("_all").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ones = {place: F.lit(1).cast("long"), **{name: F.col(c) for name, c in sums.items()}}
    totals = cut.groupBy("_part").agg(*[F.sum(c).alias(f"_{name}") for name, c in ones.items()]).withColumn("_all", F.lit(1))
    totals = totals.select("_part", *[F.coalesce(F.sum(f"_{name}").over(parts), F.lit(0)).alias(f"_{name}") for name in ones])
    inside = cut.select("*", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(name) for name, c in ones.items()])
    return inside.join(F.broadcast(totals), "_part").withColumns({name: F.col(name) + F.col(f"_{name}") for name in ones}).drop("_part", *[f"_{name}" for name in ones])


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """sizes (key, source, source_size) with rank, weight and target.

    Sources by code point, null last, take the weights in turn and share all sizes by weight. A target stops at `most`
    times its source's size, and what is over is shared by weight again until none is above. With sources in order of
    size for each weight, those before some place are stopped and all from there on share one rate, so running sums find
    that place, however many sources there are.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = running(sizes, [F.col("source").asc_nulls_last()], "rank").withColumn("weight", w).withColumn("stop", F.col("source_size") * float(most)).withColumn("ratio", F.col("stop") / F.col("weight"))
    tight = running(ranked, [F.col("ratio"), F.col("rank")], "place", stopped="stop", passed="weight")
    whole = tight.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    rate = (F.lit(float(whole["size"] or 0)) - F.col("stopped")) / (F.lit(float(whole["weight"] or 0)) - F.col("passed"))
    at = tight.withColumn("rate", rate).where("rate <= ratio").agg(F.min(F.struct("place", "rate")).alias("at")).first()["at"]
    share = F.lit(at["rate"] if at else 0.0) * F.col("weight")
    return tight.withColumn("target", F.least("stop", share)).select("key", "source", "source_size", "rank", "weight", "target")


def copies(sized: DataFrame, most: int = 1 << 16) -> DataFrame:
    """sized (whose equal rows are one, with n) once for each row, as copy 0, 1, ...; a row that very many share is dealt out."""
    few = sized.where(F.col("n") <= most).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    each = sized.where(F.col("n") > most).withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / most)))).repartition("doc_id", "text_hash", "c")
    many = each.withColumn("copy", F.explode(F.sequence(F.col("c") * most, F.least("n", (F.col("c") + 1) * most) - 1))).drop("c")
    return few.unionByName(many)


def placed(sized: DataFrame, seed: int, spans: int = 4096) -> DataFrame:
    """sized with first: the words before the row in its source's stream, in the order of a hash of doc_id, text and copy.

    The stream is cut into spans of hashes; words are summed inside each span and over the spans' totals, so no task
    gets all rows of a source, nor all rows with a null or repeated doc_id.
    """
    rows = copies(sized).withColumn("h", F.xxhash64("doc_id", "text_hash", "copy", F.lit(seed))).withColumn("span", F.pmod(F.shiftright("h", 40), F.lit(spans)).cast("int"))
    inside = Window.partitionBy("key", "span").orderBy("h", "doc_id", "text_hash", "copy").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("key").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("key", "span").agg(F.sum("size").alias("words")).select("key", "span", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before"))
    return rows.withColumn("inside", F.sum("size").over(inside) - F.col("size")).join(totals, ["key", "span"]).select("doc_id", "source", "key", "size", (F.col("before") + F.col("inside")).alias("first"))


def schedule(sources: DataFrame, bits: int, spans_of: int = 14) -> DataFrame:
    """position, key, rank: the slots of each source in a van der Corput order.

    Point m of 2^bits lies at m / 2^bits on the line of cumulative targets and comes at the position whose bits are
    those of m reversed. A source's points are a range of m, made in chunks; its slots are ranked by position, in spans
    of positions and then over the spans' counts.
    """
    chunk = 1 << spans_of
    ranges = sources.where(F.col("to") > F.col("from")).select("key", "from", "to", F.explode(F.sequence(F.shiftright("from", spans_of), F.shiftright(F.col("to") - 1, spans_of))).alias("c"))
    m = F.explode(F.sequence(F.greatest("from", F.col("c") * chunk), F.least(F.col("to"), (F.col("c") + 1) * chunk) - 1))
    points = ranges.repartition("key", "c").select("key", m.alias("m"))
    position = F.conv(F.reverse(F.lpad(F.bin("m"), max(bits, 1), "0")), 2, 10).cast("long") if bits else F.col("m")
    slots = points.select("key", position.alias("position")).withColumn("span", F.shiftright("position", spans_of))
    inside = Window.partitionBy("key", "span").orderBy("position")
    before = Window.partitionBy("key").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    counts = slots.groupBy("key", "span").agg(F.count("*").alias("n")).select("key", "span", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return slots.withColumn("inside", F.row_number().over(inside) - 1).join(counts, ["key", "span"]).select("position", "key", (F.col("before") + F.col("inside")).alias("rank"))


def block_at(word: Column) -> Column:
    """The block that holds a word of a goal that is cut into `slots` blocks, the first `longer` of them a word longer."""
    long_words = F.col("longer") * (F.col("short") + 1)
    return F.when(word < long_words, F.floor(word / (F.col("short") + 1))).otherwise(F.col("longer") + F.floor((word - long_words) / F.greatest(F.col("short"), F.lit(1)))).cast("long")


def block_start(rank: Column) -> Column:
    return rank * F.col("short") + F.least(rank, F.col("longer"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS, most: int = MOST_EPOCHS, block_words: int = BLOCK_WORDS, seed: int = 23) -> Mix:
    """A mix of whole `docs` in which each source has its target of words, in the order of a low-discrepancy schedule.

    Each source's documents are shuffled by a hash into one stream of words, read again from its start when it ends. The
    schedule has a slot for each block_words words of the corpus; a source gets the slots whose points fall on its part of
    the line of cumulative targets, and its target is cut into as many blocks, equal to a word: its slot of rank r, counted
    by position, takes block r of the stream. So each source's words equal its target rounded to a word, and no document is
    taken more than `most` times. A source on whose part no point falls (its target is less than a block) has one slot
    after all others.

    Nothing here depends on how rows lie in files, so reruns agree. Null and empty texts have no words and are not taken; a
    null source is a source of its own; repeated rows and null or repeated ids are documents of their own; very long texts
    span many slots; other columns are left out, whatever their names; an empty table gives an empty mix. Over a corpus of
    many TB pass larger blocks: the schedule has one slot for each.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"), F.xxhash64(F.col(text).isNull(), F.col(text)).alias("text_hash"))
    sized = checkpointed(rows.groupBy("doc_id", "source", "size", "text_hash").agg(F.count("*").alias("n")).withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))))
    sizes = checkpointed(sized.groupBy("key", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")))
    goals = running(source_targets(sizes, weights, most).withColumn("goal", F.round("target").cast("long")), [F.col("rank")], "place", ahead="goal")
    total = goals.agg(F.sum("goal")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, total / block_words))))
    scale = float(1 << bits) / max(1, total)
    sources = checkpointed(
        goals.withColumn("from", F.ceil(F.col("ahead") * scale))
        .withColumn("to", F.least(F.ceil((F.col("ahead") + F.col("goal")) * scale), F.lit(1 << bits)))
        .withColumn("points", F.greatest(F.col("to") - F.col("from"), F.lit(0)))
        .withColumn("slots", F.when(F.col("goal") > 0, F.greatest("points", F.lit(1))).otherwise(0).cast("long"))
        .withColumn("short", F.floor(F.col("goal") / F.greatest("slots", F.lit(1))))
        .withColumn("longer", F.col("goal") - F.col("short") * F.col("slots"))
    )
    known = sources.select("key", "source_size", "target", "goal", "slots", "short", "longer")
    stream = placed(sized, seed).join(F.broadcast(known) if sources.count() <= FEW else known, "key")
    closing = sources.where("points = 0 and slots = 1").select((F.lit(1 << bits) + F.col("rank")).cast("long").alias("position"), "key", F.lit(0).cast("long").alias("rank"))
    slots = schedule(sources.where("goal > 0"), bits).unionByName(closing)
    taken = (
        stream.where("size > 0 and first < goal")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("goal") - F.col("first") - 1) / F.col("source_size")))))
        .withColumn("begin", F.col("epoch") * F.col("source_size") + F.col("first"))
        .withColumn("end", F.least(F.col("begin") + F.col("size"), F.col("goal")))
        .withColumn("rank", F.explode(F.sequence(block_at(F.col("begin")), block_at(F.col("end") - 1))))
        .withColumn("low", F.greatest("begin", block_start(F.col("rank"))))
        .withColumn("high", F.least("end", block_start(F.col("rank") + 1)))
        .select("key", "rank", "doc_id", "first", "epoch", (F.col("low") - F.col("begin")).alias("start"), (F.col("high") - F.col("low")).alias("length"))
    )
    return Mix(stream, slots.join(taken, ["key", "rank"]))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix, with the columns of documents: one row for each time that a document is taken, in the order
    of the schedule (by their first slots; partitions are ranges of positions, sorted).

    All but each source's last take hold the whole text; that one holds the words up to where the source's target
    ends. Every row is a document of its own, as in mix(), also where ids are null or repeated; documents not taken go, and
    so do those without words. Other columns are left out, whatever their names. An empty table gives no rows. Rows are
    named by what they hold, and equal rows by their place in the stream too.
    """
    docs = docs.select(*DOCUMENT_COLUMNS).withColumn("_row", row_key(DOCUMENT_COLUMNS))
    takes = mix(docs, doc_id="_row", **how).pieces.groupBy(F.col("doc_id").alias("_row"), "first", "epoch").agg(F.sum("length").alias("words"), F.min("position").alias("position"))
    docs = docs.dropDuplicates(["_row"])  # equal rows: each has takes of its own
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    cut = F.array_join(F.slice(words, F.lit(1), F.col("words").cast("int")), " ")
    kept = docs.join(takes, "_row").withColumn("text", F.when(word_count(F.col("text")) > F.col("words"), cut).otherwise(F.col("text")))
    ordered = kept.repartitionByRange("position", "_row").sortWithinPartitions("position", "_row")
    return ordered.withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT_COLUMNS)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, and the first and last position of the schedule at which it does (null if none)."""
    out = mix(table(spark, sf_dir, "documents"))
    taken = out.pieces.groupBy("key", "first").agg(F.sum("length").alias("taken"), F.min("position").alias("first_position"), F.max("position").alias("last_position"))
    columns = ["doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_position", "last_position"]
    some = out.stream.where("size > 0").join(taken, ["key", "first"], "left").select(*columns)  # key and first name a row with words
    none = {"taken": F.lit(0), "first_position": F.lit(None).cast("long"), "last_position": F.lit(None).cast("long")}
    return some.unionByName(out.stream.where("size = 0").withColumns(none).select(*columns))
