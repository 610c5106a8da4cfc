"""The trie of conversations' prefixes, by cutting sequences at half depth over and over.

A sequence of turns is cut into blocks of 2^k turns, each in two halves. The half above a cut is named by its contents, so
the sequences that share it share a name (`named`): upward, two halves' names make the block's, and downward, the name of
all that lies before a block and that of its upper half make the name of what lies before its lower half. Each step does all
cuts of one size at once, and as many steps as the longest sequence has binary digits name every prefix. Equal names are a
node. Totals are grafted back from the least blocks to the largest (`grafted`): at each cut the totals of the forest below it are added to
the nodes of the trie above it. No step holds a whole sequence, and none gathers the members of a node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlake.llm.common import SQL_CRC_TABLE, checkpointed, looked_up, sql_crc32, table

#: How conversations of a group borrow the first turns of its first one.
GROUP, MOST_BORROWED = 5, 9
ROOT = b"\x00" * 32
#: Characters of ids that a row of a node's list of members holds.
CHUNK = 1 << 20


def hashed(*parts: Column) -> Column:
    """32 bytes that stand for the parts; parts are of a fixed length but for the last one."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def turns_in_order(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """c, place (from 0, by turn, null first, then role and text), token (stands for role and text), size (bytes of text).

    Rows are dealt into ranges, of which a long conversation takes several, and numbered by what lies before each range.
    """
    clean = lambda x: F.coalesce(F.col(x).cast("string"), F.lit(""))
    keyed = rows.where(F.col(conv_id).isNotNull()).select(F.col(conv_id).cast("long").alias("c"), F.col(turn).alias("turn"), clean(role).alias("role"), clean(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    order = ["c", F.col("turn").asc_nulls_first(), "role", "text", "row"]  # `row` parts equal rows, so none are too many for a range
    sized = F.concat(F.lpad(F.hex(F.octet_length("role")), 16, "0").cast("binary"), F.col("role").cast("binary"))
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("c", hashed(sized, F.col("text").cast("binary")).alias("token"), F.octet_length("text").cast("long").alias("size"), F.monotonically_increasing_id().alias("at"))
    ranged = checkpointed(ranged.withColumn("part", F.shiftright("at", 33)))
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = ranged.groupBy("c", "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    spans = spans.select("c", "part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"))  # a row a range and conversation
    return ranged.join(spans, ["c", "part"]).select("c", (F.col("at") + F.col("shift")).alias("place"), "token", "size")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c, length: every conversation, turnless ones too; c, place, token, size: their turns, rebuilt). Each conversation
    begins with the first turns of its group's first one, as many as its id says, and goes on after as many of its own."""
    own = turns.groupBy("c").agg(F.count("*").alias("n")).withColumns({"base": F.col("c") - F.col("c") % GROUP, "h": F.crc32(F.col("c").cast("string").cast("binary")) % MOST_BORROWED})
    there = own.select(F.col("c").alias("base"), F.col("n").alias("base_n"))
    own = checkpointed(own.join(there, "base", "left").withColumn("head", F.least("h", F.coalesce("base_n", F.lit(0)))))
    lengths = own.select("c", (F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    borrowed = turns.where(F.col("place") < MOST_BORROWED - 1).withColumnRenamed("c", "base").join(own.select("c", "base", "head"), "base").where("place < head")
    kept = turns.join(own.select("c", "h", "head"), "c").where("place >= h").withColumn("place", F.col("place") - F.col("h") + F.col("head"))
    columns = ["c", "place", "token", "size"]
    return lengths, borrowed.select(columns).unionByName(kept.select(columns))


def named(lengths: DataFrame, turns: DataFrame) -> DataFrame:
    """c, depth (0 to the conversation's length), name: every prefix of every conversation; equal prefixes have equal names."""
    longest = lengths.agg(F.max("length")).first()[0] or 0
    steps = longest.bit_length()
    halves, block = [], turns.select("c", F.col("place").alias("j"), F.col("token").alias("name"))
    for k in range(steps):  # upward: what two halves hold
        if k:
            block = halves[-1].groupBy("c", F.shiftright("j", 1).alias("j")).agg(F.min_by("name", "j").alias("upper"), F.max_by("name", "j").alias("lower"), F.count("*").alias("both"))
            block = block.where("both = 2").select("c", "j", hashed(F.col("upper"), F.col("lower")).alias("name"))
        halves.append(checkpointed(block))
    blocks = lengths.select("c", "length", F.lit(0).cast("long").alias("j"), F.lit(ROOT).alias("above"))
    for k in reversed(range(steps)):  # downward: what lies before each half
        upper = halves[k].where("j % 2 = 0").select("c", F.shiftright("j", 1).alias("j"), F.col("name").alias("upper"))
        here = F.struct((F.col("j") * 2).alias("j"), F.col("above"))
        below = F.struct((F.col("j") * 2 + 1).alias("j"), hashed(F.col("above"), F.col("upper")).alias("above"))
        cut = F.shiftleft(F.col("j") * 2 + 1, k)
        two = F.when(cut <= F.col("length"), F.array(here, below)).otherwise(F.array(here))
        blocks = checkpointed(blocks.join(upper, ["c", "j"], "left").select("c", "length", F.explode(two).alias("half")).select("c", "length", "half.*"))
    return blocks.select("c", F.col("j").alias("depth"), F.col("above").alias("name"))


def grafted(nodes: DataFrame, paths: DataFrame, steps: int) -> DataFrame:
    """nodes (conv_id, depth, parent, leaves, saved: its own) with leaves and saved summed over each node's subtree. paths:
    c, depth, node, for every conversation that is a node's smallest member.

    With k from 0 on, leaves and saved hold what lies below a node within its block of 2^k depths. At a cut between two
    blocks the trees that begin there are summed by the node that they hang from, and its sum goes to the nodes from there
    up to the upper block's beginning.
    """
    for k in range(steps):
        half = 1 << k
        begin = nodes.where(F.col("depth") % (2 * half) == half)
        hung = begin.groupBy(F.col("parent").alias("c"), (F.col("depth") - 1).alias("cut")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        up = hung.select("c", F.explode(F.sequence(F.col("cut") - half + 1, F.col("cut"))).alias("depth"), "leaves", "saved")
        more = up.join(paths, ["c", "depth"]).groupBy(F.col("node").alias("conv_id"), "depth").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        sums = {"leaves": F.col("leaves") + F.coalesce("l", F.lit(0)), "saved": F.col("saved") + F.coalesce("s", F.lit(0))}
        nodes = checkpointed(nodes.join(more, ["conv_id", "depth"], "left").withColumns(sums).drop("l", "s"))
    return nodes


def ends_hashes(ends: DataFrame) -> DataFrame:
    """conv_id, depth, ends_sha256 of ends (conv_id, depth, c): the hash of each node's c, ascending and comma-joined.

    A node's list may be as long as the table: ranges join their parts of it to strings of CHUNK characters, and those are
    hashed one after the other, never held together.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, held, size = None, None, [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in ((node[0], pa.int64()), (node[1], pa.int64()), (first, pa.int64()), (",".join(held), pa.string()))], ["conv_id", "depth", "first", "ids"])

        for batch in batches:
            for a, b, c in zip(*[x.to_pylist() for x in batch.columns], strict=True):
                if node != (a, b) or size > CHUNK:
                    if held:
                        yield out()
                    node, first, held, size = (a, b), c, [], 0
                held.append(str(c))
                size += len(held[-1]) + 1
        if held:
            yield out()

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha, done = None, None, []

        def out() -> pa.RecordBatch:
            rows = [[r[k] for r in done] for k in range(3)]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, (pa.int64(), pa.int64(), pa.string()), strict=True)], ["conv_id", "depth", "ends_sha256"])

        for batch in batches:
            for a, b, ids in zip(*[batch.column(k).to_pylist() for k in (0, 1, 3)], strict=True):
                if node == (a, b):
                    sha.update(b"," + ids.encode())
                    continue
                if node:
                    done.append((*node, sha.hexdigest()))
                node, sha = (a, b), hashlib.sha256(ids.encode())
            if len(done) >= 5000:
                yield out()
        if node:
            done.append((*node, sha.hexdigest()))
        yield out()

    parts = ends.select("conv_id", "depth", "c").repartitionByRange("conv_id", "depth", "c").sortWithinPartitions("conv_id", "depth", "c").mapInArrow(joined, "conv_id long, depth long, first long, ids string")
    return parts.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first").mapInArrow(hashes, "conv_id long, depth long, ends_sha256 string")


def prefix_trie(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each distinct prefix of the rebuilt conversations, and one for the root: conv_id (the smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Null roles and texts count as empty, null turns come first, and rows of one turn follow each other by role and text;
    equal rows each count as a turn. Rows without a conversation's id belong to none and are left out. Other columns are left
    out, whatever their names; a very long text is hashed like any other. An empty table gives no rows, not even a root.
    """
    lengths, turns = rebuilt(turns_in_order(rows, conv_id, turn, role, text))
    lengths, turns = checkpointed(lengths), checkpointed(turns)
    names = checkpointed(named(lengths, turns))
    nodes = checkpointed(names.groupBy("name").agg(F.min("c").alias("conv_id"), F.first("depth").alias("depth"), F.count("*").alias("n_convs")))
    of = nodes.select("name", F.col("n_convs").alias("n"), F.col("conv_id").alias("node"))
    paths = checkpointed(looked_up(names, of, "name", "node").select("c", "depth", "node"))
    last = turns.select(F.col("c").alias("conv_id"), (F.col("place") + 1).alias("depth"), "size")
    above = paths.select(F.col("c").alias("conv_id"), (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    nodes = checkpointed(nodes.drop("name").join(last, ["conv_id", "depth"], "left").join(above, ["conv_id", "depth"], "left"))
    below = nodes.where("depth > 0").groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(below, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    own = {"leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.coalesce("size", F.lit(0))}
    nodes = checkpointed(nodes.withColumns(own).drop("size"))
    longest = nodes.agg(F.max("depth")).first()[0] or 0
    least = checkpointed(paths.join(nodes.select(F.col("conv_id").alias("c")).distinct(), "c", "left_semi"))
    nodes = grafted(nodes, least, longest.bit_length())
    ends = lengths.select("c", F.col("length").alias("depth")).join(paths, ["c", "depth"]).select(F.col("node").alias("conv_id"), "depth", "c")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    out = nodes.join(ends_hashes(ends), ["conv_id", "depth"], "left")
    return out.select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256"))


def op13_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations (nulls, ties and equal rows: see prefix_trie)."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


def trie_sql() -> str:
    """op13_prefixes in DuckDB SQL, by its definition: every prefix as a list, every node under all of its own prefixes."""
    return f"""with {SQL_CRC_TABLE},
own as (select conv_id as c, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}} order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as s from conversations where conv_id is not null group by 1),
heads as (select c, s, cast({sql_crc32("cast(c as varchar)")} % {MOST_BORROWED} as int) as h from own, crc),
seqs as (select o.c, list_concat(case when h > 0 then coalesce(b.s[1:h], []) else [] end, o.s[h + 1:]) as s from heads o left join own b on b.c = o.c - o.c % {GROUP}),
prefixes as (select c, d, s[1:d] as p, d = len(s) as ends from (select c, s, unnest(range(0, len(s) + 1)) as d from seqs)),
nodes as (select d, p, min(c) as conv_id, count(*) as n_convs, sha256(coalesce(string_agg(case when ends then cast(c as varchar) end, ',' order by c), '')) as ends_sha256, (count(*) - 1) * coalesce(any_value(strlen(p[d].x)), 0) as saved from prefixes group by 1, 2),
kids as (select p[1:d - 1] as p, d - 1 as d, count(*) as n_children from nodes where d > 0 group by 1, 2),
full_nodes as (select n.*, coalesce(n_children, 0) as n_children from nodes n left join kids k on n.d = k.d and n.p = k.p),
under as (select a as d, p[1:a] as p, sum(saved) as saved, count(case when n_children = 0 then 1 end) as leaves from (select p, saved, n_children, unnest(range(0, d + 1)) as a from full_nodes) group by 1, 2)
select n.conv_id, n.d as depth, up.conv_id as parent_conv_id, n.n_convs, n.n_children, u.leaves as n_leaves, cast(u.saved as bigint) as saved_tokens, n.ends_sha256
from full_nodes n join under u on n.d = u.d and n.p = u.p left join nodes up on up.d = n.d - 1 and up.p = n.p[1:n.d - 1]"""
