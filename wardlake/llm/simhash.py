"""SimHash near-duplicates, found through the anchors of covering codes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from wardlake.llm.common import DOCUMENT_COLUMNS, checkpointed, looked_up, row_key, table, worker_state

SHINGLE, SEED, THRESHOLD = 4, 42, 4
#: Rows of an anchor beyond which blocks of the other half are part of what its rows are shuffled by.
ANCHOR_ROWS = 40_000
#: Rows that are compared in one task; more of them (so many near copies) are compared in a grid of such blocks.
CELL_ROWS = 200_000
_lanes = np.uint64(0x0101010101010101)


def simhash(text: str | None) -> int:
    """64-bit fingerprint, as a signed integer, of the shingles of the whole text; without words it is 0."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z alone change, ASCII white space splits
    if not words:
        return 0
    data = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(1, len(words) - SHINGLE + 1)
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(data[a:b], SEED) for a, b in zip(starts[:last].tolist(), ends[-last:].tolist(), strict=True)], dtype=np.uint64)
    blocks = np.zeros(-(-len(h) // 255) * 255, dtype=np.uint64)
    blocks[: len(h)] = h
    blocks = blocks.reshape(-1, 255)
    fingerprint = 0
    for b in range(8):  # bits b, b + 8, ... at once: each is summed in a byte of its own, 255 shingles at most
        lanes = ((blocks >> np.uint64(b)) & _lanes).sum(axis=1, dtype=np.uint64)
        counts = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for k in np.flatnonzero(2 * counts > len(h)):
            fingerprint |= 1 << (8 * int(k) + b)
    return fingerprint - (1 << 64) if fingerprint >> 63 else fingerprint


@F.pandas_udf(LongType())
def simhash_of(text: pd.Series) -> pd.Series:
    worker_state("simhash")
    return pd.Series([simhash(t) for t in text], dtype="int64")


#: Generator polynomials of the perfect binary codes, the (23, 12) Golay code and the (7, 4) Hamming code.
GOLAY, HAMMING = 0b101011100011, 0b1011


def remainder(x: np.ndarray, generator: int, length: int) -> np.ndarray:
    """Of polynomials with `length` bits: which coset of the code they are in."""
    degree = generator.bit_length() - 1
    for k in range(length - 1, degree - 1, -1):
        x = np.where((x >> k) & 1, x ^ (generator << (k - degree)), x)
    return x


def patterns(length: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All words of `length` bits with at most `most` ones, and their ones."""
    words = [sum(1 << i for i in c) for w in range(most + 1) for c in combinations(range(length), w)]
    return np.array(words, dtype=np.int64), np.array([x.bit_count() for x in words])


@cache
def cosets() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each coset of the product code: what to add to a word to get each near anchor, and whether it is its own.

    A half of a fingerprint is covered by Golay words on 23 bits, at most 3 away, and Hamming words on 7 bits, at most 1
    away; exactly one such anchor is its own. Two halves that differ in e bits at most are so near each other that one is
    within 3 + a and 1 + b of the other's own anchor, with a + b <= e. Two fingerprints that differ in 4 bits at most have a
    half in which they differ in 2 at most.
    """
    slack = THRESHOLD // 2
    (g, gw), (h, hw) = patterns(23, 3 + slack), patterns(7, 1 + slack)
    i, j = (a.ravel() for a in np.indices((len(g), len(h))))
    near = np.maximum(0, gw[i] - 3) + np.maximum(0, hw[j] - 1) <= slack
    i, j = i[near], j[near]
    coset = remainder(g, GOLAY, 23)[i] * 8 + remainder(h, HAMMING, 7)[j]
    order = np.argsort(coset, kind="stable")
    starts = np.searchsorted(coset[order], np.arange(2**14 + 1))
    return starts, (g[i] | h[j] << 23)[order], ((gw[i] <= 3) & (hw[j] <= 1))[order]


def near_anchors(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, own) for all anchors near each half of the fingerprints. An anchor's number holds its half."""
    starts, add, own = cosets()
    found = []
    for half in (0, 1):
        word = (fp.view(np.uint64) >> np.uint64(32 * half)).astype(np.int64) & 0x3FFFFFFF
        coset = remainder(word & 0x7FFFFF, GOLAY, 23) * 8 + remainder(word >> 23, HAMMING, 7)
        n = starts[coset + 1] - starts[coset]
        row = np.repeat(np.arange(len(fp)), n)
        at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[coset], n)
        found.append((row, (word[row] ^ add[at]) | (half << 30), own[at]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def anchored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        fp = b["fp"].to_numpy(np.int64)
        for i in range(0, len(fp), 2000):
            row, anchor, own = near_anchors(fp[i : i + 2000])
            yield pd.DataFrame({"anchor": anchor, "fp": fp[i : i + 2000][row], "own": own})


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what the links a-b join, at most one for each fingerprint that occurs."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    low = np.arange(len(names))
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            break
        low = new
    apart = low != np.arange(len(names))
    return names[apart], names[low[apart]]


def tested(group: np.ndarray, fp: np.ndarray, own: np.ndarray, at_once: int = 300_000) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links within groups, sorted by group: every own fingerprint against all of its group, as a forest of each batch."""
    first = np.searchsorted(group, group[own], "left")
    n = np.searchsorted(group, group[own], "right") - first
    left, upto = fp[own], np.concatenate([[0], np.cumsum(n)])
    out: list[tuple[np.ndarray, np.ndarray]] = []
    done = 0
    while done < len(left):
        end = max(done + 1, int(np.searchsorted(upto, upto[done] + at_once, "right")) - 1)
        m = n[done:end]
        x = np.repeat(left[done:end], m)
        at = np.arange(len(x)) - np.repeat(np.cumsum(m) - m, m) + np.repeat(first[done:end], m)
        differ = np.bitwise_count((x ^ fp[at]).view(np.uint64))
        near = (differ > 0) & (differ <= THRESHOLD)
        if near.any():
            out.append(forest(x[near], fp[at[near]]))
        done = end
    return out


#: How a half of 32 bits is cut to tell apart the rows of a large cell, as (blocks, blocks that must agree): THRESHOLD
#: differing bits leave at least that many blocks alike.
CUTS = ((5, 1), (6, 2), (8, 4))


def masks_of(blocks: int, alike: int) -> list[int]:
    """For each choice of `alike` blocks of a half, the bits that these blocks have."""
    edges = np.linspace(0, 32, blocks + 1).round().astype(int)
    masks = [((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return [sum(chosen) for chosen in combinations(masks, alike)]


def links_in(cell: np.ndarray, fp: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within cells, sorted by cell; the last bit of a cell's number names the half that its anchor is of.

    A small cell is compared row by row. The rows of a larger one differ in the other half: they are told apart by blocks
    of it, for every choice of blocks of which one must agree, so that the tests of a cell grow far slower than its square.
    """
    edges = np.flatnonzero(np.diff(cell)) + 1
    bounds = np.concatenate([[0], edges, [len(cell)]])
    mine = np.concatenate([[0], np.cumsum(own)])
    tests = np.diff(bounds) * np.diff(mine[bounds])
    large = np.flatnonzero(tests > 1 << 20)
    small = np.ones(len(cell), dtype=bool)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for k in large:
        at = slice(bounds[k], bounds[k + 1])
        small[at] = False
        word = (fp[at].view(np.uint64) >> np.uint64(0 if cell[bounds[k]] & 1 else 32)) & np.uint64(0xFFFFFFFF)
        rows = bounds[k + 1] - bounds[k]
        blocks, alike = min(CUTS, key=lambda c: comb(*c) * (30 * rows + tests[k] / 2 ** (32 * c[1] / c[0])))
        for mask in masks_of(blocks, alike):
            key = word & np.uint64(mask)
            order = np.argsort(key, kind="stable")
            out += tested(key[order], fp[at][order], own[at][order])
    out += tested(cell[small], fp[small], own[small])
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return forest(*(np.concatenate(x) for x in zip(*out, strict=True)))


def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by cell; whole cells are compared, many small ones at once."""
    held: list[pd.DataFrame] = []
    size = 0

    worker_state("simhash")

    def out(b: pd.DataFrame) -> pd.DataFrame:
        x, y = links_in(b["cell"].to_numpy(), b["fp"].to_numpy(np.int64), b["own"].to_numpy(bool))
        return pd.DataFrame({"a": x, "b": y})

    for b in batches:
        held.append(b)
        size += len(b)
        if size >= 100_000:
            b = pd.concat(held)
            whole = int(np.searchsorted(b["cell"].to_numpy(), b["cell"].iloc[-1], "left"))
            if whole:
                yield out(b.iloc[:whole])
                b = b.iloc[whole:]
            held, size = [b], len(b)
    if held:
        yield out(pd.concat(held))


def in_cells(rows: DataFrame, anchor_rows: int, cell_rows: int) -> DataFrame:
    """cell, fp, own: rows (anchor, fp, own) by what they are compared in. The last bit of a cell names the anchor's half.

    A small anchor is a cell. A large one has a cell for each choice of blocks of the other half and the bits of these
    blocks; of every two rows that link, one choice has the same bits, so each row is copied once for each choice: 5, 15 or
    70 times by the anchor's size, whatever the corpus. Only what is large even then is cut into a grid, own rows by one hash
    and all rows by another. There are 2^17 anchors, so the large ones' sizes are broadcast.
    """
    size = rows.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > anchor_rows)
    cut = F.lit(len(CUTS) - 1)
    for k, (blocks, alike) in reversed(list(enumerate(CUTS[:-1]))):  # the fewest copies that would halve a cell's bound, were bits even
        cut = F.when(F.col("n") <= cell_rows / 2 * 2 ** (32 * alike / blocks), k).otherwise(cut)
    large = checkpointed(size.select("anchor", cut.alias("cut")))
    half = F.shiftright("anchor", 30).bitwiseAND(F.lit(1).cast("long"))
    if large.isEmpty():
        return rows.select(F.shiftleft(F.xxhash64("anchor"), 1).bitwiseOR(half).alias("cell"), "fp", "own")
    keys = F.array(F.lit(0).cast("long"))
    for k, (blocks, alike) in enumerate(CUTS):
        low, high = (F.array(*[F.lit(int(np.uint64(m << by).view(np.int64))) for m in masks_of(blocks, alike)]) for by in (0, 32))
        alike_in = F.transform(F.when(half == 1, low).otherwise(high), lambda m: F.xxhash64(m, F.col("fp").bitwiseAND(m)))
        keys = F.when(F.col("cut") == k, alike_in).otherwise(keys)
    dealt = rows.join(F.broadcast(large), "anchor", "left").select("anchor", "fp", "own", "cut", F.explode(keys).alias("key"))
    named = dealt.select(F.shiftleft(F.xxhash64("anchor", "key"), 1).bitwiseOR(half).alias("cell"), "fp", "own", "cut")
    over = named.where("cut is not null").groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > cell_rows)
    over = checkpointed(over.select("cell", F.ceil(F.sqrt(F.col("n") / cell_rows) + 1).cast("long").alias("side")))
    if over.isEmpty():
        return named.select("cell", "fp", "own")
    one = F.lit(1).cast("long")
    cells = named.join(over, "cell", "left").withColumn("side", F.coalesce("side", one))
    at, steps = F.pmod(F.xxhash64("fp"), F.col("side")), F.sequence(one * 0, F.col("side") - 1)
    across = F.transform(steps, lambda k: F.struct((k * F.col("side") + at).alias("at"), F.lit(False).alias("own")))
    down = F.transform(steps, lambda k: F.struct((at * F.col("side") + k).alias("at"), F.lit(True).alias("own")))
    plain = F.array(F.struct((one * 0).alias("at"), F.col("own")))
    placed = F.when(F.col("side") == 1, plain).when(F.col("own"), F.concat(across, down)).otherwise(across)
    last = F.col("cell").bitwiseAND(one)
    cells = cells.select("cell", "fp", F.explode(placed).alias("c"))
    return cells.select(F.shiftleft(F.xxhash64("cell", "c.at"), 1).bitwiseOR(last).alias("cell"), "fp", F.col("c.own").alias("own"))


def links(fingerprints: DataFrame, anchor_rows: int = ANCHOR_ROWS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """a, b: links between distinct fingerprints (column fp) that join all that differ in THRESHOLD bits or fewer.

    Each fingerprint goes to every anchor within the covering radius and the threshold of a half, and those whose own
    anchor it is are compared with all others there, in the cells of in_cells(). Within a cell only a forest of links is
    kept, so a large group of near copies gives no more links than it has fingerprints.
    """
    rows = fingerprints.select("fp").mapInPandas(anchored, "anchor long, fp long, own boolean")
    cells = in_cells(rows, anchor_rows, cell_rows)
    return cells.repartition("cell").sortWithinPartitions("cell").mapInPandas(compared, "a long, b long")


def components(pairs: DataFrame) -> DataFrame:
    """node, root: the smallest node that links a-b reach, for each node that has a link.

    Large-star and small-star steps by turns, each a grouped minimum looked up from the links, until the links are stars.
    Each step's links are written to the checkpoint folder. The links of a node that very many have (the smallest of a large
    group) stay where they lie: such nodes are few and are broadcast.
    """
    edges = checkpointed(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", "n", F.least("u", "m").alias("m"))
        large = looked_up(both, checkpointed(low), "u", "m").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = checkpointed(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = looked_up(large, checkpointed(least), "u", "m").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u != v").distinct()
        edges = checkpointed(small)
        new = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first()
        if new == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = new


def with_components(docs: DataFrame, doc_id: str, text: str, *more: str) -> DataFrame:
    """doc_id, the columns `more`, fp, root (a fingerprint, one for each component) and component_id for every row."""
    prints = checkpointed(docs.select(F.col(doc_id).alias("doc_id"), *more, simhash_of(F.col(text)).alias("fp")))
    distinct = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")))
    linked = components(links(distinct))
    rooted = distinct.join(linked.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = checkpointed(rooted)
    least = rooted.groupBy("root").agg(F.struct(F.min("first").alias("id")).alias("component"), F.count("*").alias("n"))
    named = looked_up(rooted.select("root", "fp", F.col("n").alias("rows")), checkpointed(least), "root", "component")
    found = named.select("fp", F.col("rows").alias("n"), F.struct("root", F.col("component.id").alias("component_id")).alias("of"))
    return looked_up(prints, checkpointed(found), "fp", "of").select("doc_id", *more, "fp", "of.root", "of.component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint and component_id for every row: component_id is the smallest doc_id that links reach.

    Documents link where their fingerprints differ in THRESHOLD bits or fewer. Null and empty texts and texts of white
    space have fingerprint 0. Repeated rows get equal values; rows with a null doc_id get the component of their
    fingerprint, which is null if it has no other. An empty table gives no rows. Exact copies meet as one fingerprint
    before anything is compared.
    """
    return with_components(docs, doc_id, text).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The document of each component with the smallest doc_id; where rows with other contents repeat that id, the one whose
    content has the smallest hash, so reruns agree. Of equal rows one stays. Rows with a null doc_id all stay. Null and
    empty texts are one group; columns that documents do not have are left out, whatever their names; an empty table stays
    empty; very long texts are hashed whole."""
    docs = docs.select(*DOCUMENT_COLUMNS).withColumn("_row", row_key(DOCUMENT_COLUMNS))
    named = with_components(docs, "doc_id", "text", "_row").where("doc_id is not null")
    firsts = named.groupBy("root").agg(F.min(F.struct("doc_id", "_row")).alias("one")).select("one._row")
    kept = docs.where("doc_id is not null").join(firsts, "_row", "left_semi").dropDuplicates(["_row"])
    return kept.unionByName(docs.where("doc_id is null")).drop("_row")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (null, empty and repeated ones: see near_duplicates)."""
    return near_duplicates(table(spark, sf_dir, "documents"))
