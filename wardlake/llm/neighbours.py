"""Approximate nearest neighbours by cross-polytope hashing, with exact reranking."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from wardlake.llm.common import checkpointed, table

NEAREST = 5
#: The share of true neighbours that a plan must find for a sample of at most so many queries; above 0.9, as a sample errs.
GOAL, SAMPLED = 0.95, 128
#: The numbers of tables and of probes to each that a plan may have; where none of them is enough, buckets are doubled.
TABLES, PROBES = (2, 3, 4, 6, 8, 12, 16, 24, 36, 48), (4, 6, 8, 12, 18, 24, 36, 48, 72)
#: Entries that a bucket has on average; the number of buckets of a table follows from it.
BUCKET = 1024
#: Entries and queries of one bucket that one task compares at once; larger buckets are cut into a grid of such blocks.
BLOCK = 20_000
#: Large buckets that are looked up in a broadcast table; if there are more, they are joined by a shuffle.
FEW = 50_000
#: Queries with short lists look again into buckets of tables with so many bits less, until lists are full.
WIDER = 6
ROUNDS = 3


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, scaled to keep lengths. The number of columns is a power of two."""
    n, step = x.shape[1], 1
    while step < n:
        pairs = x.reshape(len(x), -1, 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(x), n)
        step *= 2
    return x / np.sqrt(n)


def widths(bits: int, dim: int) -> list[int]:
    """How many coordinates each hash function of a table looks at, so that the table has 2^bits buckets."""
    whole, out = int(math.log2(2 * dim)), []
    while bits > 0:
        out.append(1 << (min(bits, whole) - 1))
        bits -= whole
    return out or [1]


def buckets(x: np.ndarray, tables: int, probes: int, bits: int, seed: int) -> np.ndarray:
    """(row, table, probe): the buckets of unit vectors, the nearest first. A hash function rotates pseudo-randomly (sign
    flips and Hadamard transforms by turns) and names the signed axis nearest to the result; a table joins several. Further
    probes take the next axes, those first whose coordinates sum to most."""
    dim = 1 << max(0, (x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, dim - x.shape[1])))
    out = np.zeros((len(x), tables, probes), dtype=np.int64)
    for t in range(tables):
        sums, codes = np.zeros((len(x), 1)), np.zeros((len(x), 1), dtype=np.int64)
        for k, width in enumerate(widths(bits, dim)):
            rng = np.random.default_rng([seed, t, k])
            y = x
            for _ in range(ROUNDS):
                y = hadamard(y * rng.choice([-1.0, 1.0], dim))
            y = np.hstack([y[:, :width], -y[:, :width]])
            best = np.argsort(-y, axis=1, kind="stable")[:, : max(probes, 1)]
            high = np.take_along_axis(y, best, 1)
            pairs = list(product(range(sums.shape[1]), range(best.shape[1])))
            sums = np.stack([sums[:, i] + high[:, j] for i, j in pairs], 1)
            codes = np.stack([codes[:, i] * (2 * width) + best[:, j] for i, j in pairs], 1)
            order = np.argsort(-sums, axis=1, kind="stable")[:, :probes]
            sums, codes = np.take_along_axis(sums, order, 1), np.take_along_axis(codes, order, 1)
        out[:, t, : codes.shape[1]] = codes
        out[:, t, codes.shape[1] :] = codes[:, -1:]
    return out


def matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as rows in double precision, each divided by its largest component: no square overflows."""
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    return x / np.abs(x).max(1, keepdims=True)


def units(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def by_length(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, those with vectors of one length together."""
    dim = batch.column("dim").to_numpy()
    for d in np.unique(dim):
        yield batch.take(pa.array(np.flatnonzero(dim == d)))


def hashed(tables: int, probes: int, bits: int, seed: int, carried: list[str]):
    """For mapInArrow: tab, bucket, dim and the carried columns of each vector, once for each bucket that it is in or looks
    into."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in by_length(b):
                code = buckets(units(matrix(part.column("vector"))), tables, probes, bits, seed)
                for t in range(tables):
                    for p in range(probes):
                        at = np.arange(len(part)) if p == 0 else np.flatnonzero((code[:, t, :p] != code[:, t, p : p + 1]).all(1))
                        own = part if p == 0 else part.take(pa.array(at))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), t, np.int32)), pa.array(code[at, t, p]), own.column("dim"), *(own.column(c) for c in carried)], ["tab", "bucket", "dim", *carried])

    return rows


def rerank(keep: int):
    """For cogrouped cells: the `keep` nearest entries of the cell for each query, by exact cosines in double precision."""
    shape = pa.schema([("q_lo", pa.int64()), ("q_h", pa.int64()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))])

    def best(index: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(index) or not len(queries):
            return shape.empty_table()
        x, q = matrix(index["vector"]), matrix(queries["vector"])
        x_norm, q_norm = np.sqrt((x * x).sum(1)), np.sqrt((q * q).sum(1))
        ids = index["ids"].combine_chunks()
        lo = ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets[0].as_py()]
        q_lo, q_h, out = queries["lo"].to_numpy(), queries["h"].to_numpy(), []
        for i in range(0, len(q), 256):
            near = (q[i : i + 256] @ x.T) / x_norm
            cut = np.partition(near, len(x) - keep, axis=1)[:, len(x) - keep, None] if len(x) > keep else np.full((len(near), 1), -np.inf)
            k, at = np.nonzero(~np.isfinite(cut) | (near >= cut - 1e-9 * q_norm[i : i + 256, None]))
            exact = np.concatenate([(x[at[j : j + 8192]] * q[i + k[j : j + 8192]]).sum(1) for j in range(0, len(at), 8192)]) / (x_norm[at] * q_norm[i + k])
            order = np.lexsort((lo[at], -exact, k))
            k, at, exact = k[order], at[order], exact[order]
            top = np.arange(len(k)) - np.searchsorted(k, k, "left") < keep
            k, at, exact = k[top] + i, at[top], exact[top]
            out.append(pa.Table.from_arrays([pa.array(q_lo[k]), pa.array(q_h[k]), pa.array(exact), ids.take(pa.array(at))], schema=shape))
        return pa.concat_tables(out)

    return best


def brute_force(queries: pa.Table, keep: int, itself: bool):
    """For mapInArrow: of each query (by its place), the `keep` nearest of the part's entries of its length, with or without
    its own entry."""
    dims, q_lo, q_h = (queries[c].to_numpy() for c in ("dim", "lo", "h"))
    own = {d: np.flatnonzero(dims == d) for d in np.unique(dims).tolist()}
    asked = {d: matrix(queries["vector"].take(pa.array(at))) for d, at in own.items()}
    names = ["query", "score", "lo", "ids", "vector"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = pd.DataFrame({c: [] for c in names})
        for b in batches:
            for part in by_length(b):
                d = part.column("dim")[0].as_py()
                if d not in own:
                    continue
                q, x, lo, h = asked[d], matrix(part.column("vector")), part.column("lo").to_numpy(), part.column("h").to_numpy()
                score = (units(q) @ units(x).T).clip(-1, 1)
                if not itself:
                    score[(q_lo[own[d], None] == lo) & (q_h[own[d], None] == h)] = -np.inf
                at = np.argpartition(-score, min(keep, score.shape[1]) - 1, axis=1)[:, :keep]
                k, at = np.repeat(np.arange(len(q)), at.shape[1]), at.ravel()
                fine = np.isfinite(score[k, at])
                k, at = k[fine], at[fine]
                exact = (x[at] * q[k]).sum(1) / (np.sqrt((x[at] * x[at]).sum(1)) * np.sqrt((q[k] * q[k]).sum(1)))
                taken = part.take(pa.array(at))
                found = pd.DataFrame({"query": own[d][k], "score": exact, "lo": lo[at], "ids": taken.column("ids").to_pylist(), "vector": taken.column("vector").to_pylist()})
                best = pd.concat([best, found] if len(best) else [found]).sort_values(["query", "score", "lo"], ascending=[True, False, True]).groupby("query").head(keep)
        yield pa.RecordBatch.from_arrays([pa.array(best[c].tolist(), t) for c, t in zip(names, (pa.int64(), pa.float64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64())), strict=True)], names)

    return rows


def searched(entries: DataFrame, queries: pa.Table, keep: int, itself: bool) -> DataFrame:
    """query (its place), ids and vector of the nearest entries, by one pass over all entries."""
    found = entries.select("lo", "h", "dim", "ids", "vector").mapInArrow(brute_force(queries, keep, itself), "query long, score double, lo long, ids array<long>, vector array<double>")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "lo"))
    return found.withColumn("place", place).where(F.col("place") <= keep)


def cheapest(pairs: list[tuple[np.ndarray, np.ndarray]], bits: int, every: int, seed: int) -> tuple[int, int, int, float]:
    """(tables, probes, bits, recall): of those that find GOAL of the pairs (unit vectors of queries, their neighbours;
    one entry for each length of vectors) the plan that moves least.

    Buckets are doubled only where no number of tables and probes allowed is enough; with two buckets all is found."""
    while True:
        asked = [buckets(q, TABLES[-1], PROBES[-1], bits, seed) == buckets(x, TABLES[-1], 1, bits, seed) for q, x in pairs]
        at = np.concatenate([np.where(hit.any(2), hit.argmax(2), PROBES[-1]) for hit in asked]) if asked else np.zeros((0, TABLES[-1]))
        plans = []
        for t in TABLES:
            first = at[:, :t].min(1)  # a pair is found with more probes than this
            plans += [(t * (1 + 2 * p / every), t, p, float((first < p).mean()) if len(first) else 1.0) for p in PROBES]
        good = [p for p in plans if p[3] >= GOAL]
        if good or bits <= 1:
            _, t, p, recall = min(good) if good else max(plans, key=lambda x: x[3])
            return t, p, bits, recall
        bits -= 1


def plan(entries: DataFrame, bits: int, every: int, nearest: int, seed: int) -> tuple[int, int, int, float]:
    """The cheapest plan for a sample of the queries, whose true neighbours one pass over all entries finds."""
    some = entries.where("asked").select("lo", "h", "dim", "vector").orderBy(F.xxhash64("lo", "h", F.lit(seed)), "lo").limit(SAMPLED).toArrow()
    if not len(some):
        return TABLES[0], PROBES[0], bits, 1.0
    true = searched(entries, some, nearest, False).select("query", "vector").toArrow()  # `nearest` rows a query
    query, dim = true["query"].to_numpy(), some["dim"].to_numpy()
    pairs = []
    for d in np.unique(dim):
        at = np.flatnonzero(dim[query] == d)
        if len(at):
            pairs.append((units(matrix(some["vector"].take(pa.array(query[at])))), units(matrix(true["vector"].take(pa.array(at))))))
    return cheapest(pairs, bits, every, seed)


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id, vector and its hashes h, h2 of the rows that take part: ids that are not null, vectors of finite numbers, not
    all 0. Numbers other than floats become doubles; -0.0 is 0.0, so that equal vectors hash alike."""
    kind = vectors.schema[embedding].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    v = F.col("vector")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<float>" if single else "array<double>").alias("vector")).where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & fine)
    zero = F.lit(0.0).cast("float" if single else "double")
    return rows.withColumn("vector", F.transform("vector", lambda x: F.when(x == 0, zero).otherwise(x))).withColumns({"h": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(7), "vector")})


def distinct_vectors(rows: DataFrame, every: int, keep: int) -> DataFrame:
    """One entry for each distinct vector (told by 128 bits of hashes): h, vector, dim, ids (its `keep` smallest, in order),
    lo (the first of them) and asked (whether any of its rows is a query). Vectors move once; copies are cut to `keep` ids
    and to one vector where they lie, so a vector that very many rows share costs no more than another."""
    place = F.row_number().over(Window.partitionBy("h", "h2").orderBy("vec_id"))
    ids = rows.select("vec_id", "h", "h2").distinct().withColumn("place", place).where(F.col("place") <= keep).groupBy("h", "h2").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    one = rows.groupBy("h", "h2").agg(F.first("vector").alias("vector"), F.max(F.col("vec_id") % every == 0).alias("asked"))
    return checkpointed(one.join(ids, ["h", "h2"]).select("h", "vector", F.size("vector").alias("dim"), "ids", F.col("ids")[0].alias("lo"), "asked"))


def with_grid(coded: DataFrame, large: DataFrame | None, few: bool, other: str) -> DataFrame:
    """coded with cell: tab, bucket, dim and the place in the bucket's grid, once for each block of the other side."""
    if large is None:
        return coded.withColumn("cell", F.xxhash64("tab", "bucket", "dim"))
    own = "down" if other == "across" else "across"
    joined = coded.join(F.broadcast(large) if few else large, ["tab", "bucket", "dim"], "left")
    mine = F.pmod(F.xxhash64("lo"), F.coalesce(own, F.lit(1)))
    dealt = joined.withColumn("mine", mine).withColumn("each", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(other, F.lit(1)) - 1)))
    at = ("mine", "each") if own == "down" else ("each", "mine")
    return dealt.withColumn("cell", F.when(F.col("down").isNull(), F.xxhash64("tab", "bucket", "dim")).otherwise(F.xxhash64("tab", "bucket", "dim", *at)))


def matched(entries: DataFrame, queries: DataFrame, tables: int, probes: int, bits: int, keep: int, seed: int) -> DataFrame:
    """q_lo, q_h, vec_id, score: the best entries of all buckets that each query looks into, once for each id."""
    kind = entries.schema["vector"].dataType.simpleString()
    index = entries.select("lo", "dim", "ids", "vector").mapInArrow(hashed(tables, 1, bits, seed, ["lo", "ids", "vector"]), f"tab int, bucket long, dim int, lo long, ids array<long>, vector {kind}")
    looked = queries.mapInArrow(hashed(tables, probes, bits, seed, ["lo", "h", "vector"]), f"tab int, bucket long, dim int, lo long, h long, vector {kind}")
    sizes = [side.select("dim", "vector").mapInArrow(hashed(tables, p, bits, seed, []), "tab int, bucket long, dim int").withColumns({"x": F.lit(x), "q": F.lit(1 - x)}) for side, p, x in ((entries, 1, 1), (queries, probes, 0))]
    blocks = reduce(DataFrame.unionByName, sizes).groupBy("tab", "bucket", "dim").agg(*[F.ceil(F.sum(c) / BLOCK).cast("long").alias(name) for c, name in (("x", "down"), ("q", "across"))])
    large = checkpointed(blocks.where("down > 1 or across > 1 and down > 0").withColumn("across", F.greatest("across", F.lit(1))))
    n_large = large.count()
    grid = (large, n_large <= FEW) if n_large else (None, True)
    left, right = with_grid(index, *grid, "across").select("cell", "ids", "vector"), with_grid(looked, *grid, "down").select("cell", "lo", "h", "vector")
    shape = "q_lo long, q_h long, score double, ids array<long>"
    best = left.groupBy("cell").cogroup(right.groupBy("cell")).applyInArrow(rerank(keep), shape).select("q_lo", "q_h", "score", F.explode("ids").alias("vec_id"))
    return checkpointed(best.repartition("q_lo", "q_h").groupBy("q_lo", "q_h", "vec_id").agg(F.max("score").alias("score")))


def nearest(vectors: DataFrame, every: int = 50, vec_id: str = "vec_id", embedding: str = "embedding", nearest: int = NEAREST, seed: int = 19) -> DataFrame:
    """query_id, rank, vec_id, score: for the rows whose id is divisible by `every`, the nearest other rows found.

    The cosine is taken on the original vectors in double precision; ties go to the smaller id. Rows with null ids take no
    part, nor do vectors that are null, empty, zero or not finite; repeated rows count once; an id with several vectors
    counts with the nearest of them; vectors of other lengths are never compared; other columns, whatever their names, are
    left out; an empty table gives no rows. Equal vectors are one entry with their smallest ids, which are all that a
    result can show. Entries are dealt out over the buckets of every table and queries go to several buckets of each; a
    large bucket is cut into a grid of entries and queries.

    The true neighbours of a bounded sample of the queries, found in one pass over all entries, tell how many tables and
    probes it takes to find GOAL of them. Queries whose buckets hold too few entries for a full list look again into those of
    tables with WIDER bits less, and so on: a few joins, however many such queries there are. The last tables have two
    buckets, both of which are looked into, so every list is as full as it can be.
    """
    keep = nearest + 1
    rows = usable(vectors, vec_id, embedding)
    entries = distinct_vectors(rows, every, keep)
    bits = max(1, round(math.log2(max(2.0, entries.count() / BUCKET))))
    tables, probes, bits, _ = plan(entries, bits, every, nearest, seed)
    queries = entries.where("asked").select("lo", "h", "dim", "vector")
    found = matched(entries, queries, tables, probes, bits, keep, seed)
    there = F.broadcast(entries.groupBy("dim").agg(F.sum(F.size("ids")).alias("there")))  # a row for each length of vectors
    short = queries
    while bits > 1:
        got = found.groupBy("q_lo", "q_h").agg(F.count("*").alias("n"))
        n = short.join(got, (F.col("lo") == F.col("q_lo")) & (F.col("h") == F.col("q_h")), "left").join(there, "dim")
        short = checkpointed(n.where(F.coalesce("n", F.lit(0)) < F.least("there", F.lit(keep))).select("lo", "h", "dim", "vector"))
        if short.isEmpty():
            break
        bits = max(1, bits - WIDER)
        alike = entries.join(F.broadcast(short.select("dim").distinct()), "dim", "left_semi")
        more = matched(alike, short, tables if bits > 1 else 1, probes, bits, keep, seed)
        found = found.unionByName(more).groupBy("q_lo", "q_h", "vec_id").agg(F.max("score").alias("score"))
    order = (F.desc("score"), F.asc("vec_id"))
    top = found.withColumn("n", F.row_number().over(Window.partitionBy("q_lo", "q_h").orderBy(*order))).where(F.col("n") <= keep).drop("n")
    asking = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("h").alias("q_h"), "h2").distinct().drop("h2")
    first = queries.select(F.col("lo").alias("q_lo"), F.col("h").alias("q_h"))
    out = asking.join(first, "q_h").join(top, ["q_lo", "q_h"]).where("vec_id != query_id")
    best = out.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The neighbours of every row of `embeddings` whose id is divisible by 50, among all rows."""
    return nearest(table(spark, sf_dir, "embeddings"))
