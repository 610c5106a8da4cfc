"""Helpers that several operators share: word rule, folds, checkpoints, samples of labelled rows, calibration."""

from __future__ import annotations

import ctypes
import ctypes.util
import gc
from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.sources import scratch

#: A word: what lies between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that a Python worker takes apart at once.
SLICE = 8 << 20
#: Keys of so large a share of the rows (one in OFTEN) are looked up in a broadcast table, others by a shuffle.
OFTEN = 1 << 16
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written to the shared checkpoint folder and read back: its lineage ends there, on storage that outlives executors.

    Where that is, and what a session without such a folder gets: see scratch.shared.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch.shared(df.sparkSession))
    return df.checkpoint(eager=True)


@contextmanager
def small_batches(spark: SparkSession, most: int) -> Iterator[None]:
    """What is run inside hands Python tasks batches of at most `most` bytes (longer texts come alone), for tasks that hold
    much besides them. The session's own setting is put back."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def row_key(columns: list[str]) -> Column:
    """32 hex digits by what a row holds; only rows that are equal in all columns share them. Nulls count as values."""
    held = [c for name in columns for c in (F.col(name).isNull(), F.col(name))]
    return F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(seed), *held)), 16, "0") for seed in (1, 2)])


def looked_up(rows: DataFrame, values: DataFrame, key: str, value: str) -> DataFrame:
    """rows with the value of their key; values: key, n (about how many of the rows have it) and value, for each key once.
    Keys and values are never null.

    Keys with at least one in OFTEN of the rows are OFTEN at most and are broadcast; of all others no task gets many, so
    they are shuffled.
    """
    total = values.agg(F.sum("n")).first()[0] or 0
    often, seldom = (values.where(c).select(key, value) for c in (F.col("n") * OFTEN >= total, F.col("n") * OFTEN < total))
    marked = rows.join(F.broadcast(often), key, "left")
    return marked.where(F.col(value).isNotNull()).unionByName(marked.where(F.col(value).isNull()).drop(value).join(seldom, key))


def text_offsets(texts: pa.Array) -> np.ndarray:
    """Where each text begins in the array's bytes, and where the last ends."""
    where = texts.buffers()[1]
    if where is None:
        return np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(where, dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(the bytes of all texts in turn and one zero after them, where each text begins and the last ends)."""
    offsets, data = text_offsets(texts), texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.append(raw, np.uint8(0)), offsets - offsets[0]


def slices(texts: pa.Array, most: int = SLICE) -> Iterator[pa.Array]:
    """A batch of texts in parts of at most `most` bytes (or of one text, if it is longer), so that what is worked out for
    each word of a part stays small. Spark bounds the batch itself (spark.sql.execution.arrow.maxBytesPerBatch)."""
    offsets, at = text_offsets(texts), 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield texts.slice(at, upto - at)
        at = upto


def fold(doc_id: Column, modulus: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True for the rows that no model may learn from; a null id is never held out."""
    return F.coalesce(fold(doc_id, modulus) == remainder, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, modulus: int, remainder: int, bound: int, seed: int = 11) -> DataFrame:
    """About `bound` labelled documents at most (doc_id, text, y), by a hash of doc_id, none of them held out.

    Labels that contradict each other for one id count as their largest. The sample of labels is bounded by
    `bound`, so it is broadcast. Of documents that share an id the one with the least hash of its text is taken, so
    repeated ids do not widen the sample; only the sample's texts are shuffled for that.
    """
    known = (
        labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), modulus, remainder))
        .groupBy("doc_id")
        .agg(F.max(F.col(target)).cast("double").alias("y"))
    )
    share = bound / max(1, known.count())
    if share < 1:
        known = known.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 40)) < int(share * (1 << 40)))
    mine = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return mine.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first")).select("doc_id", "first.text", "y")


def part_of(doc_id: Column, parts: int, seed: int) -> Column:
    """Deals documents out to `parts` parts by a hash, to learn and to calibrate on different ones."""
    return F.pmod(F.xxhash64(doc_id, F.lit(seed)), F.lit(parts)).cast("int")


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the nondecreasing least-squares fit of y on raw (pool adjacent violators), for numpy.interp."""
    if not len(raw):
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []  # mean, weight, least and largest raw
    for x, v in zip(raw[order], y[order], strict=True):
        blocks.append([float(v), 1.0, float(x), float(x)])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m, w, _, hi = blocks.pop()
            last = blocks[-1]
            last[0] = (last[0] * last[1] + m * w) / (last[1] + w)
            last[1] += w
            last[3] = hi
    xs = np.array([x for b in blocks for x in (b[2], b[3])])
    ys = np.array([b[0] for b in blocks for _ in (0, 1)])
    return xs, np.clip(ys, 0.0, 1.0)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


_held: dict[Hashable, object] = {}


def given_back() -> None:
    """Gives memory that this Python worker has freed back to the system, where its C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(ctypes.util.find_library("c")), "malloc_trim", None)
    if trim:
        trim(0)


def worker_state(key: Hashable, make: Callable = dict):
    """What make() gave for this key, kept in the Python worker until another key is asked for.

    Workers serve all operators of a session in turn; what one of them keeps must not stay beside the next one's.
    """
    if key not in _held:
        _held.clear()
        given_back()
        _held[key] = make()
    return _held[key]


#: DuckDB: a table of one row, the CRC-32 of every byte.
SQL_CRC_TABLE = "crc as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as crc_of)"


def sql_crc32(text: str) -> str:
    """DuckDB: the unsigned CRC-32 of a text of characters up to U+07FF, beside the table of SQL_CRC_TABLE."""
    bytes_ = f"flatten(list_transform(string_split({text}, ''), lambda x: case when ord(x) < 128 then [ord(x)] else [192 | (ord(x) >> 6), 128 | (ord(x) & 63)] end))"
    return f"xor(list_reduce(list_prepend(4294967295, {bytes_}), lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1])), 4294967295)"
