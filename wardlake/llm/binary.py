"""Token ids as flat files of unsigned integers, with 64-bit offsets and document ids beside them, read through memory maps.

A folder holds `parts` (Parquet: one row for each part, what manifest() gives) and, for each part, three flat little-endian
files: `.ids` (the ids of its documents in turn, each with the end id), `.ends` (unsigned 64-bit: where each document ends,
counted in ids from the part's beginning) and `.docs` (signed 64-bit document ids). Ids take 2 bytes where the tokenizer has
at most 2^16 of them, else 4. Parts follow each other in ascending order of documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlake.llm.common import slices, table
from wardlake.llm.tokens import packed_ids, tokenizer_path
from wardlake.sources import scratch

END_ID = 1
PART = "part int, stem string, width int, docs long, nulls long, tokens long, first_doc long, last_doc long"
#: Bytes of ids that a reader hands on at once (one document at least).
AT_ONCE = 8 << 20


def id_width(largest: int) -> int:
    return 2 if largest < 1 << 16 else 4


def write_tokens(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Writes every document's ids and end_id under folder, a new one that all executors share, and returns manifest(folder).

    Documents are dealt into ranges of doc_id, null first, and sorted there; rows of one id keep the table's order, and a
    range may end among them. A task tokenises its range as it reads it and writes one part. Its files have names of their
    own, and the part counts once its row is committed with `parts`: files of lost or repeated attempts are named by no row.
    Null and empty texts are end_id alone. Repeated rows are documents of their own, other columns are left out whatever
    their names, an empty table gives no part, and a very long text is tokenised alone.
    """
    path = path or tokenizer_path()

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids, part, stem = packed_ids(path), TaskContext.get().partitionId(), uuid4().hex
        width = id_width(max(end_id, ids.tokenizer.get_vocab_size(with_added_tokens=True) - 1))
        store, at, out = *fs.FileSystem.from_uri(folder), {}
        n = nulls = tokens = 0
        first = last = None
        for batch in batches:
            if not out:
                store.create_dir(at, recursive=True)
                out = {kind: store.open_output_stream(f"{at}/{stem}.{kind}") for kind in ("ids", "ends", "docs")}
            numbers, begin = batch.column(0), 0
            for texts in slices(batch.column(1)):
                own, ends = ids.of_all(texts)
                out["ids"].write(np.insert(own, ends, end_id).astype(f"<u{width}").tobytes())
                out["ends"].write((tokens + ends + np.arange(1, len(ends) + 1)).astype("<u8").tobytes())
                tokens += len(own) + len(ends)
            nulls += numbers.null_count
            out["docs"].write(numbers.fill_null(0).to_numpy().astype("<i8").tobytes())
            if numbers.null_count < len(numbers):
                first, last = numbers[numbers.null_count].as_py() if first is None else first, numbers[-1].as_py()
            n += len(numbers)
        for f in out.values():
            f.close()
        rows = [[part], [stem], [width], [n], [nulls], [tokens], [first], [last]] if n else [[]] * 8
        kinds = [pa.int32(), pa.string(), pa.int32(), *[pa.int64()] * 5]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], [c.split()[0] for c in PART.split(", ")])

    order = [F.col("d").asc_nulls_first(), F.col("at")]  # `at` parts rows of one id, so none is too many for a task
    ranged = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t"), F.monotonically_increasing_id().alias("at")).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.select("d", "t").mapInArrow(written, PART).write.parquet(f"{folder}/parts")
    return manifest(docs.sparkSession, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each part (PART) with its bases, the prefix sums over the parts before it: base, ids, and doc_base,
    documents. There are as many rows as tasks wrote parts."""
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.parquet(f"{folder}/parts").select("*", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(base) for c, base in (("tokens", "base"), ("docs", "doc_base"))])


def mapped(store: fs.FileSystem, path: str, kind: str) -> np.ndarray:
    """A flat file as an array: a memory map of a local file, what was read of any other."""
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, kind, mode="r") if store.get_file_info(path).size else np.zeros(0, kind)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), kind)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Every document under folder, from its files: doc_id, start (the ids of all documents before it), n_tokens (with the end
    id) and ids (binary: unsigned little-endian 32-bit integers). Each part is a task's; no part is read by the driver."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for p in batch.to_pylist():
                ids, ends, docs = (mapped(store, f"{at}/{p['stem']}.{k}", t) for k, t in (("ids", f"<u{p['width']}"), ("ends", "<u8"), ("docs", "<i8")))
                ends, k = ends.astype(np.int64), 0
                begin = np.concatenate([[0], ends[:-1]])
                while k < len(ends):
                    upto = max(k + 1, int(np.searchsorted(ends, begin[k] + AT_ONCE // 4, "right")))
                    own, offsets = ids[begin[k] : ends[upto - 1]].astype("<u4"), np.append(begin[k:upto], ends[upto - 1]) - begin[k]
                    held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), upto - k, [None, pa.py_buffer((4 * offsets).astype(np.int64)), pa.py_buffer(own)]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(docs[k:upto], mask=np.arange(k, upto) < p["nulls"]), pa.array(p["base"] + begin[k:upto]), pa.array(np.diff(offsets)), held], ["doc_id", "start", "n_tokens", "ids"])
                    k = upto

    known = manifest(spark, folder)
    return known.repartitionByRange(max(1, known.count()), "part").mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum, from the files that were written (null and empty texts: see write_tokens)."""
    folder = scratch.folder(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), folder)
    return read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
