"""Sum-of-squares packing of tokenised documents into windows of fixed length."""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm.common import checkpointed, slices, small_batches, table, worker_state
from wardlake.llm.tokens import END_ID, packed_ids, tokenizer_path

WINDOW = 4096
#: Bytes of text that are tokenised at once, beside the windows that are open.
PART = 1 << 20
#: Bytes of a batch that a task of packing gets.
BATCH = 8 << 20
#: Open windows that a task keeps; beyond them its fullest one is filled by pieces of its emptiest.
MOST_OPEN = 2048
#: Windows' worth of open pieces that a task packs once more: so many fewer than MOST_OPEN that it is not reached.
GROUP_WINDOWS = 1024
#: Set in the sequence_id of windows that were filled by cutting, not by the rule.
CUT = 1 << 57
COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
PIECES = ", ".join(f"{c} long" for c in COLUMNS)
#: As above, or a piece that is still open: with its ids, and without a sequence.
PLACED = f"{PIECES}, ids binary"


class Packer:
    """Packs items online. levels[h] counts the open windows with h tokens; an item goes where the sum of the squares
    of these counts ends smallest. used lists the levels that occur, so that only they are looked at. Only open windows
    keep ids. They are passed on by left(), or filled by cutting by close(), which leaves none half filled."""

    def __init__(self, window: int, first_id: int, most_open: int = MOST_OPEN):
        self.window, self.next_id, self.most_open = window, first_id, most_open
        self.levels = [0] * (window + 1)
        self.used: list[int] = []
        self.open: dict[int, list[list]] = {}  # level -> windows, each a list of pieces (doc, start, ids, tokens of doc)
        self.n_open = 0
        self.rows: list[tuple] = []

    def emit(self, pieces: list, mark: int = 0) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc, start, n, zlib.crc32(ids), total, self.next_id | mark, offset))
            offset += n
        self.next_id += 1

    def level_for(self, size: int) -> int:
        """0 for a new window. Moving a window from h to h + size changes the sum by 2 (N[h + size] - N[h] + 1);
        a full window leaves it, a new one joins it. Ties go to the fuller window, and to an open one."""
        n, best, least = self.levels, 0, 2 * self.levels[size] + 1
        for h in self.used[: bisect_right(self.used, self.window - size)]:
            change = 1 - 2 * n[h] if h + size == self.window else 2 * (n[h + size] - n[h] + 1)
            if change <= least:
                best, least = h, change
        return best

    def put(self, level: int, pieces: list) -> None:
        if not self.levels[level]:
            insort(self.used, level)
        self.open.setdefault(level, []).append(pieces)
        self.levels[level] += 1
        self.n_open += 1

    def take(self, level: int) -> list:
        self.levels[level] -= 1
        self.n_open -= 1
        if not self.levels[level]:
            del self.used[bisect_left(self.used, level)]
        return self.open[level].pop()

    def add(self, doc, ids: bytes) -> None:
        total, start = len(ids) // 4, 0
        while total - start >= self.window:
            self.emit([(doc, start, ids[4 * start : 4 * (start + self.window)], total)])
            start += self.window
        if total > start:
            self.place(doc, start, ids[4 * start :], total)

    def place(self, doc, start: int, ids: bytes, total: int) -> None:
        size = len(ids) // 4
        level = self.level_for(size)
        pieces = self.take(level) if level else []
        pieces.append((doc, start, ids, total))
        if level + size == self.window:
            return self.emit(pieces)
        self.put(level + size, pieces)
        if self.n_open > self.most_open:
            self.fill()

    def left(self) -> list[tuple]:
        """The pieces of all open windows, which are given up by that."""
        out = [piece for windows in self.open.values() for pieces in windows for piece in pieces]
        self.levels, self.used, self.open, self.n_open = [0] * (self.window + 1), [], {}, 0
        return out

    def fill(self) -> None:
        """Fills the fullest open window with pieces of the emptiest ones, the last of them cut where needed."""
        level = self.used[-1]
        pieces = self.take(level)
        while level < self.window and self.used:
            low = self.used[0]
            donor = self.take(low)
            while level < self.window and donor:
                doc, start, ids, total = donor.pop()
                room = self.window - level
                if len(ids) > 4 * room:
                    donor.append((doc, start + room, ids[4 * room :], total))
                    ids = ids[: 4 * room]
                pieces.append((doc, start, ids, total))
                level, low = level + len(ids) // 4, low - len(ids) // 4
            if donor:
                self.put(low, donor)
        if level == self.window:
            self.emit(pieces, CUT)
        else:
            self.put(level, pieces)

    def close(self) -> None:
        """Fills windows until one is left, which is cut into windows whose lengths are powers of two."""
        while self.n_open > 1:
            self.fill()
        if not self.used:
            return
        left = self.used[0]
        pieces = self.take(left)[::-1]
        for bit in reversed(range(self.window.bit_length())):
            if left >> bit & 1:
                room, taken = 1 << bit, []
                while room:
                    doc, start, ids, total = pieces.pop()
                    if len(ids) > 4 * room:
                        pieces.append((doc, start + room, ids[4 * room :], total))
                        ids = ids[: 4 * room]
                    taken.append((doc, start, ids, total))
                    room -= len(ids) // 4
                self.emit(taken, CUT)


def first_id(phase: int) -> int:
    """Where the ids of this task's sequences begin: 5 bits of the phase, CUT, 21 bits of the partition, and 36 for the task's own."""
    from pyspark import TaskContext

    return (phase << 58) | (TaskContext.get().partitionId() << 36)


def placed(packer: Packer, pieces: list[tuple] = ()) -> pa.RecordBatch:
    """The rows that the packer has ready, or the given open pieces, in the columns of PLACED."""
    rows, packer.rows = ([], packer.rows) if pieces else (packer.rows, [])
    rows = [(*r, None) for r in rows] + [(doc, start, len(ids) // 4, zlib.crc32(ids), total, None, None, ids) for doc, start, ids, total in pieces]
    kinds = [*[pa.int64()] * len(COLUMNS), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(kinds), kinds, strict=True)], [*COLUMNS, "ids"])


def handed_on(packer: Packer) -> Iterator[pa.RecordBatch]:
    pieces = packer.left()
    yield placed(packer)
    for k in range(0, len(pieces), 512):
        yield placed(packer, pieces[k : k + 512])


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Pieces of documents, each id in exactly one piece, in sequences of at most `window` tokens.

    A document is its text's ids and then end_id; a null or empty text is end_id alone. A document of a window or more
    first fills windows of its own; the rest is placed whole by the sum-of-squares rule. Each task packs its own partition
    as it reads it. What lies in open windows when a task ends is packed once more by the same rule, the largest pieces
    first, by one task for every GROUP_WINDOWS windows of it; what that leaves open again, and so on. Only the last task's
    open windows are filled by cutting, the emptiest into the fullest, and the very last is cut at powers of two: no padding.
    sequence_id is unique over all tasks; CUT is set in that of a window filled by cutting. Should a task have more than
    MOST_OPEN open windows, its fullest is filled at once in that way. What each step placed is written to the checkpoint
    folder, so no text is tokenised twice and a lost executor changes nothing. Repeated rows and repeated or null ids are
    documents of their own; other columns of docs are left out, whatever their names. An empty table gives no rows. Very long
    texts are tokenised alone.
    """
    path, tail = path or tokenizer_path(), end_id.to_bytes(4, "little")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, packer = packed_ids(path), Packer(window, first_id(0))
        for batch in batches:
            numbers, at = batch.column(0).to_pylist(), 0
            for part in slices(batch.column(1), PART):
                all_ids, ends = ids.of_all(part)
                begin = 0
                for doc, end in zip(numbers[at : at + len(part)], ends.tolist(), strict=True):
                    packer.add(doc, all_ids[begin:end].tobytes() + tail)
                    begin = end
                at += len(part)
                if len(packer.rows) >= 5000:
                    yield placed(packer)
        yield from handed_on(packer)

    spark = docs.sparkSession
    with small_batches(spark, BATCH):
        done = checkpointed(docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t")).mapInArrow(packed, PLACED))
    out, phase, most = done.where("ids is null"), 1, None
    while True:
        rest = done.where("ids is not null")
        tokens = rest.agg(F.sum("length")).first()[0] or 0
        if not tokens:
            return out.drop("ids")
        groups = -(-tokens // (GROUP_WINDOWS * window))
        groups = groups if most is None else min(groups, max(1, most // 2))  # so that there is a last one

        def again(batches: Iterator[pa.RecordBatch], phase: int = phase, last: bool = groups == 1) -> Iterator[pa.RecordBatch]:
            worker_state("packing")  # the tokenizer and its cache are needed no more
            packer = Packer(window, first_id(phase))
            for batch in batches:
                for doc, start, total, ids in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
                    packer.place(doc, start, ids, total)
                yield placed(packer)
            if last:
                packer.close()
            yield from handed_on(packer)

        order = [F.col("length").desc(), "doc_id", "start", "ids_crc32"]
        dealt = rest.repartition(groups, F.xxhash64("doc_id", "start", "ids_crc32")).sortWithinPartitions(*order)
        with small_batches(spark, BATCH):
            done = checkpointed(dealt.select("doc_id", "start", "doc_tokens", "ids").mapInArrow(again, PLACED))
        out, phase, most = out.unionByName(done.where("ids is null")), phase + 1, groups


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces; null and repeated ids, null and very long texts as in pack()."""
    return pack(table(spark, sf_dir, "documents"))
