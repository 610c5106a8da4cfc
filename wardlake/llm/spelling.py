"""Spelling variants: edits of words probed against broadcast Bloom filters, and only those found joined with the vocabulary."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm.common import SQL_CRC_TABLE, checkpointed, sql_crc32, table

#: What words are made of, in any case; only A-Z are lower-cased.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], dtype=np.uint8)  # words are Latin-1: one byte a letter
TYPO_EVERY = 199
LEAST_LETTERS, LEAST_SEEN, RATIO = 6, 5, 5
#: A block is 256 bits, of which a word sets at most 8; the filters have as many blocks as words of their length need at
#: BITS a word, but all together MOST_BLOCKS (32 MB) at most. Beyond it more edits pass, and the join takes them out.
BITS, BLOCK_BITS, MOST_BLOCKS = 16, 256, 1 << 20
#: Words longer than this share one filter.
LONGEST = 64
#: Edits probed at once in a task.
AT_ONCE = 1 << 20


def typed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every run of letters of every text as `word`, with A-Z lower-cased and, where the hash of document and run says so,
    one letter left out."""
    runs = docs.select(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":")).alias("at"), F.explode(F.regexp_extract_all(F.translate(F.col(text), UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.select("run", F.crc32(F.concat("at", "run").cast("binary")).alias("h"))
    gone = F.pmod(F.col("h"), F.char_length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), gone), F.substring("run", gone + 2, F.char_length("run")))
    return runs.select(F.when(F.col("h") % TYPO_EVERY == 0, less).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS, least_seen: int = LEAST_SEEN) -> DataFrame:
    """word, n: every word long and frequent enough. Words are counted where they lie before they move."""
    words = typed(docs, doc_id, text).where(F.char_length("word") >= least_letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_seen)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def letter_hashes(place: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """A word's hash is the sum of these over its letters, so that of an edited word follows by a few additions."""
    return mixed((place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + letter.astype(np.uint64))


def letters_of(words: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: (which words have it, their letters as a matrix of bytes)."""
    coded = [w.encode("latin-1") for w in words.to_pylist()]
    n = np.fromiter(map(len, coded), np.int64, len(coded))
    return {int(k): (at, np.frombuffer(b"".join(coded[i] for i in at), np.uint8).reshape(-1, k)) for k in np.unique(n) for at in [np.flatnonzero(n == k)]}


class Filters:
    """Blocked Bloom filters, one for each length. blocks: how many a length has; words: their bits, four 64-bit words each."""

    def __init__(self, blocks: dict[int, int], words: np.ndarray | None = None):
        self.blocks, self.words = blocks, words
        self.first, at = {}, 0
        for k in sorted(blocks):
            self.first[k], at = at, at + blocks[k]
        self.size = at

    def places(self, length: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the number of the block, the hash that the bits in it follow from) of words of that length."""
        h, k = mixed(sums), min(length, LONGEST)
        return self.first[k] + ((h >> np.uint64(32)) * np.uint64(self.blocks[k]) >> np.uint64(32)).astype(np.int64), mixed(h + np.uint64(length))

    @staticmethod
    def masks(bits: np.ndarray, quarter: int) -> np.ndarray:
        """The two bits that a hash sets in one quarter of its block."""
        a, b = ((bits >> np.uint64(12 * quarter + s)) & np.uint64(63) for s in (0, 6))
        return (np.uint64(1) << a) | (np.uint64(1) << b)

    def has(self, length: int, sums: np.ndarray) -> np.ndarray:
        """Which words may be there; those that are, always."""
        if min(length, LONGEST) not in self.blocks:
            return np.zeros(sums.shape, bool)
        block, bits = self.places(length, sums)
        mask = self.masks(bits, 0)
        found = (self.words[block, 0] & mask) == mask
        at = np.flatnonzero(found)  # the other quarters are looked at for what passed the first
        for quarter in (1, 2, 3):
            mask = self.masks(bits.flat[at], quarter)
            at = at[(self.words[block.flat[at], quarter] & mask) == mask]
        out = np.zeros(sums.shape, bool)
        out.flat[at] = True
        return out


def filters_of(words: DataFrame) -> Filters:
    """The filters of distinct words: tasks set bits, Spark joins them by block, and the driver takes MOST_BLOCKS at most."""
    lengths = {r["k"]: r["n"] for r in words.groupBy(F.least(F.char_length("word"), F.lit(LONGEST)).alias("k")).agg(F.count("*").alias("n")).collect()}  # LONGEST rows at most
    want = {k: 1 + n * BITS // BLOCK_BITS for k, n in lengths.items()}
    share = min(1.0, (MOST_BLOCKS - LONGEST) / max(1, sum(want.values())))
    empty = Filters({k: max(1, int(n * share)) for k, n in want.items()})

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, (_, letters) in letters_of(batch.column(0)).items():
                block, own = empty.places(k, letter_hashes(np.arange(k), letters).sum(1, dtype=np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(block), *[pa.array(empty.masks(own, q).view(np.int64)) for q in range(4)]], ["block", *[f"q{q}" for q in range(4)]])

    joined = words.select("word").mapInArrow(bits, "block long, q0 long, q1 long, q2 long, q3 long").groupBy("block").agg(*[F.bit_or(f"q{q}").alias(f"q{q}") for q in range(4)]).toArrow()
    held = np.zeros((empty.size, 4), np.uint64)
    for q in range(4):
        held[joined["block"].to_numpy(), q] = joined[f"q{q}"].to_numpy().view(np.uint64)
    return Filters(empty.blocks, held)


def edits_found(letters: np.ndarray, filters: Filters) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """For words of one length (rows of bytes): (which word, the edited word) for the edits that the filters hold. Edits are
    one letter less, or a later letter in place of one; the others of a word are such edits of its neighbour, so that two
    near words meet once."""
    n, k = letters.shape
    hashes = letter_hashes(np.arange(k), letters)
    whole = hashes.sum(1, dtype=np.uint64)
    before = np.cumsum(hashes, 1, dtype=np.uint64) - hashes
    moved = letter_hashes(np.arange(k) - 1, letters)  # each letter one place to the left
    after = moved.sum(1, dtype=np.uint64)[:, None] - np.cumsum(moved, 1, dtype=np.uint64)
    for i in range(k):
        fits = filters.has(k - 1, before[:, i] + after[:, i]) if k > 1 else np.zeros(n, bool)
        if i:  # leaving out either of two equal letters gives the same word
            fits &= letters[:, i] != letters[:, i - 1]
        if len(at := np.flatnonzero(fits)):
            yield at, [r.tobytes() for r in np.delete(letters[at], i, 1)]
        sums = (whole - hashes[:, i])[:, None] + letter_hashes(np.full(len(LETTERS), i), LETTERS)
        at, which = np.nonzero(filters.has(k, sums) & (LETTERS > letters[:, i : i + 1]))
        if len(at):
            edited = letters[at]
            edited[:, i] = LETTERS[which]
            yield at, [r.tobytes() for r in edited]


def near_pairs(words: DataFrame) -> DataFrame:
    """word, n, other, other_n: each two near words once. words: distinct word, n."""
    spark = words.sparkSession
    held = filters_of(words)
    shared = spark.sparkContext.broadcast((held.blocks, held.words))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = Filters(*shared.value)
        for batch in batches:
            for k, (rows, letters) in letters_of(batch.column(0)).items():
                step = max(1, AT_ONCE // (k + len(LETTERS)))
                for a in range(0, len(rows), step):
                    for at, others in edits_found(letters[a : a + step], filters):
                        own = pa.array(rows[a + at])
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(1).take(own), pa.array([x.decode("latin-1") for x in others])], ["word", "n", "other"])

    tried = words.select("word", "n").mapInArrow(found, "word string, n long, other string")
    return tried.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other").select("word", "n", "other", "other_n")


def forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """words (distinct word, n) with n_near, form, form_n: how many words are near, and the most frequent of them (the first
    in order of code points among equals) if it is at least `ratio` times as frequent; else null."""
    pairs = near_pairs(words)
    sides = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = sides.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    both = words.join(best, "word", "left")
    taken = -F.col("best.less") >= ratio * F.col("n")
    return both.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(taken, F.col("best.other")).alias("form"), F.when(taken, -F.col("best.less")).alias("form_n"))


def rooted(formed: DataFrame) -> DataFrame:
    """formed (word, form, ...) with root, where following the forms ends. Ways are doubled at each step; as every form is
    more frequent by a factor, there are a handful of steps."""
    ways = checkpointed(formed.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = checkpointed(ways.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        ways = longer.select("word", "root")
        if not longer.where("moved").limit(1).count():
            break
    return formed.join(ways, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every word of the corpus with its form and root: word, form, root, n, n_near, form_n.

    Null and empty texts have no words; a null id counts as an empty one; repeated rows count each time; other columns are
    left out, whatever their names; a very long text is one row of the scan like any other. An empty table gives no rows.
    """
    words = checkpointed(vocabulary(docs, doc_id, text))
    return rooted(checkpointed(forms(words))).select("word", "form", "root", "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of all documents (null texts and ids: see variants)."""
    return variants(table(spark, sf_dir, "documents"))


def variants_sql() -> str:
    """op12_spelling in DuckDB SQL: near words share what is left of them without one letter."""
    cut = "left({w}, {i} - 1) || substr({w}, {i} + 1)"
    return f"""with recursive {SQL_CRC_TABLE},
runs as (select doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{RUN}')) as run from documents),
counted as (select coalesce(cast(doc_id as varchar), '') || ':' || run as said, run, count(*) as n from runs group by 1, 2),
marked as (select run, n, {sql_crc32("said")} as h from counted, crc),
typed as (select case when h % {TYPO_EVERY} = 0 then {cut.format(w="run", i="(h % length(run) + 1)")} else run end as word, n from marked),
words as (select word, cast(sum(n) as bigint) as n from typed where length(word) >= {LEAST_LETTERS} group by 1 having sum(n) >= {LEAST_SEEN}),
less as (select *, {cut.format(w="word", i="i")} as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
longer as (select distinct a.word, a.n, b.word as other, b.n as other_n from less a join words b on a.rest = b.word),
near as (select * from longer union all select other, other_n, word, n from longer union all select a.word, a.n, b.word, b.n from less a join less b on a.rest = b.rest and a.i = b.i and a.word <> b.word),
best as (select *, count(*) over (partition by word) as n_near, row_number() over (partition by word order by other_n desc, other) as k from near),
formed as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when other_n >= {RATIO} * w.n then other end as form, case when other_n >= {RATIO} * w.n then other_n end as form_n from words w left join (select * from best where k = 1) b on w.word = b.word),
walk as (select word, word as root from formed union all select w.word, f.form from walk w join formed f on w.root = f.word where f.form is not null),
ends as (select w.word, w.root from walk w join formed f on w.root = f.word where f.form is null)
select f.word, form, root, n, n_near, form_n from formed f join ends e on f.word = e.word"""
