"""Token ids by a public tokenizer, and the exact length histogram of a corpus.

The tokenizer of this file drops white space and never joins characters across it, so a text's ids are the
concatenation of the ids of its white-space-separated words. Words are split and numbered for many texts at once, each
distinct word is looked up once, and the ids are gathered by number. Python workers keep bounded caches and ask the
tokenizer only for letter runs that they have not seen lately.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlake.llm.common import checkpointed, slices, table, text_bytes, worker_state

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: Letter runs whose ids a Python worker keeps, twice over.
RUNS_KEPT = 320_000
LONGEST_KEPT = 64
#: Fixed value: how this tokenizer splits text.
RUNS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Control characters and rare spaces: words that hold them are left to the tokenizer.
ODD = regex.compile("[\x00-\x1f\x7f-\xa0]")
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Recent(dict):
    """A cache of what make(key) gives, for at most twice `most` keys: the latest ones, and the ones before them."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.pop(key, None)
        if value is None:
            value = self.make(key)
            if len(key) > LONGEST_KEPT:
                return value
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def byte_letters() -> str:
    """The printable character that stands for each byte in byte-level vocabularies: itself where it is printable
    Latin-1, the others from U+0100 on in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = iter(range(256, 512))
    return "".join(chr(b) if b in shown else chr(next(other)) for b in range(256))


def wide_texts(texts: pa.Array) -> np.ndarray:
    """Which texts go to the tokenizer whole: normal forms and case beyond Latin letters (from U+0250 on, and U+0130) are
    left to it, and so are texts that may hold one of its special tokens."""
    data, offsets = text_bytes(texts)
    b, after = data[:-1], data[1:]
    found = np.flatnonzero((b > 0xC9) | ((b == 0xC9) & (after >= 0x90)) | ((b == 0xC4) & (after == 0xB0)) | ((b == ord("<")) & (after == ord("|"))))
    return np.searchsorted(found, offsets[1:]) > np.searchsorted(found, offsets[:-1])


class PackedIds:
    """Ids of texts as unsigned 32-bit integers.

    In texts of Latin letters, lower case and splitting can be done a word at a time, and their letter runs recur. All others go to the tokenizer whole. Both give the same ids.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.runs = Recent(self.of_run, RUNS_KEPT)

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def of_run(self, run: str) -> bytes:
        shown = run if run.isascii() else run.encode().decode("latin-1").translate(self.letters)
        return array("I", [x.id for x in self.model.tokenize(shown)]).tobytes()

    def of_word(self, word: str) -> bytes:
        if word.isalpha():
            return self.runs[word]
        core = word.rstrip(SIGNS)
        if core.isalpha():
            return self.runs[core] + self.runs[word[len(core) :]]
        return self.whole(word) if ODD.search(word) else b"".join(map(self.runs.__getitem__, RUNS.findall(word)))

    def words_of(self, texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """(the ids of each distinct word, the number of the word at each place, where each text's places end). A text that
        has to be looked at whole counts as one word."""
        wide = wide_texts(texts)
        plain = pc.utf8_lower(pc.if_else(pa.array(wide), "", pc.fill_null(texts, ""))) if wide.any() else pc.utf8_lower(pc.fill_null(texts, ""))
        split = pc.ascii_split_whitespace(plain)
        coded = split.flatten().dictionary_encode()
        ids = list(map(self.of_word, coded.dictionary.to_pylist()))
        number, ends = coded.indices.to_numpy().astype(np.int64), split.offsets.to_numpy()[1:].astype(np.int64) - split.offsets[0].as_py()
        at = np.flatnonzero(wide)
        if len(at):  # such a text's only word is the empty one so far
            number[ends[at] - 1] = len(ids) + np.arange(len(at))
            ids += [self.whole(texts[int(i)].as_py()) for i in at]
        return ids, number, ends

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """How many ids each text has."""
        if not len(texts):
            return np.zeros(0, dtype=np.int64)
        ids, number, ends = self.words_of(texts)
        upto = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))[number] // 4)])
        return np.diff(upto[ends], prepend=0)

    def of_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts in turn, where each text's ids end)."""
        if not len(texts):
            return np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64)
        ids, number, ends = self.words_of(texts)
        pool = np.frombuffer(b"".join(ids), dtype="<u4")
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first = np.cumsum(length) - length
        n = length[number]
        upto = np.concatenate([[0], np.cumsum(n)])
        return pool[np.arange(upto[-1]) + np.repeat(first[number] - upto[:-1], n)], upto[ends]

    def of(self, text: str | None) -> bytes:
        return self.of_all(pa.array([text], pa.string()))[0].tobytes()


def packed_ids(path: str) -> PackedIds:
    """This Python worker's caches for the tokenizer file."""
    return worker_state(("tokens", path), lambda: PackedIds(path))


def token_counter(path: str) -> Callable:
    @F.arrow_udf("long")
    def n_tokens(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids = packed_ids(path)
        for batch in texts:
            yield pa.array(np.concatenate([np.zeros(0, np.int64), *[ids.lengths(part) for part in slices(batch)]]))

    return n_tokens


def length_histogram(docs: DataFrame, text: str = "text", path: str | None = None, parts: int = 256) -> DataFrame:
    """One row for each encoded length that occurs, with what it takes to answer for every context limit.

    Columns: n_tokens; documents and tokens of exactly that length; documents_from and tokens_from of that length or
    more (suffix sums); kept_at_limit, the tokens that remain when every document is cut to n_tokens; quantile, the
    share of documents of at most that length. Null and empty texts have 0 tokens. An empty table gives no rows.
    Documents are counted where they lie and only (length, count) pairs move; these are written to the checkpoint folder,
    so that both of their uses below read them there and no text is tokenised twice. The suffix sums run over ranges of
    lengths and then over the ranges' totals, so no task holds all lengths. Repeated rows count each time; other columns are
    left out, whatever their names; a very long text is tokenised alone.
    """
    counted = docs.select(token_counter(path or tokenizer_path())(F.col(text)).alias("n_tokens"))
    bins = counted.groupBy("n_tokens").agg(F.count("*").alias("documents")).withColumn("tokens", F.col("n_tokens") * F.col("documents"))
    bins = checkpointed(bins.withColumn("span", F.floor(F.log2(F.col("n_tokens") + 1) * 8).cast("int")))
    inside = Window.partitionBy("span").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy("all").orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("all")
    spans = (
        bins.groupBy("span")
        .agg(F.sum("documents").alias("d"), F.sum("tokens").alias("t"))
        .withColumn("all", F.lit(1))  # a few hundred spans at most: the lengths' logarithms
        .select("span", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_after"), F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_after"), F.sum("d").over(whole).alias("d_all"), F.sum("t").over(whole).alias("t_all"))
    )
    out = (
        bins.withColumn("documents_from", F.sum("documents").over(inside))
        .withColumn("tokens_from", F.sum("tokens").over(inside))
        .join(spans, "span")
        .withColumn("documents_from", F.col("documents_from") + F.col("d_after"))
        .withColumn("tokens_from", F.col("tokens_from") + F.col("t_after"))
    )
    return out.select(
        "n_tokens",
        "documents",
        "tokens",
        "documents_from",
        "tokens_from",
        (F.col("t_all") - F.col("tokens_from") + F.col("n_tokens") * F.col("documents_from")).alias("kept_at_limit"),
        ((F.col("d_all") - F.col("documents_from") + F.col("documents")) / F.col("d_all")).alias("quantile"),
    )


def for_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """limit, documents_over (longer than it), kept and lost (tokens, when every document is cut to it) for any context limits,
    whether documents of that length occur or not. histogram: of length_histogram, which is passed over once."""
    n, docs = F.col("n_tokens"), F.col("documents")
    over = lambda k: [F.coalesce(F.sum(F.when(n > k, docs)), F.lit(0)), F.coalesce(F.sum(F.least(n, F.lit(k)) * docs), F.lit(0)), F.coalesce(F.sum(F.greatest(n - k, F.lit(0)) * docs), F.lit(0))]
    each = F.array(*[F.struct(F.lit(k).cast("long").alias("limit"), *[c.alias(name) for c, name in zip(over(k), ("documents_over", "kept", "lost"), strict=True)]) for k in limits])
    return histogram.agg(each.alias("all")).select(F.explode("all").alias("r")).select("r.*")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The histogram of every document's text (null and empty ones: see length_histogram)."""
    return length_histogram(table(spark, sf_dir, "documents"))
