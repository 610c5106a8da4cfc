"""Toxicity scores: gradient-boosted trees over dense features of a text, with isotonic calibration."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm.common import checkpointed, held_out, isotonic, labelled_sample, part_of, sigmoid, slices, table, text_bytes, worker_state
from wardlake.llm.textstats import DIGIT, LEAD, LOWER, SPACE, STOPS, SYMBOLS, UPPER, WIDE

MODULUS, REMAINDER, CUT = 3, 1, 0.7
#: At most about so many labelled documents are learned from.
SAMPLE = 16_000
FOLDS = 3
#: An entry of the lexicon occurs in so many toxic documents of its folds of the sample, as a share, and so many times as
#: often there as in others.
LEAST_SHARE, LEAST_RATIO = 0.008, 5.0
#: Lengths of the word beginnings that are entries too, marked by a final *.
STEMS = (3, 4, 5, 6, 7, 8)
#: Common insults in English, known before any label is seen.
INSULTS = "idiot idiots moron morons stupid dumb loser losers trash scum garbage worthless pathetic disgusting clown clowns imbecile fool jerk creep bastard bitch asshole retard vermin filth freak hate".split()
SECOND_PERSON = {"you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "sie", "ihr", "tu", "te", "toi", "vous", "votre", "tú", "ti", "usted", "ustedes", "tus"}
NEAR = 6
#: Weight from which a word counts as a strong mark.
STRONG = 2.5
#: Letters of a word that is spelled out one by one, at least.
SPELLED = 4
_leet = str.maketrans("0134578@$!", "oieastba" + "si")
_edge = "".join(c for c in map(chr, (*range(0x250), *range(0x2000, 0x2070), *range(0x3000, 0x3040))) if unicodedata.category(c)[0] not in "LN" and c not in "@$")
_run = regex.compile(r"(.)\1{2,}")
_triple = re.compile(r"(.)\1\1")
_inner = regex.compile(r"[^\p{L}]")
#: What a token can be, as bits.
INSULT, LEARNED, HIDDEN, YOU, LETTER, MARKED = 1, 2, 4, 8, 16, 32

FEATURES = [
    "insult_hits", "insult_rate", "learned_hits", "learned_rate", "hidden_hits", "hidden_rate", "any_hit", "second_person_rate", "hits_near_second_person",
    "evidence", "evidence_rate", "strongest", "strong_words", "log_words", "upper", "shout_words", "exclamations", "questions", "symbols", "digits", "stretched", "spelled_out", "letters", "stops",
]


def plain(word: str) -> str:
    """The word without disguise: digits and signs that stand for letters, signs inside, letters drawn out."""
    return _run.sub(r"\1", _inner.sub("", word.translate(_leet)))


def disguised(word: str) -> str | None:
    """The plain form of a word that is not plain itself."""
    if len(word) <= 3 or (word.isalpha() and not _triple.search(word)):
        return None
    bare = plain(word)
    return bare if bare != word and len(bare) > 3 else None


def drawn_out(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text, how often a visible byte is repeated three times or more in a row."""
    same = (data[1:] == data[:-1]) & (data[1:] > 32)
    same[offsets[1:-1][offsets[1:-1] > 0] - 1] = False  # not across texts
    run = same[1:] & same[:-1]
    begins = np.flatnonzero(run & ~np.concatenate([[False], run[:-1]]))
    return np.diff(np.searchsorted(begins, offsets))


def shouted(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text, its words with three capitals A-Z or more and no small letters a-z."""
    word = ~SPACE[data]
    word[-1] = False
    begins = word & np.concatenate([[True], ~word[:-1]])
    begins[offsets[:-1]] |= word[offsets[:-1]]
    at = np.flatnonzero(begins)
    if not len(at):
        return np.zeros(len(offsets) - 1, dtype=np.int64)
    capitals, small = (np.add.reduceat(kind[data], at, dtype=np.int32) for kind in (UPPER, LOWER))
    return np.diff(np.searchsorted(at[(capitals >= 3) & (small == 0)], offsets))


@dataclass(frozen=True)
class Lexicon:
    """kept: the few entries that explain the toxic documents best. weights: of every entry that marks them, the
    logarithm of how many times as often it is in them as in others."""

    kept: frozenset[str]
    weights: tuple[tuple[str, float], ...]


class Split:
    """The lower-case words of texts: distinct ones, the number of the word at each place, where each text's places end,
    and how many words each text has. Texts with white space at an end have an empty word there."""

    def __init__(self, texts: pa.Array):
        split = pc.ascii_split_whitespace(pc.utf8_lower(texts))
        coded = split.flatten().dictionary_encode()
        self.words = coded.dictionary.to_pylist()
        self.number = coded.indices.to_numpy()
        self.ends = split.offsets.to_numpy()[1:].astype(np.int64) - split.offsets[0].as_py()
        size = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.sizes = np.diff(np.concatenate([[0], np.cumsum(size[self.number] > 0)])[self.ends], prepend=0)

    def text_at(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, "right")


class Toxic:
    """Features of texts for a given lexicon. Each distinct word of a batch is looked at once."""

    def __init__(self, learned: Lexicon):
        self.insults, self.learned, self.weights = frozenset(INSULTS), learned.kept, dict(learned.weights)
        #: Other words are neither insults nor entries.
        self.heads = {w[:3] for w in (*self.insults, *self.learned, *self.weights)}

    def knows(self, word: str) -> bool:
        return word in self.learned or any(word[:k] + "*" in self.learned for k in STEMS if k <= len(word))

    def weight(self, word: str) -> float:
        """The largest weight of the word and its beginnings."""
        return max(self.weights.get(word, 0.0), *(self.weights.get(word[:k] + "*", 0.0) for k in STEMS if k <= len(word)), 0.0)

    def kind(self, token: str) -> tuple[int, float]:
        """(bits, weight) of a lower-case token."""
        word = token.strip(_edge)
        bits = YOU if word in SECOND_PERSON else 0
        if len(token) == 1 and token.isalpha():
            bits |= LETTER
        weight = 0.0
        if word[:3] in self.heads:
            bits |= (word in self.insults and INSULT) | (self.knows(word) and LEARNED)
            weight = self.weight(word)
        bare = disguised(word)
        if bare is not None and bare[:3] in self.heads:
            if not bits & (INSULT | LEARNED) and (bare in self.insults or self.knows(bare)):
                bits |= HIDDEN
            weight = max(weight, self.weight(bare))
        return bits | (MARKED if weight else 0), weight

    def spelled_out(self, words: Split, letters: np.ndarray) -> np.ndarray:
        """For each text, its known words that are spelled out as single letters with white space between."""
        text = words.text_at(letters)
        apart = np.flatnonzero((np.diff(letters) != 1) | (np.diff(text) != 0)) + 1
        out = np.zeros(len(words.ends), dtype=np.int64)
        for run in np.split(letters, apart):
            if len(run) >= SPELLED:
                word = "".join(words.words[k] for k in words.number[run])
                out[words.text_at(run[:1])] += word in self.insults or self.knows(word)
        return out

    def matrix(self, texts: pa.Array) -> np.ndarray:
        """A row of FEATURES for each text; nulls are empty texts."""
        if not len(texts):
            return np.zeros((0, len(FEATURES)))
        texts = pc.fill_null(texts, "")
        data, offsets = text_bytes(texts)
        n = np.stack([np.bincount(data[a:b], minlength=256) for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
        count = {name: n[:, which].sum(1) for name, which in (("upper", UPPER), ("letters", UPPER | LOWER | WIDE), ("chars", LEAD), ("symbols", SYMBOLS), ("digits", DIGIT), ("stops", STOPS))}
        words = Split(texts)
        kinds = [self.kind(w) for w in words.words]
        bits, weight = np.array([k for k, _ in kinds], dtype=np.int64), np.array([w for _, w in kinds])
        found = np.flatnonzero(bits[words.number])
        what, text = bits[words.number[found]], words.text_at(found)
        size = len(texts)
        insults, learned, hidden, you = (np.bincount(text[what & k > 0], minlength=size) for k in (INSULT, LEARNED, HIDDEN, YOU))
        spelled = self.spelled_out(words, found[what & LETTER > 0])
        hit = what & (INSULT | LEARNED | HIDDEN) > 0
        place, at = found[what & YOU > 0], text[what & YOU > 0]
        near = np.zeros(size)
        if len(place):
            right = np.searchsorted(place, found[hit])
            close = [(at[k] == text[hit]) & (np.abs(place[k] - found[hit]) <= NEAR) for k in (np.minimum(right, len(place) - 1), np.maximum(right - 1, 0))]
            near = np.bincount(text[hit][close[0] | close[1]], minlength=size)
        pairs = np.unique(text[what & MARKED > 0] * len(bits) + words.number[found[what & MARKED > 0]])
        marked_text, marked_weight = pairs // len(bits), weight[pairs % len(bits)]
        evidence, strong = (np.bincount(marked_text, w, size) for w in (marked_weight, marked_weight >= STRONG))
        strongest = np.zeros(size)
        np.maximum.at(strongest, marked_text, marked_weight)
        m, chars, letters = np.maximum(1, words.sizes), np.maximum(1, count["chars"]), np.maximum(1, count["letters"])
        return np.stack([
            np.log1p(insults), np.minimum(1.0, 20 * insults / m), np.log1p(learned), np.minimum(1.0, 20 * learned / m), np.log1p(hidden + spelled), np.minimum(1.0, 20 * (hidden + spelled) / m),
            insults + learned + hidden + spelled > 0, you / m, np.log1p(near), np.log1p(evidence), evidence / m, strongest, np.log1p(strong),
            np.log1p(words.sizes), count["upper"] / letters, shouted(data, offsets) / m, np.minimum(1.0, n[:, ord("!")] / m), np.minimum(1.0, n[:, ord("?")] / m),
            np.minimum(2.0, count["symbols"] / m), count["digits"] / chars, np.minimum(1.0, drawn_out(data, offsets) / m), spelled, letters / chars, np.minimum(2.0, count["stops"] / m),
        ], 1)


@dataclass
class Trees:
    """Boosted trees of one depth, each a full binary tree in heap order: feature and threshold of inner nodes, values of
    leaves. A row goes right where its feature is above the threshold."""

    depth: int
    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), dtype=int)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += v[node - len(f)]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, least: float = 1.0) -> Trees:
    """Second-order boosting of the logistic loss over binned features."""
    prior = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Trees(depth, float(np.log(prior / (1 - prior))), *(np.zeros((trees, k), dtype=t) for k, t in ((2**depth - 1, int), (2**depth - 1, float), (2**depth, float))))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    cuts = [np.union1d(c, [np.min(col)]) for c, col in zip(cuts, x.T, strict=True)]
    binned = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T, strict=True)], 1)
    width = max(len(c) for c in cuts) + 1
    flat = np.arange(x.shape[1]) * width + binned
    margin = np.full(len(x), model.base)
    for k in range(trees):
        p = sigmoid(margin)
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(len(x), dtype=int)
        for level in range(depth):
            first, size = 2**level - 1, x.shape[1] * width
            at = ((node - first)[:, None] * size + flat).ravel()
            gs, hs = (np.bincount(at, np.repeat(v, x.shape[1]), 2**level * size).reshape(2**level, x.shape[1], width).cumsum(2) for v in (g, h))
            gt, ht = gs[:, :, -1:], hs[:, :, -1:]
            gain = gs**2 / (hs + least) + (gt - gs) ** 2 / (ht - hs + least) - gt**2 / (ht + least)
            for i in range(2**level):
                f, b = np.unravel_index(np.argmax(gain[i]), gain[i].shape)
                model.feature[k, first + i] = f
                model.threshold[k, first + i] = cuts[f][b] if b < len(cuts[f]) and gain[i, f, b] > 1e-9 else np.inf
            node = 2 * node + 1 + (x[np.arange(len(x)), model.feature[k, node]] > model.threshold[k, node])
        leaf = node - (2**depth - 1)
        model.value[k] = -rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + least)
        margin += model.value[k, leaf]
    return model


@dataclass
class ToxicityModel:
    learned: Lexicon
    trees: Trees
    knots: tuple[np.ndarray, np.ndarray]

    def score(self, texts: pa.Array) -> np.ndarray:
        return np.interp(self.trees.margin(toxic_for(self.learned).matrix(texts)), *self.knots)


def toxic_for(learned: Lexicon) -> Toxic:
    return worker_state(("toxicity", learned), lambda: Toxic(learned))


def entries(token: str) -> list[str]:
    """What a lower-case token is counted as: itself and its beginnings, and those of its plain form if it is disguised."""
    word = token.strip(_edge)
    forms = [w for w in (word, disguised(word)) if w and len(w) > 2]
    return [e for w in forms for e in (w, *(w[:k] + "*" for k in STEMS if k <= len(w)))]


def held(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct entries, text, entry): the numbers of the entries that each text holds, each once."""
    words = Split(texts)
    numbers: dict[str, int] = {}
    own = [[numbers.setdefault(e, len(numbers)) for e in entries(w)] for w in words.words]
    pair = np.unique(words.text_at(np.arange(len(words.number))) * len(own) + words.number)
    text, word = pair // len(own), pair % len(own)
    n = np.fromiter(map(len, own), np.int64, len(own))
    pool = np.fromiter((e for x in own for e in x), np.int64, int(n.sum()))
    first, n = (np.cumsum(n) - n)[word], n[word]
    entry = pool[np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)]
    pair = np.unique(np.repeat(text, n) * max(1, len(numbers)) + entry)
    return list(numbers), pair // max(1, len(numbers)), pair % max(1, len(numbers))


def lexicons(sample: DataFrame, folds: int) -> list[Lexicon]:
    """For each fold (column part) a lexicon learned on the others, and last one learned on all of them.

    Entries are words and beginnings of words that mark the toxic documents, by document counts: in at least LEAST_SHARE
    of them and LEAST_RATIO times as often as in the others. One pass counts for all folds, each task summing what it
    reads. Of the entries, some are kept in turn, those that explain most and mark best first, while they explain toxic
    documents that no kept entry explains; so words that only keep company with insults are left out. The weights of all
    entries are there beside them.
    """
    sizes = {(r["y"], r["part"]): r["count"] for r in sample.groupBy("y", "part").count().collect()}
    names = [f"{y}{k}" for y in ("good", "bad") for k in range(folds)]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for texts in slices(b.column("text")):
                kind = (b.column("y").to_numpy()[at : at + len(texts)] * folds + b.column("part").to_numpy()[at : at + len(texts)]).astype(np.int64)
                at += len(texts)
                found, text, entry = held(texts)
                table = np.bincount(entry * len(names) + kind[text], minlength=len(found) * len(names)).reshape(-1, len(names))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), *(pa.array(c, pa.int64()) for c in table.T)], ["entry", *names])

    counts = sample.select("text", "y", "part").mapInArrow(counted, ", ".join(["entry string", *(f"{c} long" for c in names)])).groupBy("entry").agg(*[F.sum(c).alias(c) for c in names])
    asked = []
    for fold in range(folds + 1):
        own = [k for k in range(folds) if k != fold]
        bad, good = (sum(sizes.get((y, k), 0) for k in own) for y in (1.0, 0.0))
        b, g = (sum((F.col(f"{name}{k}") for k in own), F.lit(0)) for name in ("bad", "good"))
        ratio = (b + 0.5) / (bad + 1) / ((g + 0.5) / (good + 1))
        marks = (b >= max(3, LEAST_SHARE * bad)) & (ratio >= LEAST_RATIO) & F.lit(bool(bad and good))
        asked.append((bad, F.when(marks, F.round(F.log(ratio), 6)).alias(f"w{fold}")))
    rows = counts.select("entry", *[w for _, w in asked]).where(F.coalesce(*[f"w{k}" for k in range(folds + 1)]).isNotNull()).orderBy("entry").collect()  # entries of so many of the sample's toxic documents
    if not rows:
        return [Lexicon(frozenset(), ()) for _ in asked]
    number = {r["entry"]: k for k, r in enumerate(rows)}

    def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for texts in slices(b.column("text")):
                found, text, entry = held(texts)
                known = np.array([number.get(e, -1) for e in found], dtype=np.int32)[entry]
                text, known = text[known >= 0], known[known >= 0]
                own = [x.tobytes() for x in np.split(known.astype("<i4"), np.searchsorted(text, np.arange(1, len(texts))))]
                yield pa.RecordBatch.from_arrays([b.column("part").slice(at, len(texts)), pa.array(own, pa.binary())], ["part", "own"])
                at += len(texts)

    toxic = sample.where("y = 1").select("text", "part").mapInArrow(holding, "part int, own binary").collect()  # numbers of entries, for each toxic document of the bounded sample
    part = np.array([r["part"] for r in toxic])
    has = np.zeros((len(rows), len(toxic)), dtype=bool)
    for i, r in enumerate(toxic):
        has[np.frombuffer(bytes(r["own"]), dtype="<i4"), i] = True
    out = []
    for fold, (bad, _) in enumerate(asked):
        weight = np.array([r[f"w{fold}"] or 0.0 for r in rows])
        at = np.flatnonzero(weight)
        left = has[at][:, part != fold]
        kept = []
        explains = left.sum(1)
        while len(at):
            best = int(np.argmax(explains * weight[at]))
            if explains[best] < max(2, 0.003 * bad):
                break
            kept.append(rows[at[best]]["entry"])
            gone = left[best].copy()
            explains = explains - left[:, gone].sum(1)
            left[:, gone] = False
        out.append(Lexicon(frozenset(kept), tuple((rows[k]["entry"], float(weight[k])) for k in at)))
    return out


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", bound: int = SAMPLE, seed: int = 3) -> ToxicityModel | None:
    """Learns from at most about `bound` labelled documents that are not held out. Three quarters are folds: the trees see
    each fold's documents through the lexicon of the other folds. The last quarter, through the lexicon of all folds,
    calibrates. None where there are not both labels to learn from."""
    known = labelled_sample(docs, labels, target, MODULUS, REMAINDER, bound).select("y", part_of(F.col("doc_id"), FOLDS + 1, seed).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    sample = checkpointed(known.repartition(16))
    learned = lexicons(sample.where(F.col("part") < FOLDS), FOLDS)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = worker_state(("toxicity", tuple(learned)), lambda: [Toxic(x) for x in learned])
        for b in batches:
            for k, tool in enumerate(tools):
                own = b.filter(pc.equal(b.column("part"), k))
                for texts in slices(own.column("text")) if len(own) else ():
                    x = [r.tobytes() for r in tool.matrix(texts)]
                    y = own.column("y").slice(0, len(texts))
                    own = own.slice(len(texts))
                    yield pa.RecordBatch.from_arrays([pa.array([k] * len(x), pa.int32()), y, pa.array(x, pa.binary())], ["part", "y", "x"])

    rows = sample.mapInArrow(measured, "part int, y double, x binary").orderBy("part", "y", "x").toPandas()  # some 20 numbers for each document of the bounded sample
    x, y, grow = np.frombuffer(b"".join(rows["x"])).reshape(-1, len(FEATURES)), rows["y"].to_numpy(float), rows["part"].to_numpy() < FOLDS
    if len(set(y[grow])) < 2:
        return None
    trees = boost(x[grow], y[grow])
    rest = ~grow if len(set(y[~grow])) > 1 else grow
    return ToxicityModel(learned[-1], trees, isotonic(trees.margin(x[rest]), y[rest]))


def scorer(model: ToxicityModel | None) -> Callable:
    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            if model is None:
                yield pa.array(np.zeros(len(batch)))
            else:
                yield pa.array(np.concatenate([np.zeros(0), *[model.score(part) for part in slices(batch)]]))

    return score


def with_toxicity(docs: DataFrame, model: ToxicityModel | None, text: str = "text", out: str = "score") -> DataFrame:
    """docs with a score from 0 to 1 of each whole text; every row and column stays, one named `out` is replaced.

    Null texts score as empty ones, equal texts score the same, repeated rows stay, an empty table stays empty; without a
    model all scores are 0. What is worked out grows with a text in proportion, however long it is.
    """
    return docs.withColumn(out, scorer(model)(F.col(text)))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score of every document, also of those with null, empty or repeated ids and texts (see with_toxicity)."""
    docs = table(spark, sf_dir, "documents")
    scored = with_toxicity(docs.select("doc_id", "text"), fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id"), MODULUS, REMAINDER).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
