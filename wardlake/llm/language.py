"""Language identification: the family first, then one-versus-one linear support vector machines inside it."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlake.llm.common import DOCUMENT_COLUMNS, checkpointed, held_out, sigmoid, table, worker_state

MODULUS, REMAINDER = 4, 2
BUCKETS = 2048
#: At most about so many documents of each language are learned from. All languages are learned; where they are more than
#: LANGUAGES, the documents of each get fewer, so that the sample is no larger, but not fewer than LEAST.
SAMPLE, LANGUAGES, LEAST = 1500, 64, 50
#: Documents that families are told apart by, at most, but of each language two: 4 KB for each are broadcast.
GATED = 16_000
UNKNOWN = "und"
#: Families by ISO 639-1 code. A code that is not here is a family of its own.
FAMILIES = {
    "germanic": "af da de en is nl no sv yi",
    "romance": "ca es fr gl it oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr uz",
    "indic": "bn gu hi mr ne pa ur",
    "semitic": "am ar he mt",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
_letter = regex.compile(r"\p{L}")
_only_letters = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def grams(texts) -> np.ndarray:
    """Square roots of the shares of hashed byte trigrams of each whole lower-cased text, letters alone."""
    out = np.zeros((len(texts), BUCKETS), dtype=np.float32)
    for i, t in enumerate(texts):
        words = (t or "").lower().encode("utf-8", "replace").translate(_only_letters).split()
        b = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8).astype(np.uint32)
        if len(b) > 2:
            code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
            n = np.bincount((code * np.uint32(2654435761)) >> np.uint32(32 - 11), minlength=BUCKETS)
            out[i] = np.sqrt(n / n.sum())
    return out


def linear_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 150) -> np.ndarray:
    """Weights, the last one constant, of the squared hinge loss with classes of equal weight, by accelerated descent."""
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    y = y.astype(np.float32)
    rate = 1.0 / (2 * float((share * (np.einsum("ij,ij->i", x, x) + 1)).sum()) + penalty)  # without a second matrix
    w = look = np.zeros(x.shape[1] + 1, dtype=np.float32)
    for t in range(steps):
        pull = share * y * np.maximum(0, 1 - y * (x @ look[:-1] + look[-1]))
        new = (look - rate * (penalty * look - 2 * np.append(pull @ x, pull.sum()))).astype(np.float32)
        look, w = (new + t / (t + 3) * (new - w)).astype(np.float32), new
    return w


def family_of(code: str) -> str:
    return FAMILY_OF.get(code.lower().replace("_", "-").split("-")[0], code)


def vectors(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Grams (16-bit floats) and languages of a sample, in an order of its own."""
    rows = rows.sort_values(["lang", "x"], kind="stable")
    return np.frombuffer(b"".join(rows["x"]), dtype=np.float16).reshape(len(rows), -1), rows["lang"].to_numpy()


def family_pairs(rows: pd.DataFrame) -> pd.DataFrame:
    """For one family's sample: a support vector machine for each two of its languages."""
    x, y = vectors(rows)
    out = []
    for p, q in combinations(sorted(set(y)), 2):
        at = np.isin(y, [p, q])
        out.append((p, q, linear_svm(x[at].astype(np.float32), np.where(y[at] == p, 1.0, -1.0)).tobytes()))
    return pd.DataFrame(out, columns=["p", "q", "w"])


@dataclass
class LanguageModel:
    """families: languages of each; gates: one weight row for each family against the rest; pairs: for two languages
    of a family, weights that are positive for the first."""

    families: dict[str, list[str]]
    gates: dict[str, np.ndarray]
    pairs: dict[tuple[str, str], np.ndarray]

    def predict(self, texts) -> tuple[list[str], np.ndarray]:
        x = np.hstack([grams(texts), np.ones((len(texts), 1), dtype=np.float32)])
        names = list(self.families)
        gate = np.stack([x @ self.gates[f] for f in names], 1) if len(names) > 1 else np.zeros((len(x), 1))
        order = np.sort(gate, 1)
        sure = sigmoid(2 * (order[:, -1] - order[:, -2])) if len(names) > 1 else np.ones(len(x))
        family, lang, score = gate.argmax(1), np.empty(len(x), dtype=object), np.zeros(len(x))
        for i, f in enumerate(names):
            rows, own = np.flatnonzero(family == i), self.families[f]
            votes, margin = np.zeros((len(rows), len(own))), np.zeros((len(rows), len(own)))
            for p, q in combinations(range(len(own)), 2):
                m = x[rows] @ self.pairs[own[p], own[q]]
                for k, v in ((p, m), (q, -m)):
                    votes[:, k] += v > 0
                    margin[:, k] += v
            best = (votes + margin / (1 + 4 * np.abs(margin).sum(1, keepdims=True))).argmax(1)  # margins settle ties
            lang[rows] = np.array(own, dtype=object)[best]
            score[rows] = sure[rows] * (sigmoid(3 * margin[np.arange(len(rows)), best] / (len(own) - 1)) if len(own) > 1 else 1.0)
        for i, t in enumerate(texts):
            if not t or not _letter.search(t):
                lang[i], score[i] = UNKNOWN, 0.0
        return list(lang), score


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", bound: int = SAMPLE, seed: int = 7) -> LanguageModel | None:
    """Learns from text and lang of documents that are not held out: every value of lang, from at most about `bound`
    documents of each (fewer where languages are many), taken by a hash of doc_id and text, equal ones once. None where there
    is none to learn.

    Families are told apart by at most GATED documents, which all tasks get; each family's machine is fitted in a task, and so
    are each family's pairs. The driver fits nothing.
    """
    known = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("lang is not null and text is not null and doc_id is not null").where(~held_out(F.col("doc_id"), MODULUS, REMAINDER))
    counts = checkpointed(known.groupBy("lang").agg(F.count("*").alias("n")))  # a row for each language
    languages = counts.count()
    if not languages:
        return None
    most = bound if languages <= LANGUAGES else min(bound, max(LEAST, bound * LANGUAGES // languages))
    h = F.xxhash64("doc_id", "text", F.lit(seed))
    sample = known.join(F.broadcast(counts), "lang").where(F.pmod(h, F.lit(10**12)) * F.col("n").cast("double") < float(10**12) * most)
    sample = sample.groupBy("lang", "doc_id", h.alias("h")).agg(F.first("text").alias("text"))  # equal rows are one

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b[[bool(_letter.search(t)) for t in b["text"]]] if len(b) else b
            if len(b):
                x = [row.astype(np.float16).tobytes() for i in range(0, len(b), 256) for row in grams(b["text"].iloc[i : i + 256].tolist())]
                yield pd.DataFrame({"lang": b["lang"].tolist(), "family": [family_of(c) for c in b["lang"]], "x": x}, dtype=object)

    rows = checkpointed(sample.select("text", "lang").mapInPandas(measured, "lang string, family string, x binary"))  # 4 KB for each document of the sample
    families = defaultdict(list)
    for r in rows.select("family", "lang").distinct().orderBy("lang").collect():
        families[r["family"]].append(r["lang"])
    if not families:
        return None
    families = {f: sorted(own) for f, own in sorted(families.items(), key=lambda item: min(item[1]))}
    gates = {}
    if len(families) > 1:
        each = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("x"), "x"))
        shared = docs.sparkSession.sparkContext.broadcast(vectors(rows.withColumn("each", each).where(F.col("each") <= max(2, GATED // languages)).select("lang", "x").toPandas()))

        def fitted_gates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            x = None
            for b in batches:
                if x is None and len(b):
                    x, y = shared.value
                    x = x.astype(np.float32)
                yield pd.DataFrame({"family": b["family"], "w": [linear_svm(x, np.where(np.isin(y, own), 1.0, -1.0)).tobytes() for own in b["own"]]})

        told = rows.groupBy("family").agg(F.collect_set("lang").alias("own")).repartition(min(len(families), 256), "family")
        fitted = told.mapInPandas(fitted_gates, "family string, w binary").collect()  # 8 KB a family, as the model is
        gates = {r["family"]: np.frombuffer(bytes(r["w"]), dtype=np.float32) for r in fitted}
    several = [f for f, own in families.items() if len(own) > 1]
    fitted = rows.where(F.col("family").isin(several)).groupBy("family").applyInPandas(family_pairs, "p string, q string, w binary").collect() if several else []
    pairs = {(r["p"], r["q"]): np.frombuffer(bytes(r["w"]), dtype=np.float32) for r in fitted}
    return LanguageModel(families, gates, pairs)


def predictor(model: LanguageModel | None) -> Callable:
    @F.pandas_udf("lang_pred string, score double")
    def predict(text: pd.Series) -> pd.DataFrame:
        worker_state("language")
        if model is None:
            return pd.DataFrame({"lang_pred": [UNKNOWN] * len(text), "score": 0.0})
        parts = [model.predict(text.iloc[i : i + 256].tolist()) for i in range(0, len(text), 256)]
        return pd.DataFrame({"lang_pred": [x for p in parts for x in p[0]], "score": np.concatenate([p[1] for p in parts]) if parts else np.zeros(0)})

    return predict.asNondeterministic()  # else a filter on what it found is pushed below it, and every text goes to two workers


def with_language(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """docs with lang_pred and score; every row stays, columns of these names are replaced.

    A text that is null or has no letter is `und` with score 0, as every text is where nothing was learned. Equal texts
    get the same values; an empty table stays empty.
    """
    key = next(f"_found{k}" for k in range(len(docs.columns) + 1) if f"_found{k}" not in docs.columns)
    found = docs.withColumn(key, predictor(model)(F.col(text)))
    return found.withColumn("lang_pred", F.col(f"{key}.lang_pred")).withColumn("score", F.col(f"{key}.score")).drop(key)


def known_language(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents with a language that was learned and a score of at least `least`; lang becomes that language where
    it was null. All of them stay where nothing can be learned.

    Null texts and texts without a letter go; equal texts stay or go together; null ids stay as they are; columns that
    documents do not have are left out, whatever their names; an empty table stays empty; very long texts are read whole."""
    model = fit(docs)
    if model is None:
        return docs.select(*DOCUMENT_COLUMNS)
    kept = with_language(docs.select(*DOCUMENT_COLUMNS), model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*DOCUMENT_COLUMNS)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A language of every document, also of those with null, empty or repeated ids and texts (see with_language)."""
    docs = table(spark, sf_dir, "documents")
    found = with_language(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id"), MODULUS, REMAINDER).alias("held_out"), "lang_pred", "score")
