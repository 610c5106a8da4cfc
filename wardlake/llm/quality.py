"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from wardlake.llm.common import DOCUMENT_COLUMNS, checkpointed, held_out, isotonic, labelled_sample, part_of, table, worker_state
from wardlake.llm.textstats import QUALITY, quality_features

MODULUS, REMAINDER, CUT = 4, 2, 0.7
#: At most about so many labelled documents are learned from.
SAMPLE = 12_000
FEATURES = 320
RIDGE = 3e-3


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    projection: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: tuple[np.ndarray, np.ndarray]

    def fourier(self, x: np.ndarray) -> np.ndarray:
        """Their inner products approximate a Gaussian kernel of the standardised statistics; the last is constant."""
        z = np.clip((x - self.mean) / self.scale, -5, 5) @ self.projection + self.phase
        return np.hstack([np.cos(z) * np.sqrt(2 / len(self.phase)), np.ones((len(x), 1))])

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.fourier(x) @ self.weights, *self.knots)


def statistics(texts) -> np.ndarray:
    return np.array([quality_features(t) for t in texts], dtype=float).reshape(-1, len(QUALITY))


def partition_sums(model: QualityModel) -> Callable:
    """For mapInPandas: one row for each partition with its part of the normal equations."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = 0, 0
        for x in batches:
            z = model.fourier(np.stack(x["x"])) if len(x) else np.zeros((0, len(model.phase) + 1))
            a, b = a + z.T @ z, b + z.T @ x["y"].to_numpy(float)
        if np.ndim(a):
            yield pd.DataFrame({"a": [a.ravel()], "b": [b]})

    return sums


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", bound: int = SAMPLE, seed: int = 5) -> QualityModel | None:
    """Learns from at most about `bound` labelled documents that are not held out, three quarters of them for the
    ridge weights and the rest for calibration. None where no label can be learned from.

    The sample's statistics lie in a few partitions; each adds up its normal equations, and the driver adds those.
    """

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            yield pd.DataFrame({"part": x["part"], "y": x["y"], "x": list(statistics(x["text"]))})

    sample = labelled_sample(docs, labels, target, MODULUS, REMAINDER, bound).withColumn("part", part_of(F.col("doc_id"), 4, seed))
    sample = checkpointed(sample.select("part", "y", "text").mapInPandas(measured, "part int, y double, x array<double>").repartition(8))
    k = len(QUALITY)
    moments = sample.where("part > 0").agg(F.count("*").alias("n"), *[f(F.col("x")[i]).alias(f"{name}{i}") for i in range(k) for name, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    if not moments["n"]:
        return None
    rng = np.random.default_rng(seed)
    scale = np.array([moments[f"s{i}"] for i in range(k)])
    model = QualityModel(np.array([moments[f"m{i}"] for i in range(k)]), np.where(scale > 1e-9, scale, 1.0), rng.normal(0, np.sqrt(1.0 / k), (k, FEATURES)), rng.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + 1), (np.zeros(1), np.zeros(1)))
    parts = sample.where("part > 0").select("x", "y").mapInPandas(partition_sums(model), "a array<double>, b array<double>").collect()  # 8 partitions
    a = sum(np.array(p["a"]) for p in parts).reshape(FEATURES + 1, FEATURES + 1)
    model.weights = np.linalg.solve(a + RIDGE * np.eye(FEATURES + 1), sum(np.array(p["b"]) for p in parts))
    rest = sample.where("part = 0").select("x", "y").toPandas()  # a quarter of the bounded sample
    if len(rest):
        model.knots = isotonic(model.fourier(np.stack(rest["x"])) @ model.weights, rest["y"].to_numpy(float))
    else:
        model.knots = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    return model


def scorer(model: QualityModel | None) -> Callable:
    @F.pandas_udf(DoubleType())
    def score(text: pd.Series) -> pd.Series:
        worker_state("quality")
        return pd.Series(model.score(statistics(text)) if model is not None else np.full(len(text), 0.5), dtype="float64")

    return score


def with_quality(docs: DataFrame, model: QualityModel | None, text: str = "text", out: str = "score") -> DataFrame:
    """docs with a score from 0 to 1 of each whole text; every row and column stays, one named `out` is replaced.

    Null texts score as empty ones, equal texts score the same, an empty table stays empty; without a model all
    scores are 0.5.
    """
    return docs.withColumn(out, scorer(model)(F.col(text)))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score reaches CUT; all of them where nothing can be learned.

    Null texts score as empty ones, equal texts score the same, so repeated rows stay or go together; null ids stay as they
    are; columns that documents do not have are left out, whatever their names; an empty table stays empty; very long texts
    are scored whole, one at a time."""
    model = fit(docs, labels)
    if model is None:
        return docs.select(*DOCUMENT_COLUMNS)
    return with_quality(docs.select(*DOCUMENT_COLUMNS), model, out="_score").where(F.col("_score") >= CUT).drop("_score")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score of every document, also of those with null, empty or repeated ids and texts (see with_quality)."""
    docs = table(spark, sf_dir, "documents")
    scored = with_quality(docs.select("doc_id", "text"), fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id"), MODULUS, REMAINDER).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
