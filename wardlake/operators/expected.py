"""Expected stays and readmissions: what a population like this one would have had (indirect standardisation).

Records are brought to the distinct patterns of their features first, so a fit passes over patterns and their counts. Linear
fits solve normal equations, logistic ones take Newton steps; Spark sums the matrix and the gradient, of as many rows and
columns as there are levels of features, and the driver solves for the coefficients.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Newton steps at most, and the largest change of a coefficient at which they end.
STEPS, CLOSE = 40, 1e-10
#: Levels of all features together: the fit is for a few dozen categories, not for codes.
MOST_LEVELS = 400


def design(patterns: DataFrame, features: list[str]) -> list[tuple[str, str]]:
    """(feature, level) of each column of the design, the intercept (both empty) first. Of each feature the most frequent level
    is left out; nulls are a level."""
    counts = patterns.select(F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.coalesce(F.col(f).cast("string"), F.lit("")).alias("v"), F.col("n").alias("n")) for f in features])).alias("x")).groupBy("x.f", "x.v").agg(F.sum("x.n").alias("n"))
    found = counts.orderBy("f", F.desc("n"), "v").limit(MOST_LEVELS + 1).collect()
    if len(found) > MOST_LEVELS:
        raise ValueError(f"more than {MOST_LEVELS} levels")
    return [("", "")] + [(r["f"], r["v"]) for k, r in enumerate(found) if k and found[k - 1]["f"] == r["f"]]


def terms(columns: list[tuple[str, str]]) -> list[Column]:
    return [F.lit(1.0) if not f else (F.coalesce(F.col(f).cast("string"), F.lit("")) == v).cast("double") for f, v in columns]


def score(columns: list[tuple[str, str]], beta: np.ndarray) -> Column:
    return reduce(Column.__add__, [x * float(b) for x, b in zip(terms(columns), beta, strict=True)])


def sums(patterns: DataFrame, columns: list[tuple[str, str]], weight: Column, rest: Column) -> tuple[np.ndarray, np.ndarray]:
    """(sum of weight x x', sum of rest x) over the patterns."""
    x, d = terms(columns), len(columns)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    named = patterns.select(*[c.alias(f"x{i}") for i, c in enumerate(x)], weight.alias("w"), rest.alias("r"))
    got = named.agg(F.array(*[F.sum(F.col(f"x{i}") * F.col(f"x{j}") * F.col("w")) for i, j in pairs]).alias("m"), F.array(*[F.sum(F.col(f"x{i}") * F.col("r")) for i in range(d)]).alias("g")).first()
    m = np.zeros((d, d))
    for (i, j), v in zip(pairs, got["m"], strict=True):
        m[i, j] = m[j, i] = v or 0.0
    return m, np.array([v or 0.0 for v in got["g"]])


def fit(records: DataFrame, features: list[str], outcome: str, logistic: bool = False) -> Column:
    """The expected outcome of a record with the features' columns, fitted on records (those without an outcome do not count).
    logistic: the outcome is 0 or 1 and the expected one a probability. Features that say the same share their effect."""
    y = F.col(outcome).cast("double")
    patterns = records.where(y.isNotNull()).groupBy(*features).agg(F.count("*").alias("n"), F.sum(y).alias("y")).persist()
    try:
        columns = design(patterns, features)
        beta = np.zeros(len(columns))
        for _ in range(STEPS if logistic else 1):
            at = score(columns, beta)
            mean = 1 / (1 + F.exp(-at)) if logistic else at
            m, g = sums(patterns, columns, F.col("n") * mean * (1 - mean) if logistic else F.col("n").cast("double"), F.col("y") - F.col("n") * mean)
            step = np.linalg.lstsq(m, g, rcond=None)[0]
            beta = np.clip(beta + step, -30, 30) if logistic else beta + step  # a level whose outcomes are all alike goes no further
            if np.abs(step).max(initial=0) < CLOSE:
                break
    finally:
        patterns.unpersist()
    at = score(columns, beta)
    return 1 / (1 + F.exp(-at)) if logistic else at


def by_strata(records: DataFrame, features: list[str], outcome: str) -> DataFrame:
    """records with `expected`: the mean outcome of all records with their features; null where none of those has one."""
    means = records.groupBy(*features).agg(F.avg(F.col(outcome).cast("double")).alias("expected"))
    same = reduce(Column.__and__, [F.col(f"r.{f}").eqNullSafe(F.col(f"m.{f}")) for f in features])
    return records.alias("r").join(means.alias("m"), same, "left").select("r.*", "m.expected")


def observed_over_expected(records: DataFrame, keys: list[str], outcome: str, expected: str = "expected") -> DataFrame:
    """n, observed and expected sums, and their ratio, by keys, of the records that have an outcome."""
    got = records.where(F.col(outcome).isNotNull()).groupBy(*keys).agg(F.count("*").alias("n"), F.sum(F.col(outcome).cast("double")).alias("observed"), F.sum(expected).alias("expected"))
    return got.withColumn("ratio", F.col("observed") / F.nullif("expected", F.lit(0.0)))
