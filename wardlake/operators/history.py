"""Type-2 history of changes that come late, backdated, repeated, several to a key and in any order.

What was seen of a key at a time is a sighting. Sightings are kept, also those that changed nothing, since a change that comes
later and lies before one of them makes it a new version. Versions follow from a key's sightings in the order of their times:
one begins where the tracked columns differ from those before, and ends where the next begins. So only the sightings decide,
and not the order in which loads bring them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlake.operators import versioned


def sightings(changes: DataFrame, key: str, tracked: list[str], at: str, by: str | None = None) -> DataFrame:
    """key, tracked, at and by of changes, once for each key and time: that of the greatest `by`, of equals the first in order
    of the tracked columns. Changes without a key or a time say nothing and are left out."""
    named = changes.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(key, at, *tracked, *([by] if by else []))
    order = [*([F.col(by).desc_nulls_last()] if by else []), *[F.col(c).asc_nulls_last() for c in tracked], F.lit(0)]
    return named.withColumn("_n", F.row_number().over(Window.partitionBy(key, at).orderBy(*order))).where("_n = 1").drop("_n")


def differ(a: list[Column], b: list[Column]) -> Column:
    """True if any of the columns differ; nulls are equal to nulls."""
    return reduce(Column.__or__, [~x.eqNullSafe(y) for x, y in zip(a, b, strict=True)], F.lit(False))


def versions(seen: DataFrame, key: str, tracked: list[str], at: str) -> DataFrame:
    """key, tracked, effective_date, expiration_date, is_current of sightings()."""
    order = Window.partitionBy(key).orderBy(at)
    first = F.row_number().over(order) == 1
    changed = seen.withColumn("_new", first | differ([F.col(c) for c in tracked], [F.lag(c).over(order) for c in tracked])).where("_new")
    following = F.lead(at).over(order)
    return changed.select(key, *tracked, F.col(at).alias("effective_date"), following.alias("expiration_date"), following.isNull().alias("is_current"))


def create(changes: DataFrame, seen_root: str, dim_root: str, key: str, tracked: list[str], at: str, by: str) -> None:
    """The table of sightings and the dimension that follows from it, from the changes there are so far (perhaps none)."""
    spark = changes.sparkSession
    versioned.create(sightings(changes, key, tracked, at, by), seen_root, [key, at], leading=1)
    versioned.create(versions(versioned.current(spark, seen_root), key, tracked, at), dim_root, [key])


def load(changes: DataFrame, seen_root: str, dim_root: str, key: str, tracked: list[str], at: str, by: str) -> None:
    """Takes changes into the sightings and works out the versions of their keys anew; other keys'
    versions are rewritten only where they share a part. A load that is run again, or that another one overtakes, changes nothing: the
    dimension is always what the sightings say."""
    versioned.upsert(changes.where(F.col(key).isNotNull() & F.col(at).isNotNull()), seen_root, [key, at], by, newer_only=True)
    keys = changes.select(key).where(F.col(key).isNotNull()).distinct()

    def spliced(dim: DataFrame) -> DataFrame:
        mine = versioned.of_keys(keys, seen_root)
        return dim.join(keys, key, "left_anti").select(dim.columns).unionByName(versions(mine, key, tracked, at).select(dim.columns))

    versioned.replace_keys(keys, dim_root, spliced)


def as_of(facts: DataFrame, dim: DataFrame, key: str, at: str, columns: list[str]) -> DataFrame:
    """facts with the dimension's columns as they were at each fact's time (null before the first version). The versions of a
    key are few, and a key's facts may be many: the join is by key alone, and Spark splits a key that is too large for a task."""
    held = dim.select(F.col(key).alias("_key"), F.col("effective_date").alias("_from"), F.col("expiration_date").alias("_to"), *columns)
    inside = (F.col(key) == F.col("_key")) & (F.col(at) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(at) < F.col("_to")))
    return facts.join(held, inside, "left").drop("_key", "_from", "_to")
