"""Table loads: upserts, history, retention and watermarks over Parquet tables.

Every load is a function from the old table and new rows to the next table. versioned.py writes that to folders of its own and
then records it as the table's next version, so a path that is being read is never overwritten.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as st

from wardlake.operators import versioned
from wardlake.operators.versioned import current, fitted, latest, publish

__all__ = ["append", "create", "current", "fitted", "latest", "publish"]


def upsert(base: DataFrame, updates: DataFrame, keys: list[str], by: str) -> DataFrame:
    """updates replace rows of base that have their key; new keys are added."""
    new = latest(updates, keys, by).select(base.columns)
    return base.join(new, keys, "left_anti").select(base.columns).unionByName(new)


def upsert_columns(base: DataFrame, updates: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Only `columns` change where a key is there already. updates has each key once."""
    u = updates.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in base.columns if c not in keys], F.lit(True).alias("_there"))
    b = base.withColumn("_old", F.lit(True))
    both = b.join(u, keys, "full_outer")
    pick = lambda c: F.when(F.col("_old").isNull() | (F.col("_there") & F.lit(c in columns)), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
    return both.select(*keys, *[pick(c) for c in base.columns if c not in keys])


def insert_if_absent(base: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the base lacks are added; of several of one key the first in the order of all columns."""
    first = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in rows.columns if c not in keys], F.lit(0))
    once = rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    return base.unionByName(once.join(base, keys, "left_anti").select(base.columns))


def retain(df: DataFrame, at: str, as_of: str, days: int = 90) -> DataFrame:
    return df.where(F.col(at) >= F.date_sub(F.lit(as_of).cast("date"), days))


def scd2(dim: DataFrame, source: DataFrame, key: str, tracked: list[str], effective: str) -> DataFrame:
    """Type-2 history: current rows whose tracked columns differ (nulls count as values) are closed at `effective`, and new
    versions and new keys are added. dim has key, tracked, effective_date, expiration_date, is_current. Of several rows of one
    key in the source the first in the order of the tracked columns counts; history.py takes all of them, and late ones."""
    day = F.lit(effective).cast("date")
    sign = F.sha2(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in tracked]), {"ignoreNullFields": "false"}), 256)
    least = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in tracked], F.lit(0))
    now = source.select(key, *tracked).withColumn("_n", F.row_number().over(least)).where("_n = 1").drop("_n").withColumn("_sign", sign)
    marked = dim.withColumn("_mine", sign).join(now.select(key, F.col("_sign").alias("_theirs")), key, "left")
    stale = F.col("is_current") & F.col("_theirs").isNotNull() & (F.col("_mine") != F.col("_theirs"))
    kept = marked.withColumn("expiration_date", F.when(stale, day).otherwise(F.col("expiration_date"))).withColumn("is_current", F.col("is_current") & ~stale).select(dim.columns)
    same = dim.where("is_current").withColumn("_sign", sign).select(key, "_sign")
    added = now.join(same, [key, "_sign"], "left_anti").select(key, *tracked, day.alias("effective_date"), F.lit(None).cast("date").alias("expiration_date"), F.lit(True).alias("is_current"))
    return kept.unionByName(added.select(dim.columns))


def event_time(*columns: str) -> Column:
    return F.greatest(*[F.col(c) for c in columns]) if len(columns) > 1 else F.col(columns[0])


def since(df: DataFrame, at: Column, watermark: str | None, lookback_hours: int = 2, default: str = "2020-01-01 00:00:00") -> DataFrame:
    """Rows from `lookback_hours` before the watermark on, so late rows are read again; upserts make that harmless."""
    start = F.lit(watermark or default).cast("timestamp_ntz")
    return df.where(at >= (start - F.make_interval(hours=F.lit(lookback_hours)) if watermark else start))


def advance(watermarks: DataFrame, moved: DataFrame) -> DataFrame:
    """watermarks (source_system, entity_type, last_value); a mark never moves back."""
    return watermarks.unionByName(moved).groupBy("source_system", "entity_type").agg(F.max("last_value").alias("last_value"))


def marks_of(watermarks: DataFrame, source_system: str | None = None) -> DataFrame:
    """The marks of a source, or all of them."""
    return watermarks if source_system is None else watermarks.where(F.col("source_system") == source_system)


def reset(watermarks: DataFrame, source_system: str, entity_type: str, to: str) -> DataFrame:
    """watermarks with one mark set, back as well as on."""
    at = F.lit(to).cast(watermarks.schema["last_value"].dataType)
    one = watermarks.sparkSession.range(1).select(F.lit(source_system).alias("source_system"), F.lit(entity_type).alias("entity_type"), at.alias("last_value"))
    return forgotten(watermarks, source_system, entity_type).unionByName(one)


def forgotten(watermarks: DataFrame, source_system: str, entity_type: str) -> DataFrame:
    return watermarks.where(~((F.col("source_system") == source_system) & (F.col("entity_type") == entity_type)))


def append(rows: DataFrame, path: str, schema: st.StructType) -> int:
    """Appends the fitted rows to the Parquet table at path and returns how many they were."""
    seen = Observation()
    fitted(rows, schema).observe(seen, F.count("*").alias("rows")).write.mode("append").parquet(path)
    return seen.get["rows"]


def create(spark: SparkSession, path: str, schema: st.StructType) -> None:
    """An empty table of that schema, in place of what is there: also how a table is truncated."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


_MARKS = st.StructType([st.StructField("source_system", st.StringType()), st.StructField("entity_type", st.StringType()), st.StructField("last_value", st.TimestampNTZType())])


def incremental_load(rows: DataFrame, root: str, marks_root: str, source_system: str, entity_type: str, keys: list[str], times: list[str], lookback_hours: int = 2) -> dict[str, int]:
    """One incremental load: rows from the mark on (less the lookback) are upserted into the keyed table at root by their
    latest event time, and then the mark moves to it. Only the parts that may hold the rows' keys are opened. If the load
    fails the mark stays, and running it again does no harm; of loads at once both survive, and a mark never moves back."""
    spark = rows.sparkSession
    for at, shape, by in ((root, rows.schema, keys), (marks_root, _MARKS, ["source_system", "entity_type"])):
        if versioned.manifest(spark, at) is None:
            versioned.create(spark.createDataFrame([], shape), at, by)
    marks = versioned.current(spark, marks_root)
    mine = marks.where((F.col("source_system") == source_system) & (F.col("entity_type") == entity_type)).agg(F.max("last_value").cast("string")).first()[0]
    fresh = since(rows.withColumn("_at", event_time(*times)), F.col("_at"), mine, lookback_hours)
    moved = fresh.agg(F.count("*").alias("rows"), F.max("_at").cast("timestamp_ntz").alias("last_value")).first()
    if not moved["rows"]:
        return {"rows": 0}
    versioned.upsert(fresh, root, keys, "_at")
    versioned.upsert(spark.createDataFrame([(source_system, entity_type, moved["last_value"])], _MARKS), marks_root, ["source_system", "entity_type"], "last_value", newer_only=True)
    return {"rows": moved["rows"]}


#: What load_sources tells of each source.
LOAD_COUNTS = "source string, extracted long, loaded long, failed long, phi_warnings long, seconds double, error string"


def load_sources(spark: SparkSession, sources: dict[str, Callable[[], DataFrame]], folder: str, warns: dict[str, Callable[[DataFrame], Column]] | None = None) -> DataFrame:
    """Loads the standard records of each source (those without `_errors`) as the next version of the table at folder/source;
    one row of LOAD_COUNTS for each source.

    Records are counted while they are written, in one pass. A source that cannot be read or written gets its error and keeps
    its last good version, and the others are loaded all the same. warns: for a source, the column that marks records to be warned of.
    """
    counts = []
    for name, read in sources.items():
        seen, began = Observation(), time.monotonic()
        try:
            df = read()
            warned = F.count_if((warns or {}).get(name, lambda _: F.lit(False))(df))
            good = F.size("_errors") == 0
            df = df.observe(seen, F.count("*").alias("extracted"), F.count_if(good).alias("loaded"), F.count_if(~good).alias("failed"), warned.alias("phi_warnings"))
            versioned.publish(df.where(good).drop("_errors"), f"{folder}/{name}")
            got = seen.get
            counts.append((name, *[got[c] for c in ("extracted", "loaded", "failed", "phi_warnings")], time.monotonic() - began, None))
        except (PySparkException, Py4JJavaError) as e:
            counts.append((name, 0, 0, 0, 0, time.monotonic() - began, str(e)))
    return spark.createDataFrame(counts, LOAD_COUNTS)
