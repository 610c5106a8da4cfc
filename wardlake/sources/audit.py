"""Audit events as JSON lines in a folder for each day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "event_time timestamp, event_type string, user_id string, action string, resource_type string, resource_hash string, event_date date"

#: To the microsecond: the writer's own form ends at milliseconds. What has fewer digits is read as well.
WRITTEN, READ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX"


def prepared(events: DataFrame) -> DataFrame:
    """Events whose resource_id became the first 16 hex digits of its hash."""
    return events.select("event_time", "event_type", "user_id", "action", "resource_type", F.substring(F.sha2(F.col("resource_id").cast("string"), 256), 1, 16).alias("resource_hash"), F.col("event_time").cast("date").alias("event_date"))


def append(events: DataFrame, folder: str) -> None:
    prepared(events).write.partitionBy("event_date").mode("append").option("timestampFormat", WRITTEN).json(folder)


def search(spark: SparkSession, folder: str, first: str, last: str, user: str | None = None, event_type: str | None = None, limit: int = 1000) -> DataFrame:
    """The newest events of the days; lines that cannot be read are skipped. Folders of other days are not read."""
    df = spark.read.schema(SCHEMA).option("mode", "DROPMALFORMED").option("timestampFormat", READ).json(folder).where(F.col("event_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    df = df if user is None else df.where(F.col("user_id") == user)
    df = df if event_type is None else df.where(F.col("event_type") == event_type)
    return df.orderBy(F.desc("event_date"), F.desc("event_time"), "resource_hash").limit(limit)
