"""Aggregates over standard encounters, diagnoses, procedures and vitals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlake.functions import tables as T


def readmission_flags(enc: DataFrame, days: int = 30) -> DataFrame:
    """enc with days since the patient's previous encounter of any kind ended, and whether that makes a readmission.
    Rows without a patient are spread by their own id and get no flag."""
    who = F.coalesce(F.col("patient_id").cast("string"), F.concat(F.lit("-"), F.col("encounter_id").cast("string")))
    order = Window.partitionBy(who).orderBy(F.col("admission_date").asc_nulls_first(), "encounter_id")
    gap = F.floor(F.timestamp_diff("SECOND", F.lag("discharge_date").over(order), F.col("admission_date")) / 86400.0)
    gap = F.when(F.col("patient_id").isNotNull(), gap)
    return enc.withColumn("days_since_discharge", gap).withColumn("is_readmission", F.coalesce((F.col("days_since_discharge") > 0) & (F.col("days_since_discharge") <= days), F.lit(False)))


def upper_median(value: str) -> Column:
    """The upper median as an aggregate: the middle value, or the upper of the two. Distinct values are counted, so a group
    of any size takes as much memory as it has different values."""
    return -F.expr(f"percentile_disc(0.5) within group (order by -({value}))")


def ed_summary(enc: DataFrame) -> DataFrame:
    """One row for the completed emergency encounters: count, stay in hours without zeros, dispositions."""
    done = enc.where("is_emergency and is_completed")
    hours = F.when(F.col("los_hours") > 0, F.col("los_hours"))
    how = F.col("discharge_disposition")
    return done.agg(
        F.count("*").alias("total_visits"), F.avg(hours).alias("avg_los_hours"), F.min(hours).alias("min_los_hours"), F.max(hours).alias("max_los_hours"),
        F.count_if(how == "admitted").alias("admitted"), F.count_if(how.isin("discharged", "home")).alias("discharged"), F.count_if(how.isin("ama", "left_ama")).alias("left_ama"),
        upper_median("if(los_hours > 0, los_hours, null)").alias("median_los_hours"),
    )


def ed_counts(enc: DataFrame, by: str) -> DataFrame:
    return enc.where("is_emergency and is_completed").groupBy(by).agg(F.count("*").alias("visits"))


def counts_as_map(df: DataFrame, group: list[str], key: str, missing: str = "unknown") -> DataFrame:
    """group, total and counts: how often each value of key occurs, as a map in the order of the values. Values are counted
    before they are gathered, so a map holds as many entries as a group has values, however many rows there are."""
    one = df.groupBy(*group, F.coalesce(F.col(key).cast("string"), F.lit(missing)).alias("_key")).agg(F.count("*").alias("_n"))
    return one.groupBy(*group).agg(F.sum("_n").alias("total"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("_key", "_n")))).alias("counts"))


def charlson(diagnoses: DataFrame, ages: DataFrame) -> DataFrame:
    """patient_id, one 0/1 column for each condition, the index and the age-adjusted index. One pass: the maximum of each
    condition over a patient's distinct codes, so a code is matched once for each patient who has it."""
    codes = diagnoses.select("patient_id", "code").distinct()
    conditions = codes.groupBy("patient_id").agg(*[F.max(F.col("code").rlike(p).cast("int")).alias(name) for name, (_, p) in T.CHARLSON.items()])
    score = sum((F.col(name) * w for name, (w, _) in T.CHARLSON.items()), F.lit(0))
    points = F.when(F.col("age") >= 50, F.floor((F.col("age") - 40) / 10)).otherwise(0)
    out = conditions.withColumn("charlson_index", score).join(ages.select("patient_id", "age"), "patient_id", "left")
    return out.withColumn("age_adjusted_index", (F.col("charlson_index") + points).cast("long"))


def or_daily(procs: DataFrame, hours: float = 10.0) -> DataFrame:
    cases = procs.where("is_surgical and duration_minutes is not null")
    day = F.col("performed_date").cast("date")
    return cases.groupBy(day.alias("day")).agg(F.count("*").alias("cases"), F.sum("duration_minutes").alias("minutes")).withColumn("utilisation_pct", F.round(F.col("minutes") / (hours * 60) * 100, 1))


def or_utilisation(procs: DataFrame, hours: float = 10.0) -> DataFrame:
    """One row: cases, minutes, mean, upper median, range, operating days and the mean of the days' utilisation."""
    cases = procs.where("is_surgical and duration_minutes is not null")
    one = cases.agg(F.count("*").alias("total_cases"), F.sum("duration_minutes").alias("total_minutes"), F.avg("duration_minutes").alias("avg_minutes"), F.min("duration_minutes").alias("min_minutes"), F.max("duration_minutes").alias("max_minutes"), upper_median("duration_minutes").alias("median_duration_minutes"))
    days = or_daily(procs, hours)
    return one.select("*", days.agg(F.count("*").alias("n")).scalar().alias("operating_days"), days.agg(F.avg("utilisation_pct").alias("a")).scalar().alias("avg_utilisation_pct"))


def vital_trend(vitals: DataFrame, name: str) -> DataFrame:
    """Each reading with its change since the patient's reading before."""
    order = Window.partitionBy("patient_id").orderBy("recorded_date", "source_id")
    return vitals.select("source_id", "patient_id", name, (F.col(name) - F.lag(name).over(order)).alias("change"))


def vitals_wide(long: DataFrame, names: list[str]) -> DataFrame:
    """One row for each patient and time from rows of name and value."""
    return long.groupBy("patient_id", "recorded_date").pivot("name", names).agg(F.max("value"))


def rate(part: Column, whole: Column, digits: int = 2, per: float = 100.0) -> Column:
    return F.round(F.sum(part) / F.nullif(F.sum(whole), F.lit(0)) * per, digits)
