"""Metric tables that views and panels read: census, emergency hours, readmissions, lengths of stay, indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.operators.metrics import next_admission


def located(stays: DataFrame, locations: DataFrame) -> DataFrame:
    """Stays with the columns of their location."""
    return stays.join(locations, "location_key")


def census_table(stays: DataFrame, keys: list[str], first: str, last: str) -> DataFrame:
    """keys, census_date, midnight_census, admissions, discharges and occupancy_rate for each day on which a place had any.

    Each stay becomes one row for each of its nights, its admission and its discharge inside the window, and one grouping
    counts them, so days are not joined with stays. keys hold operational_beds. A stay without an admission has no nights,
    one without a discharge is still there.
    """
    a, b = F.col("admission_date").cast("date"), F.col("discharge_date").cast("date")
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    start, end = F.greatest(a, low), F.least(F.coalesce(F.date_sub(b, 1), high), high)
    row = lambda day, *what: F.struct(day.alias("census_date"), *[F.lit(int(name in what)).alias(name) for name in ("night", "came", "left")])
    nights = F.when(a.isNotNull() & (start <= end), F.transform(F.sequence(start, end), lambda d: row(d, "night"))).otherwise(F.array().cast("array<struct<census_date:date,night:int,came:int,left:int>>"))
    days = stays.select(*keys, F.explode(F.concat(nights, F.array(row(a, "came"), row(b, "left")))).alias("d")).select(*keys, "d.*").where(F.col("census_date").between(low, high))
    counts = days.groupBy("census_date", *keys).agg(F.sum("night").alias("midnight_census"), F.sum("came").alias("admissions"), F.sum("left").alias("discharges"))
    return counts.withColumn("occupancy_rate", F.round(F.col("midnight_census") * 100.0 / F.nullif("operational_beds", F.lit(0)), 2))


def ed_table(arrivals: DataFrame, keys: list[str]) -> DataFrame:
    """Emergency arrivals by keys, date and hour: volumes, dispositions, waits, stays in minutes, triage levels."""
    how = {"admitted": "admitted", "discharged": "discharged", "transferred": "transferred", "left_without_seen": "lwbs", "left_ama": "ama"}
    stay = F.col("stay_minutes")
    return arrivals.groupBy(F.col("arrived").cast("date").alias("metric_date"), F.hour("arrived").alias("metric_hour"), *keys).agg(
        F.count("*").alias("arrivals"), F.count_if(F.col("disposition") != "lwbs").alias("patients_in_ed"), F.count_if(F.col("wait_minutes") >= 30).alias("patients_waiting"),
        *[F.count_if(F.col("disposition") == v).alias(k) for k, v in how.items()],
        F.avg("wait_minutes").alias("avg_door_to_provider"), F.avg(stay).alias("avg_length_of_stay"), F.percentile(stay, F.lit(0.5)).alias("median_los"), F.percentile(stay, F.lit(0.9)).alias("p90_los"),
        *[F.count_if(F.col("esi") == level).alias(f"esi_{level}_count") for level in range(1, 6)],
    )


def readmission_table(stays: DataFrame, keys: list[str], category: Column, preventable: list[str], expected: dict[str, float], other: float) -> DataFrame:
    """Completed inpatient stays by keys, day of discharge and category: how many were followed by another within 30 days,
    how many of those in a preventable category, and the rate that is expected of the category."""
    done = next_admission(stays.where("is_inpatient")).where("is_completed").withColumn("diagnosis_category", category)
    back = F.timestamp_diff("SECOND", F.col("discharge_date"), F.col("next_admission")) <= 30 * 86400
    norm = F.coalesce(*[F.when(F.col("diagnosis_category") == k, F.lit(v)) for k, v in expected.items()], F.lit(other))
    out = done.groupBy(F.col("discharge_date").cast("date").alias("discharge_date"), "diagnosis_category", *keys).agg(
        F.count("*").alias("index_discharges"), F.count_if(back).alias("readmissions_30_day"), F.count_if(back & F.col("diagnosis_category").isin(preventable)).alias("preventable_30_day")
    )
    return out.withColumn("readmission_rate_30_day", F.col("readmissions_30_day") / F.col("index_discharges")).withColumn("expected_rate", norm)


def los_table(stays: DataFrame, keys: list[str], expected: float = 4.5) -> DataFrame:
    """Lengths of completed stays in days by keys and day of discharge."""
    d = F.col("los_days")
    quartiles = [F.percentile(d, F.lit(q)).alias(name) for name, q in {"median_los": 0.5, "p25_los": 0.25, "p75_los": 0.75, "p90_los": 0.9}.items()]
    out = stays.where("is_completed").groupBy(F.col("discharge_date").cast("date").alias("metric_date"), *keys).agg(
        F.count("*").alias("discharge_count"), F.avg(d).alias("avg_los"), *quartiles, F.min(d).alias("min_los"), F.max(d).alias("max_los"), F.stddev_samp(d).alias("std_dev_los"), *[F.count_if(d >= n).alias(f"long_stay_{n}_plus") for n in (7, 14, 30)]
    )
    return out.withColumn("expected_los", F.lit(expected)).withColumn("los_index", F.col("avg_los") / expected)


def indicator_table(observed: DataFrame, keys: list[str], hit: Column, targets: dict[str, float]) -> DataFrame:
    """observed (keys with indicator_code, metric_date) as daily indicators: numerator, denominator, rate, target_rate, meets_target.
    targets are few and fixed; an indicator without one never meets it."""
    target = F.coalesce(*[F.when(F.col("indicator_code") == k, F.lit(v)) for k, v in targets.items()])
    out = observed.groupBy("metric_date", *keys).agg(F.count_if(hit).alias("numerator"), F.count("*").alias("denominator"))
    return out.withColumn("rate", F.col("numerator") / F.col("denominator")).withColumn("target_rate", target).withColumn("meets_target", F.coalesce(F.col("rate") <= F.col("target_rate"), F.lit(False)))
