"""The star: date, patient and other dimensions, and facts over them.

Keys are made from what they stand for, so building the same rows again gives the same keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.functions.dates import calendar, date_key, days
from wardlake.operators import loads
from wardlake.operators.summaries import readmission_flags


def rolling_dates(dim: DataFrame, as_of: str) -> DataFrame:
    """dim with the days from a year before as_of to two years after that it lacks."""
    spark = dim.sparkSession
    first, last = (spark.range(1).select(F.add_months(F.lit(as_of).cast("date"), n).cast("string").alias("d")).first()["d"] for n in (-12, 24))
    return loads.insert_if_absent(dim, calendar(days(spark, first, last)).select(dim.columns), ["date_key"])


def version_key(key: Column, effective: Column) -> Column:
    return F.concat_ws("@", key.cast("string"), F.date_format(effective, "yyyyMMdd"))


def with_patient_keys(dim: DataFrame) -> DataFrame:
    return dim.withColumn("patient_key", version_key(F.col("patient_id"), F.col("effective_date")))


def type1(rows: DataFrame, key: str, columns: list[str], by: str) -> DataFrame:
    """A dimension without history: the newest row of each business key, its columns and its key."""
    return loads.latest(rows.where(F.col(key).isNotNull()).select(key, *columns, by), [key], by).drop(by)


def current_patients(dim: DataFrame) -> DataFrame:
    return with_patient_keys(dim).where("is_current").select("patient_id", "patient_key")


def fact_encounters(encounters: DataFrame, patients: DataFrame, diagnoses: DataFrame, procedures: DataFrame, since: str | None = None, at: str = "updated_at") -> DataFrame:
    """Encounters of current patients (others have no row), changed since a time, with date keys, counts, readmissions and
    emergency flags. Diagnoses and procedures are counted before they are joined."""
    counted = lambda df, name: df.groupBy("encounter_id").agg(F.count("*").alias(name))
    flagged = readmission_flags(encounters)
    if since is not None:
        flagged = flagged.where(F.col(at) >= F.lit(since).cast("timestamp_ntz"))
    out = flagged.join(current_patients(patients), "patient_id").join(counted(diagnoses, "diagnosis_count"), "encounter_id", "left").join(counted(procedures, "procedure_count"), "encounter_id", "left")
    from_er = F.col("admit_source") == "emergency" if "admit_source" in encounters.columns else F.lit(False)
    return out.select(
        "encounter_id", "patient_key", date_key(F.col("admission_date")).alias("admission_date_key"), date_key(F.col("discharge_date")).alias("discharge_date_key"), "encounter_type", "discharge_disposition",
        "los_hours", "los_days", F.coalesce("diagnosis_count", F.lit(0)).alias("diagnosis_count"), F.coalesce("procedure_count", F.lit(0)).alias("procedure_count"), "total_charges", "is_readmission", "days_since_discharge",
        F.col("is_emergency").alias("is_ed_visit"), F.coalesce(from_er & F.col("is_inpatient"), F.lit(False)).alias("was_admitted_from_ed"),
    )


#: What changes in a fact that is there already.
FACT_CHANGES = ["discharge_date_key", "discharge_disposition", "los_hours", "los_days", "total_charges"]


def loaded_facts(old: DataFrame, new: DataFrame) -> DataFrame:
    return loads.upsert_columns(old, new, ["encounter_id"], FACT_CHANGES)


def fact_rows(rows: DataFrame, patients: DataFrame, day: str, name: str, columns: list[str]) -> DataFrame:
    """Diagnoses, procedures, labs, vitals or medications as facts: the current patient's key, the day's key as `name`, and
    the columns. Rows of patients who are not known keep a null key."""
    return rows.join(current_patients(patients), "patient_id", "left").select("patient_key", date_key(F.col(day)).alias(name), *columns)
