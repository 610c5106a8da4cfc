"""Hospital metrics as of a day: census, emergency throughput, readmissions, lengths of stay, indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlake.functions.dates import days
from wardlake.operators.summaries import rate


def daily_census(enc: DataFrame, first: str, last: str) -> DataFrame:
    """Patients present on each day of the window (the day of discharge not included), by group, with admissions and
    discharges; days without patients stay. Each stay becomes its days inside the window, so there is no join of days
    with stays."""
    a, b = F.col("admission_date").cast("date"), F.col("discharge_date").cast("date")
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    end = F.least(F.coalesce(F.date_sub(b, 1), high), high)
    start = F.greatest(a, low)
    stays = enc.select("department", "encounter_type", a.alias("a"), b.alias("b"), start.alias("s"), end.alias("e"))
    present = stays.where("a is not null and s <= e").select(F.explode(F.sequence("s", "e")).alias("census_date"), "department", "encounter_type")
    counts = present.groupBy("census_date").agg(F.count("*").alias("total_census"), F.count_if(F.col("department") == "ICU").alias("icu_census"), F.count_if(F.col("department").isin("MED", "SURG")).alias("med_surg_census"), F.count_if(F.col("encounter_type") == "observation").alias("observation_census"))
    moves = stays.select(F.explode(F.array(F.struct(F.col("a").alias("census_date"), F.lit(1).alias("i"), F.lit(0).alias("o")), F.struct(F.col("b").alias("census_date"), F.lit(0).alias("i"), F.lit(1).alias("o")))).alias("m")).select("m.*").where(F.col("census_date").between(low, high))
    moves = moves.groupBy("census_date").agg(F.sum("i").alias("admissions"), F.sum("o").alias("discharges"))
    spine = days(enc.sparkSession, first, last, "census_date")
    zero = ["total_census", "icu_census", "med_surg_census", "observation_census", "admissions", "discharges"]
    return spine.join(counts, "census_date", "left").join(moves, "census_date", "left").select("census_date", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in zero])


def unit_census(enc: DataFrame, as_of: Column) -> DataFrame:
    """Patients present now by department, and inpatients who stay on."""
    here = enc.where((F.col("admission_date") <= as_of) & (F.col("discharge_date").isNull() | (F.col("discharge_date") > as_of)))
    return here.groupBy(F.coalesce("department", F.lit("Unknown")).alias("department")).agg(F.countDistinct("encounter_id").alias("census"), F.count_if("is_inpatient").alias("inpatients"))


def ed_now(enc: DataFrame, as_of: Column) -> DataFrame:
    """One row of the emergency department at a time: patients who came that day and are there, those not yet seen by a provider
    (`provider_contact`), those in treatment, those who wait for a bed elsewhere, and the mean wait so far in minutes of those
    not yet seen. A patient whose discharge is set for later is there; one who boards may be in treatment too."""
    here = enc.where(F.col("is_emergency") & (F.col("admission_date") >= F.date_trunc("day", as_of)) & (F.col("admission_date") <= as_of) & (F.col("discharge_date").isNull() | (F.col("discharge_date") > as_of)))
    unseen = F.col("provider_contact").isNull() | (F.col("provider_contact") > as_of)
    waited = F.timestamp_diff("SECOND", F.col("admission_date"), as_of) / 60
    return here.agg(
        F.count("*").alias("current_volume"), F.count_if(unseen).alias("waiting"), F.count_if(~unseen & F.col("discharge_date").isNull()).alias("in_treatment"),
        F.count_if(F.col("discharge_disposition") == "admit_pending").alias("boarding"), F.round(F.avg(F.when(unseen, waited)), 2).alias("avg_wait_minutes"),
    )


def ed_daily(enc: DataFrame) -> DataFrame:
    er = enc.where("is_emergency")
    left = F.col("discharge_disposition")
    return er.groupBy(F.col("admission_date").cast("date").alias("metric_date")).agg(
        F.count("*").alias("ed_volume"), F.count_if(left == "admitted").alias("admissions"), F.count_if(left == "lwbs").alias("lwbs"),
        F.avg(F.timestamp_diff("SECOND", F.col("admission_date"), F.col("discharge_date")) / 60.0).alias("avg_los_minutes"), F.round(F.count_if(left == "admitted") / F.count("*") * 100, 2).alias("admission_rate_pct"),
    )


def next_admission(enc: DataFrame) -> DataFrame:
    """enc with the patient's first admission after the discharge. Admissions and discharges are put in one order for each
    patient and the next admission is carried back, so no stay is joined with another. Stays without a patient have none:
    they are spread by their own ids."""
    event = lambda at, kind: F.struct(at.alias("at"), F.lit(kind).alias("kind"))
    events = enc.withColumn("e", F.explode(F.array(event(F.col("discharge_date"), 1), event(F.col("admission_date"), 0))))
    who = F.coalesce(F.col("patient_id").cast("string"), F.concat(F.lit("-"), F.col("encounter_id").cast("string")))
    back = Window.partitionBy(who).orderBy(F.col("e.at").desc_nulls_first(), F.col("e.kind").desc(), "encounter_id").rowsBetween(Window.unboundedPreceding, 0)
    marked = events.withColumn("next_admission", F.when(F.col("patient_id").isNotNull(), F.last(F.when(F.col("e.kind") == 0, F.col("e.at")), True).over(back)))
    return marked.where("e.kind = 1").select(*enc.columns, "next_admission")


def readmissions(enc: DataFrame, window_days: tuple[int, ...] = (7, 14, 30)) -> DataFrame:
    """By month of discharge: completed inpatient stays, and those followed by another within so many days."""
    stays = next_admission(enc.where("is_inpatient")).where("is_completed")
    gap = F.timestamp_diff("SECOND", F.col("discharge_date"), F.col("next_admission")) / 86400.0
    month = F.trunc(F.col("discharge_date").cast("date"), "month")
    out = stays.groupBy(month.alias("month")).agg(F.count("*").alias("discharges"), *[F.count_if(gap <= n).alias(f"readmissions_{n}_day") for n in window_days])
    return out.withColumn("rate_pct", F.round(F.col(f"readmissions_{window_days[-1]}_day") / F.col("discharges") * 100, 2))


def readmissions_by_condition(enc: DataFrame, conditions: dict[str, str]) -> DataFrame:
    stays = next_admission(enc.where("is_inpatient")).where("is_completed")
    back = F.timestamp_diff("SECOND", F.col("discharge_date"), F.col("next_admission")) <= 30 * 86400
    own = {name: F.col("primary_diagnosis_code").startswith(p) for name, p in conditions.items()}
    cols = [f for name, is_it in own.items() for f in (F.count_if(is_it).alias(f"{name}_discharges"), F.count_if(is_it & back).alias(f"{name}_readmissions"))]
    return stays.groupBy(F.trunc(F.col("discharge_date").cast("date"), "month").alias("month")).agg(*cols)


def los_monthly(enc: DataFrame, by: str, expected: float = 4.5) -> DataFrame:
    done = enc.where("is_completed")
    return done.groupBy(F.trunc(F.col("discharge_date").cast("date"), "month").alias("month"), by).agg(F.count("*").alias("discharges"), F.avg("los_hours").alias("avg_los_hours")).withColumn("los_index", F.round(F.col("avg_los_hours") / 24 / expected, 4))


def los_stats(enc: DataFrame, by: str) -> DataFrame:
    d = F.col("los_hours")
    return enc.where("is_completed").groupBy(by).agg(
        F.count("*").alias("discharges"), F.avg(d).alias("avg_los"), F.percentile(d, F.lit(0.5)).alias("median_los"), F.percentile(d, F.lit(0.25)).alias("p25_los"), F.percentile(d, F.lit(0.75)).alias("p75_los"),
        F.percentile(d, F.lit(0.9)).alias("p90_los"), F.min(d).alias("min_los"), F.max(d).alias("max_los"), *[F.count_if(d >= 24 * n).alias(f"long_stay_{n}_plus") for n in (3, 5, 7)],
    )


def indicator(monthly: DataFrame, target: float) -> DataFrame:
    """monthly (month, unit, numerator, denominator) with rate, variance, whether the target is met, and the percent rank of the rate among units."""
    r = F.col("numerator") / F.nullif("denominator", F.lit(0))
    out = monthly.withColumn("rate", r).withColumn("variance", F.col("rate") - target).withColumn("meets_target", F.col("rate") <= target)
    return out.withColumn("percentile_rank", F.percent_rank().over(Window.partitionBy("month").orderBy("rate")))


def kpi_trend(monthly: DataFrame, value: str, by: str, amber: float = 5.0, red: float = 10.0) -> DataFrame:
    """Each month's value with the one before, the change in percent, its direction and a colour by the size of the change."""
    w = Window.partitionBy(by).orderBy("month")
    out = monthly.withColumn("prior", F.lag(value).over(w)).withColumn("change_pct", F.round((F.col(value) - F.col("prior")) / F.nullif("prior", F.lit(0)) * 100, 2))
    c = F.col("change_pct")
    return out.withColumn("direction", F.when(c > 0, "up").when(c < 0, "down").when(c == 0, "flat")).withColumn("status", F.when(F.abs(c) < amber, "green").when(F.abs(c) < red, "yellow").when(c.isNotNull(), "red"))


def daily_metric(df: DataFrame, at: str, flag: Column, value: Column) -> DataFrame:
    return df.groupBy(F.col(at).cast("date").alias("metric_date")).agg(F.count("*").alias("events"), F.count_if(flag).alias("flagged"), F.avg(value).alias("avg_value"), rate(flag.cast("int"), F.lit(1)).alias("flagged_pct"))
