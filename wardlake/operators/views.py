"""Views and dashboard panels over the metric tables, each a function of the table and of the day it is looked at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.operators.summaries import rate


def recent(df: DataFrame, at: str, as_of: str, days: int) -> DataFrame:
    """Rows of the last `days` days up to as_of; 0 for that day alone. Rows without a date are not there."""
    day = F.lit(as_of).cast("date")
    return df.where(F.col(at).cast("date").between(F.date_sub(day, days), day))


def between(df: DataFrame, at: str, first: str, last: str) -> DataFrame:
    return df.where(F.col(at).cast("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def sums(**columns: str) -> list[Column]:
    return [F.sum(c).alias(name) for name, c in columns.items()]


#: The last bits of a sum of doubles depend on the order of rows. Means are never negative here; this much more makes a
#: tie go up in any order.
TIE = 1e-9


def mean(column: str | Column, digits: int, per: float = 1.0) -> Column:
    return F.round(F.avg(column) / per + TIE, digits)


def percent(part: str, whole: str, digits: int) -> Column:
    return rate(F.col(part), F.col(whole), digits)


# ---- census


def census_current(census: DataFrame, locations: DataFrame, as_of: str) -> DataFrame:
    places = locations.select(F.col("facility_name").alias("facility"), "unit", "location_type", "operational_beds")
    today = recent(census, "census_date", as_of, 0).select("facility", "unit", "midnight_census", "admissions", "discharges")
    return today.join(places, ["facility", "unit"]).select(
        F.col("facility").alias("facility_name"), "unit", "location_type", F.col("midnight_census").alias("current_census"), "operational_beds",
        F.round(F.col("midnight_census") / F.nullif("operational_beds", F.lit(0)) * 100, 1).alias("occupancy_pct"), F.col("admissions").alias("today_admissions"), F.col("discharges").alias("today_discharges"), (F.col("admissions") - F.col("discharges")).alias("net_change"),
    )


def census_trend(census: DataFrame, as_of: str) -> DataFrame:
    return recent(census, "census_date", as_of, 30).groupBy("census_date", "facility").agg(*sums(total_census="midnight_census", total_beds="operational_beds", total_admissions="admissions", total_discharges="discharges"), percent("midnight_census", "operational_beds", 1).alias("occupancy_pct")).orderBy("census_date", "facility")


def census_by_weekday(census: DataFrame, as_of: str) -> DataFrame:
    """Sunday is day 0."""
    d = F.col("census_date")
    n = "midnight_census"
    return recent(census, "census_date", as_of, 90).groupBy((F.dayofweek(d) - 1).alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name")).agg(mean(n, 0).alias("avg_census"), F.max(n).alias("max_census"), F.min(n).alias("min_census"), mean("occupancy_rate", 1).alias("avg_occupancy_pct")).orderBy("day_of_week")


def inpatients_by_unit(stays: DataFrame, as_of: str) -> DataFrame:
    """Distinct stays that are open at as_of, by place. Stays are counted by place, whose attributes are part of the key."""
    now = F.lit(as_of).cast("timestamp_ntz")
    here = stays.where((F.col("admission_date") <= now) & (F.col("discharge_date").isNull() | (F.col("discharge_date") > now)))
    out = here.groupBy("unit", "location_type", "service_line", "operational_beds").agg(F.countDistinct("encounter_id").alias("active_encounters"))
    return out.withColumn("occupancy_pct", F.round(F.col("active_encounters") / F.nullif("operational_beds", F.lit(0)) * 100, 1)).orderBy("unit")


def census_departments(census: DataFrame, as_of: str) -> DataFrame:
    named = sums(total_patients="midnight_census", total_licensed_beds="licensed_beds", total_operational_beds="operational_beds", todays_admissions="admissions", todays_discharges="discharges")
    return recent(census, "census_date", as_of, 0).groupBy("facility", "department").agg(*named, mean("occupancy_rate", 1).alias("avg_occupancy_pct"))


# ---- emergency department


def ed_status(ed: DataFrame, as_of: str, by: tuple[str, ...] = ("facility", "ed_location")) -> DataFrame:
    named = sums(todays_arrivals="arrivals", admitted_today="admitted", discharged_today="discharged", lwbs_today="left_without_seen")
    return recent(ed, "metric_date", as_of, 0).groupBy(*by).agg(*named, F.max("patients_in_ed").alias("current_patients"), F.max("patients_waiting").alias("waiting_for_bed"), mean("avg_door_to_provider", 0).alias("avg_wait_minutes"), mean("avg_length_of_stay", 1, 60).alias("avg_los_hours"))


def ed_performance(ed: DataFrame, as_of: str) -> DataFrame:
    one = ed_status(ed, as_of, ("facility",))
    return one.select("facility", F.col("todays_arrivals").alias("total_arrivals"), F.col("current_patients").alias("current_census"), "avg_wait_minutes", "avg_los_hours", F.col("lwbs_today").alias("lwbs_count"))


def ed_hourly_pattern(ed: DataFrame, as_of: str) -> DataFrame:
    """Each row of today by hour beside the mean of the last 30 days; hours without a row today count 0."""
    usual = recent(ed, "metric_date", as_of, 30).groupBy(F.col("metric_hour").alias("hour")).agg(mean("arrivals", 1).alias("avg_arrivals"))
    today = recent(ed, "metric_date", as_of, 0).select(F.col("metric_hour").alias("hour"), "arrivals")
    now = F.coalesce("arrivals", F.lit(0))
    return usual.join(today, "hour", "left").select("hour", now.alias("today_arrivals"), "avg_arrivals", (now - F.col("avg_arrivals")).alias("variance")).orderBy("hour")


def ed_los_trend(ed: DataFrame, as_of: str) -> DataFrame:
    hours = {"avg_los_hours": "avg_length_of_stay", "median_los_hours": "median_los", "p90_los_hours": "p90_los"}
    return recent(ed, "metric_date", as_of, 30).groupBy("metric_date", "facility").agg(*[mean(c, 1, 60).alias(n) for n, c in hours.items()], *sums(total_arrivals="arrivals")).orderBy("metric_date", "facility")


def ed_dispositions(ed: DataFrame, as_of: str) -> DataFrame:
    named = sums(admitted="admitted", discharged="discharged", transferred="transferred", lwbs="left_without_seen", ama="left_ama", total_arrivals="arrivals")
    return recent(ed, "metric_date", as_of, 30).groupBy("metric_date").agg(*named, percent("admitted", "arrivals", 1).alias("admission_rate_pct")).orderBy("metric_date")


def ed_waits(ed: DataFrame, as_of: str) -> DataFrame:
    w = "avg_door_to_provider"
    return recent(ed, "metric_date", as_of, 7).groupBy(F.col("metric_hour").alias("hour")).agg(mean(w, 0).alias("avg_wait_minutes"), F.round(F.min(w), 0).alias("min_wait"), F.round(F.max(w), 0).alias("max_wait")).orderBy("hour")


# ---- lengths of stay


def los_trend(los: DataFrame, as_of: str) -> DataFrame:
    days = {"avg_los_days": "avg_los", "median_los_days": "median_los", "expected_los_days": "expected_los"}
    return recent(los, "metric_date", as_of, 90).groupBy("metric_date", "service_line").agg(*sums(discharges="discharge_count"), *[mean(c, 1).alias(n) for n, c in days.items()], mean("los_index", 2).alias("los_index")).orderBy("metric_date", "service_line")


def los_by_drg(los: DataFrame, as_of: str, top: int = 20, near: float = 0.1) -> DataFrame:
    """The groups with most discharges, ties by code, and whether their index is more than `near` from 1."""
    x = F.avg("los_index")
    judged = F.when(x > 1 + near, "Above Expected").when(x < 1 - near, "Below Expected").otherwise("At Expected")
    return recent(los, "metric_date", as_of, 365).groupBy("drg_code").agg(*sums(total_discharges="discharge_count"), mean("avg_los", 1).alias("avg_los_days"), mean("expected_los", 1).alias("expected_los_days"), mean("los_index", 2).alias("los_index"), judged.alias("performance")).orderBy(F.desc("total_discharges"), "drg_code").limit(top)


def long_stays(los: DataFrame, as_of: str) -> DataFrame:
    named = sums(total_discharges="discharge_count", **{f"stays_{n}_plus_days": f"long_stay_{n}_plus" for n in (7, 14, 30)})
    return recent(los, "metric_date", as_of, 90).groupBy("metric_date", "facility").agg(*named, percent("long_stay_7_plus", "discharge_count", 1).alias("pct_7_plus_days")).orderBy("metric_date", "facility")


def los_distribution(los: DataFrame, as_of: str) -> DataFrame:
    one = {"mean_los": "avg_los", "median_los": "median_los", "p25_los": "p25_los", "p75_los": "p75_los", "p90_los": "p90_los"}
    return recent(los, "metric_date", as_of, 30).groupBy("service_line").agg(*[mean(c, 1).alias(n) for n, c in one.items()], mean("std_dev_los", 2).alias("std_dev")).orderBy("service_line")


# ---- readmissions


def readmissions_by(table: DataFrame, as_of: str, days: int, by: tuple[str, ...], *more: Column, least: int = 0) -> DataFrame:
    """Discharges, readmissions and their rate by the given columns, where there are `least` discharges or more."""
    named = sums(total_discharges="index_discharges", total_readmissions="readmissions_30_day")
    out = recent(table, "discharge_date", as_of, days).groupBy(*by).agg(*named, percent("readmissions_30_day", "index_discharges", 2).alias("readmission_rate_pct"), *more)
    return out.where(F.col("total_discharges") >= least) if least else out


def readmissions_by_diagnosis(table: DataFrame, as_of: str) -> DataFrame:
    out = readmissions_by(table, as_of, 365, ("diagnosis_category",), mean("expected_rate", 2, 0.01).alias("expected_rate_pct"), least=10)
    return out.orderBy(F.desc_nulls_first("readmission_rate_pct"))


def preventable_readmissions(table: DataFrame, as_of: str) -> DataFrame:
    named = sums(all_readmissions="readmissions_30_day", preventable_readmissions="preventable_30_day")
    return recent(table, "discharge_date", as_of, 90).groupBy("discharge_date", "facility").agg(*named, percent("preventable_30_day", "readmissions_30_day", 1).alias("preventable_pct")).orderBy("discharge_date", "facility")


def readmission_summary(table: DataFrame, as_of: str) -> DataFrame:
    """The mean of daily rates, not the rate of the whole."""
    named = sums(total_discharges="index_discharges", total_readmissions="readmissions_30_day")
    return recent(table, "discharge_date", as_of, 90).groupBy("facility", "diagnosis_category").agg(*named, mean("readmission_rate_30_day", 1, 0.01).alias("avg_readmission_rate_pct")).orderBy(F.desc_nulls_first("avg_readmission_rate_pct"))


# ---- indicators


def indicator_summary(indicators: DataFrame, as_of: str) -> DataFrame:
    keys = ["indicator_category", "indicator_code", "indicator_name"]
    return recent(indicators, "metric_date", as_of, 30).groupBy(*keys).agg(*sums(total_events="numerator", total_population="denominator"), mean("rate", 2, 0.001).alias("rate_per_1000"), mean("target_rate", 2, 0.001).alias("target_per_1000"), F.count_if("meets_target").alias("periods_meeting_target")).orderBy(*keys)


def latest_rates(indicators: DataFrame, as_of: str, days: int = 31) -> DataFrame:
    """Each indicator's last rate in percent; of several on that day the one of the facility that sorts last."""
    last = F.max_by("rate", F.struct("metric_date", "facility"))
    return recent(indicators, "metric_date", as_of, days).groupBy("indicator_code").agg(F.round(last * 100, 2).alias("rate_pct"))


def compliance(indicators: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """How many percent of indicator rows meet their target."""
    return indicators.groupBy(*by).agg(F.round(F.count_if("meets_target") / F.nullif(F.count("*"), F.lit(0)) * 100, 1).alias("compliance_pct"))


def missed_targets(indicators: DataFrame, as_of: str, prefix: str) -> DataFrame:
    mine = recent(indicators, "metric_date", as_of, 30).where(F.col("indicator_code").startswith(prefix))
    return mine.agg(F.round(F.count_if(~F.col("meets_target")) / F.nullif(F.count("*"), F.lit(0)) * 100, 1).alias("missed_pct"))


def indicator_lines(indicators: DataFrame, first: str, last: str) -> DataFrame:
    """Long form for line panels: a row for each day, indicator and facility."""
    return between(indicators, "metric_date", first, last).select(F.col("metric_date").alias("time"), F.col("indicator_code").alias("metric"), "facility", F.round(F.col("rate") * 100, 2).alias("value"), F.round(F.col("target_rate") * 100, 2).alias("target")).orderBy("time", "metric", "facility")


# ---- panels over census, emergency hours and stays


def census_numbers(census: DataFrame, as_of: str) -> DataFrame:
    """One row: occupancy and patients of the last day, and how often a bed turned over in a month of 30 days."""
    day = F.lit(as_of).cast("date")
    now = F.col("census_date") >= F.date_sub(day, 1)
    return recent(census, "census_date", as_of, 30).agg(mean(F.when(now, F.col("occupancy_rate")), 1).alias("occupancy"), F.sum(F.when(now, F.col("midnight_census"))).alias("census"), rate(F.col("admissions"), F.col("operational_beds"), 2, 30.0).alias("bed_turns"))


def census_lines(census: DataFrame, first: str, last: str, target: int = 85) -> DataFrame:
    return between(census, "census_date", first, last).groupBy(F.col("census_date").alias("time")).agg(mean("occupancy_rate", 1).alias("occupancy"), F.lit(target).alias("target"), *sums(total_census="midnight_census", admissions="admissions", discharges="discharges")).orderBy("time")


def unit_occupancy(census: DataFrame, as_of: str) -> DataFrame:
    """Units on the last two days, the fullest first."""
    full = F.round(F.col("midnight_census") / F.nullif("operational_beds", F.lit(0)) * 100, 1)
    return recent(census, "census_date", as_of, 1).select("census_date", "unit", F.col("midnight_census").alias("patients"), F.col("operational_beds").alias("beds"), full.alias("occupancy_pct"), "admissions", "discharges").orderBy(F.desc_nulls_first("occupancy_pct"))


def facilities(census: DataFrame) -> DataFrame:
    return census.select("facility").distinct().orderBy("facility")


def ed_numbers(ed: DataFrame, as_of: str) -> DataFrame:
    """One row: the last day's volume, wait and rates, and the mean stay of a week."""
    day = F.lit(as_of).cast("date")
    now = lambda c: F.when(F.col("metric_date") >= F.date_sub(day, 1), F.col(c))
    return recent(ed, "metric_date", as_of, 7).agg(F.sum(now("arrivals")).alias("ed_volume"), mean(now("avg_door_to_provider"), 0).alias("avg_wait"), rate(now("left_without_seen"), now("arrivals"), 1).alias("lwbs_rate"), rate(now("admitted"), now("arrivals"), 1).alias("admission_rate"), mean("avg_length_of_stay", 0).alias("avg_ed_los"))


def ed_lines(ed: DataFrame, first: str, last: str) -> DataFrame:
    return between(ed, "metric_date", first, last).groupBy(F.col("metric_date").alias("time")).agg(*sums(ed_volume="arrivals", admissions="admitted"), mean("avg_door_to_provider", 0).alias("door_to_provider"), mean("avg_length_of_stay", 0).alias("ed_los")).orderBy("time")


def ed_hours(ed: DataFrame, first: str, last: str) -> DataFrame:
    return between(ed, "metric_date", first, last).groupBy(F.col("metric_hour").alias("hour")).agg(*sums(arrivals="arrivals")).orderBy("hour")


def stays_by(stays: DataFrame, by: str, at: str, first: str, last: str, top: int | None = None) -> DataFrame:
    """Stays and their mean length by a column, the longest first; only the first `top` groups if that is given."""
    out = between(stays, at, first, last).where(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias("stays"), mean("los_days", 2).alias("avg_los")).orderBy(F.desc_nulls_first("avg_los"), by)
    return out.limit(top) if top else out


def los_lines(stays: DataFrame, first: str, last: str) -> DataFrame:
    return between(stays, "admission_date", first, last).groupBy(F.col("admission_date").cast("date").alias("time")).agg(mean("los_days", 2).alias("avg_los")).orderBy("time")


def stay_numbers(flagged: DataFrame, as_of: str) -> DataFrame:
    """One row for the stays that ended in the last 30 days: mean length and share of readmissions."""
    return recent(flagged, "discharge_date", as_of, 30).agg(mean("los_days", 1).alias("los"), F.round(F.count_if("is_readmission") / F.nullif(F.count("*"), F.lit(0)) * 100, 1).alias("readmission_rate"))
