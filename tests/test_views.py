"""Metric tables and views: nulls, empty tables, days without rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wardlake.operators import marts, metrics, views

STAYS = "unit string, operational_beds int, admission_date timestamp_ntz, discharge_date timestamp_ntz"


def stays(spark, *rows):
    return spark.createDataFrame(list(rows), STAYS)


def census(spark, *rows):
    out = marts.census_table(stays(spark, *rows), ["unit", "operational_beds"], "2024-01-01", "2024-01-05")
    return {(r["unit"], r["census_date"].day): (r["midnight_census"], r["admissions"], r["discharges"], r["occupancy_rate"]) for r in out.collect()}


def test_census_counts_nights_and_not_the_day_of_discharge(spark):
    got = census(spark, ("A", 2, datetime(2024, 1, 2, 10), datetime(2024, 1, 4, 9)), ("A", 2, datetime(2024, 1, 3, 10), datetime(2024, 1, 3, 20)))
    assert got == {("A", 2): (1, 1, 0, 50.0), ("A", 3): (1, 1, 1, 50.0), ("A", 4): (0, 0, 1, 0.0)}


def test_census_of_open_early_and_undated_stays(spark):
    got = census(spark, ("A", 0, datetime(2023, 12, 1), None), ("B", None, None, None), ("C", 1, datetime(2024, 2, 1), None))
    assert got == {("A", d): (1, 0, 0, None) for d in range(1, 6)}


def test_daily_census_leaves_out_undated_stays(spark):
    enc = spark.createDataFrame([("ICU", "inpatient", None, None), ("ICU", "inpatient", datetime(2024, 1, 1), None)], "department string, encounter_type string, admission_date timestamp_ntz, discharge_date timestamp_ntz")
    assert [r["total_census"] for r in metrics.daily_census(enc, "2024-01-01", "2024-01-02").collect()] == [1, 1]


def test_census_of_nothing(spark):
    assert census(spark) == {}


def test_recent_takes_both_ends_and_no_nulls(spark):
    df = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 3),), (date(2024, 1, 4),), (None,)], "d date")
    assert [r.d.day for r in views.recent(df, "d", "2024-01-03", 2).orderBy("d").collect()] == [1, 3]
    assert views.recent(df, "d", "2024-01-02", 0).count() == 0


@pytest.mark.parametrize("parts", [1, 7])
def test_mean_rounds_ties_up_in_any_order(spark, parts):
    df = spark.createDataFrame([(3.84,), (3.85,), (None,)], "x double").repartition(parts)
    assert df.agg(views.mean("x", 2).alias("m")).first()["m"] == 3.85


def test_indicator_without_target_is_never_met(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), "A", 1.0), (date(2024, 1, 1), "B", 1.0)], "metric_date date, indicator_code string, v double")
    got = {r["indicator_code"]: (r["numerator"], r["meets_target"]) for r in marts.indicator_table(df, ["indicator_code"], F.col("v") > 5, {"A": 0.1}).collect()}
    assert got == {"A": (0, True), "B": (0, False)}


def test_hourly_pattern_keeps_hours_without_rows_today(spark):
    ed = spark.createDataFrame([(date(2024, 1, 1), 5, 4), (date(2024, 1, 2), 6, 3)], "metric_date date, metric_hour int, arrivals long")
    assert [tuple(r) for r in views.ed_hourly_pattern(ed, "2024-01-02").collect()] == [(5, 0, 4.0, -4.0), (6, 3, 3.0, 0.0)]
    assert views.ed_hourly_pattern(ed.limit(0), "2024-01-02").count() == 0


def test_readmission_rates_need_enough_discharges(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), "x", 9, 3), (date(2024, 1, 1), "y", 10, 3), (date(2024, 1, 1), None, 20, 0)], "discharge_date date, k string, index_discharges long, readmissions_30_day long")
    got = {r["k"]: r["readmission_rate_pct"] for r in views.readmissions_by(df, "2024-01-01", 1, ("k",), least=10).collect()}
    assert got == {"y": 30.0, None: 0.0}
