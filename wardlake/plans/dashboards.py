"""Queries of the metric tables, views and panels, added to the catalogue, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.operators import marts, summaries, views
from wardlake.plans.catalogue import AS_OF, ENC, ORACLE_SQL, QUERIES, query, std_encounters
from wardlake.plans.fixtures import cte, raw

__all__ = ["ORACLE_SQL", "QUERIES"]

#: Emergency rows and indicators lie in January 2024, stays before August 2001.
FIRST, ED_DAY, ED_FIRST = "2001-05-03", "2024-01-30", "2024-01-10"
PAYERS = ("medicare", "medicaid", "commercial", "self_pay")
EXPECTED, OTHER = {"I50": 0.22, "J44": 0.2, "J18": 0.17}, 0.12
PREVENTABLE = ["I50", "J44"]
TARGETS = {"CAUTI": 0.2, "CLABSI": 0.15, "FALLS": 0.25, "PRESSURE_INJ": 0.1, "READM-30": 0.3}
PLACE = ["facility", "department", "unit", "operational_beds", "licensed_beds"]


def stays(spark, sf_dir) -> DataFrame:
    e = std_encounters(spark, sf_dir).withColumn("location_key", F.col("encounter_id") % 25)
    e = e.withColumn("payer_type", F.element_at(F.array(*map(F.lit, PAYERS)), (F.col("patient_id") % 4 + 1).cast("int")))
    return marts.located(e, raw(spark, sf_dir, "locations")).withColumn("facility", F.col("facility_name"))


def census(spark, sf_dir) -> DataFrame:
    return marts.census_table(stays(spark, sf_dir).withColumn("department", F.col("service_line")), PLACE, FIRST, AS_OF)


def ed(spark, sf_dir) -> DataFrame:
    return marts.ed_table(raw(spark, sf_dir, "arrivals"), ["facility", "ed_location"])


def readmissions(spark, sf_dir) -> DataFrame:
    return marts.readmission_table(stays(spark, sf_dir), ["facility", "payer_type"], F.substring("primary_diagnosis_code", 1, 3), PREVENTABLE, EXPECTED, OTHER)


def los(spark, sf_dir) -> DataFrame:
    return marts.los_table(stays(spark, sf_dir), ["facility", "service_line", "drg_code"])


def indicators(spark, sf_dir) -> DataFrame:
    return marts.indicator_table(raw(spark, sf_dir, "observed"), ["facility", "indicator_code", "indicator_name", "indicator_category"], F.col("amount") > 60, TARGETS)


# ---- the same tables in SQL


def _n(column: str, name: str | None = None) -> str:
    return f"cast(sum({column}) as bigint) as {name or column}"


_LOCATED = ENC.rstrip() + ", " + cte("locations").removeprefix("with ").rstrip()
_LOCATED += f""", st as (select enc.*, l.*, facility_name as facility, {list(PAYERS)}[patient_id % 4 + 1] as payer_type from enc join locations l on l.location_key = encounter_id % 25)
"""
_DAYS = f"generate_series(date '{FIRST}', date '{AS_OF}', interval 1 day)"
_CENSUS = _LOCATED + f""", spine as (select cast(unnest({_DAYS}) as date) as d),
cs as (select d as census_date, facility, service_line as department, unit, operational_beds, licensed_beds,
  count(*) filter (where admission_date::date <= d and (discharge_date is null or discharge_date::date > d)) as midnight_census,
  count(*) filter (where admission_date::date = d) as admissions, count(*) filter (where discharge_date::date = d) as discharges from spine, st group by all),
census as (select *, round(midnight_census * 100.0 / nullif(operational_beds, 0), 2) as occupancy_rate from cs where midnight_census + admissions + discharges > 0)
"""
_ED = cte("arrivals").rstrip() + """, ed as (select arrived::date as metric_date, cast(hour(arrived) as int) as metric_hour, facility, ed_location, count(*) as arrivals,
  count(*) filter (where disposition <> 'lwbs') as patients_in_ed, count(*) filter (where wait_minutes >= 30) as patients_waiting, """
_ED += ", ".join(f"count(*) filter (where disposition = '{v}') as {k}" for k, v in {"admitted": "admitted", "discharged": "discharged", "transferred": "transferred", "left_without_seen": "lwbs", "left_ama": "ama"}.items())
_ED += """, avg(wait_minutes) as avg_door_to_provider, avg(stay_minutes) as avg_length_of_stay, quantile_cont(stay_minutes, 0.5) as median_los, quantile_cont(stay_minutes, 0.9) as p90_los, """
_ED += ", ".join(f"count(*) filter (where esi = {i}) as esi_{i}_count" for i in range(1, 6)) + " from arrivals group by 1, 2, 3, 4)\n"
_READM = _LOCATED + f""", nx as (select st.*, (select min(x.admission_date) from enc x where x.is_inpatient and x.patient_id = st.patient_id and x.admission_date > st.discharge_date) as again, substr(primary_diagnosis_code, 1, 3) as diagnosis_category
  from st where is_inpatient and is_completed),
rg as (select discharge_date::date as discharge_date, diagnosis_category, facility, payer_type, count(*) as index_discharges, count(*) filter (where epoch(again - discharge_date) <= 2592000) as readmissions_30_day,
  count(*) filter (where epoch(again - discharge_date) <= 2592000 and diagnosis_category in ('I50', 'J44')) as preventable_30_day from nx group by all),
rm as (select *, readmissions_30_day / index_discharges as readmission_rate_30_day, cast(case diagnosis_category when 'I50' then 0.22 when 'J44' then 0.2 when 'J18' then 0.17 else {OTHER} end as double) as expected_rate from rg)
"""
_LOS = _LOCATED + """, lg as (select discharge_date::date as metric_date, facility, service_line, drg_code, count(*) as discharge_count, avg(los_days) as avg_los, quantile_cont(los_days, 0.5) as median_los, quantile_cont(los_days, 0.25) as p25_los,
  quantile_cont(los_days, 0.75) as p75_los, quantile_cont(los_days, 0.9) as p90_los, min(los_days) as min_los, max(los_days) as max_los, stddev_samp(los_days) as std_dev_los,
  """ + ", ".join(f"count(*) filter (where los_days >= {n}) as long_stay_{n}_plus" for n in (7, 14, 30)) + """ from st where is_completed group by 1, 2, 3, 4),
los as (select *, cast(4.5 as double) as expected_los, avg_los / 4.5 as los_index from lg)
"""
_IND = cte("observed").rstrip() + """, ig as (select metric_date, facility, indicator_code, indicator_name, indicator_category, count(*) filter (where amount > 60) as numerator, count(*) as denominator from observed group by all),
it as (select *, numerator / denominator as rate, cast(case indicator_code """ + " ".join(f"when '{k}' then {v}" for k, v in TARGETS.items()) + """ end as double) as target_rate from ig),
ind as (select *, coalesce(rate <= target_rate, false) as meets_target from it)
"""


def _last(column: str, day: str, days: int) -> str:
    return f"{column} between date '{day}' - {days} and date '{day}'"


def _pct(part: str, whole: str, digits: int, name: str) -> str:
    return f"round(sum({part}) / nullif(sum({whole}), 0) * 100, {digits}) as {name}"


# ---- metric tables


@query(_CENSUS + "select * from census")
def metric_census(spark, sf_dir):
    return census(spark, sf_dir)


@query(_ED + "select * from ed")
def ed_hourly(spark, sf_dir):
    return ed(spark, sf_dir)


@query(_READM + "select * from rm")
def metric_readmission(spark, sf_dir):
    return readmissions(spark, sf_dir)


@query(_LOS + "select * from los")
def metric_length_of_stay(spark, sf_dir):
    return los(spark, sf_dir)


@query(_IND + "select * from ind")
def metric_quality_indicator(spark, sf_dir):
    return indicators(spark, sf_dir)


# ---- views


@query(_CENSUS + f"select facility as facility_name, unit, l.location_type, midnight_census as current_census, l.operational_beds, round(midnight_census / nullif(l.operational_beds, 0) * 100, 1) as occupancy_pct, admissions as today_admissions, discharges as today_discharges, admissions - discharges as net_change from census join locations l using (unit) where l.facility_name = facility and census_date = date '{AS_OF}'")
def v_census_current(spark, sf_dir):
    return views.census_current(census(spark, sf_dir), raw(spark, sf_dir, "locations"), AS_OF)


@query(_CENSUS + f"select census_date, facility, {_n('midnight_census', 'total_census')}, {_n('operational_beds', 'total_beds')}, {_n('admissions', 'total_admissions')}, {_n('discharges', 'total_discharges')}, {_pct('midnight_census', 'operational_beds', 1, 'occupancy_pct')} from census where {_last('census_date', AS_OF, 30)} group by 1, 2")
def v_census_trend(spark, sf_dir):
    return views.census_trend(census(spark, sf_dir), AS_OF)


@query(_CENSUS + f"select cast(dayofweek(census_date) as int) as day_of_week, dayname(census_date) as day_name, round(avg(midnight_census) + 1e-9, 0) as avg_census, max(midnight_census) as max_census, min(midnight_census) as min_census, round(avg(occupancy_rate) + 1e-9, 1) as avg_occupancy_pct from census where {_last('census_date', AS_OF, 90)} group by 1, 2")
def v_census_by_day_of_week(spark, sf_dir):
    return views.census_by_weekday(census(spark, sf_dir), AS_OF)


@query(_LOCATED + f"select unit, location_type, service_line, operational_beds, count(distinct encounter_id) as active_encounters, round(count(distinct encounter_id) / nullif(operational_beds, 0) * 100, 1) as occupancy_pct from st where admission_date <= timestamp '{AS_OF} 00:00:00' and (discharge_date is null or discharge_date > timestamp '{AS_OF} 00:00:00') group by 1, 2, 3, 4")
def v_inpatient_by_unit(spark, sf_dir):
    return views.inpatients_by_unit(stays(spark, sf_dir), AS_OF)


@query(_CENSUS + f"select facility, department, {_n('midnight_census', 'total_patients')}, {_n('licensed_beds', 'total_licensed_beds')}, {_n('operational_beds', 'total_operational_beds')}, {_n('admissions', 'todays_admissions')}, {_n('discharges', 'todays_discharges')}, round(avg(occupancy_rate) + 1e-9, 1) as avg_occupancy_pct from census where census_date = date '{AS_OF}' group by 1, 2")
def v_current_census(spark, sf_dir):
    return views.census_departments(census(spark, sf_dir), AS_OF)


_now = f"where metric_date = date '{ED_DAY}'"
_waits = "round(avg(avg_door_to_provider) + 1e-9, 0) as avg_wait_minutes, round(avg(avg_length_of_stay) / 60 + 1e-9, 1) as avg_los_hours"


@query(_ED + f"select facility, ed_location, {_n('arrivals', 'todays_arrivals')}, max(patients_in_ed) as current_patients, max(patients_waiting) as waiting_for_bed, {_waits}, {_n('admitted', 'admitted_today')}, {_n('discharged', 'discharged_today')}, {_n('left_without_seen', 'lwbs_today')} from ed {_now} group by 1, 2")
def v_ed_current_status(spark, sf_dir):
    return views.ed_status(ed(spark, sf_dir), ED_DAY)


@query(_ED + f"select facility, {_n('arrivals', 'total_arrivals')}, max(patients_in_ed) as current_census, {_waits}, {_n('left_without_seen', 'lwbs_count')} from ed {_now} group by 1")
def v_ed_performance_today(spark, sf_dir):
    return views.ed_performance(ed(spark, sf_dir), ED_DAY)


@query(_ED + f", u as (select metric_hour as hour, round(avg(arrivals) + 1e-9, 1) as avg_arrivals from ed where {_last('metric_date', ED_DAY, 30)} group by 1) select hour, coalesce(arrivals, 0) as today_arrivals, avg_arrivals, coalesce(arrivals, 0) - avg_arrivals as variance from u left join (select * from ed {_now}) t on t.metric_hour = hour")
def v_ed_hourly_pattern(spark, sf_dir):
    return views.ed_hourly_pattern(ed(spark, sf_dir), ED_DAY)


@query(_ED + f"select metric_date, facility, round(avg(avg_length_of_stay) / 60 + 1e-9, 1) as avg_los_hours, round(avg(median_los) / 60 + 1e-9, 1) as median_los_hours, round(avg(p90_los) / 60 + 1e-9, 1) as p90_los_hours, {_n('arrivals', 'total_arrivals')} from ed where {_last('metric_date', ED_DAY, 30)} group by 1, 2")
def v_ed_los_trend(spark, sf_dir):
    return views.ed_los_trend(ed(spark, sf_dir), ED_DAY)


@query(_ED + f"select metric_date, {_n('admitted')}, {_n('discharged')}, {_n('transferred')}, {_n('left_without_seen', 'lwbs')}, {_n('left_ama', 'ama')}, {_n('arrivals', 'total_arrivals')}, {_pct('admitted', 'arrivals', 1, 'admission_rate_pct')} from ed where {_last('metric_date', ED_DAY, 30)} group by 1")
def v_ed_disposition(spark, sf_dir):
    return views.ed_dispositions(ed(spark, sf_dir), ED_DAY)


@query(_ED + f"select metric_hour as hour, round(avg(avg_door_to_provider) + 1e-9, 0) as avg_wait_minutes, round(min(avg_door_to_provider), 0) as min_wait, round(max(avg_door_to_provider), 0) as max_wait from ed where {_last('metric_date', ED_DAY, 7)} group by 1")
def v_ed_wait_times(spark, sf_dir):
    return views.ed_waits(ed(spark, sf_dir), ED_DAY)


@query(_LOS + f"select metric_date, service_line, {_n('discharge_count', 'discharges')}, round(avg(avg_los) + 1e-9, 1) as avg_los_days, round(avg(median_los) + 1e-9, 1) as median_los_days, round(avg(expected_los) + 1e-9, 1) as expected_los_days, round(avg(los_index) + 1e-9, 2) as los_index from los where {_last('metric_date', AS_OF, 90)} group by 1, 2")
def v_los_trend(spark, sf_dir):
    return views.los_trend(los(spark, sf_dir), AS_OF)


@query(_LOS + f"select drg_code, {_n('discharge_count', 'total_discharges')}, round(avg(avg_los) + 1e-9, 1) as avg_los_days, round(avg(expected_los) + 1e-9, 1) as expected_los_days, round(avg(los_index) + 1e-9, 2) as los_index, case when avg(los_index) > 1.1 then 'Above Expected' when avg(los_index) < 0.9 then 'Below Expected' else 'At Expected' end as performance from los where {_last('metric_date', AS_OF, 365)} group by 1 order by 2 desc, 1 limit 20")
def v_los_by_drg(spark, sf_dir):
    return views.los_by_drg(los(spark, sf_dir), AS_OF)


@query(_LOS + f"select metric_date, facility, {_n('discharge_count', 'total_discharges')}, {', '.join(_n(f'long_stay_{k}_plus', f'stays_{k}_plus_days') for k in (7, 14, 30))}, {_pct('long_stay_7_plus', 'discharge_count', 1, 'pct_7_plus_days')} from los where {_last('metric_date', AS_OF, 90)} group by 1, 2")
def v_long_stay_trend(spark, sf_dir):
    return views.long_stays(los(spark, sf_dir), AS_OF)


@query(_LOS + f"select service_line, round(avg(avg_los) + 1e-9, 1) as mean_los, {', '.join(f'round(avg({c}) + 1e-9, 1) as {c}' for c in ('median_los', 'p25_los', 'p75_los', 'p90_los'))}, round(avg(std_dev_los) + 1e-9, 2) as std_dev from los where {_last('metric_date', AS_OF, 30)} group by 1")
def v_los_distribution(spark, sf_dir):
    return views.los_distribution(los(spark, sf_dir), AS_OF)


_readm = f"{_n('index_discharges', 'total_discharges')}, {_n('readmissions_30_day', 'total_readmissions')}, {_pct('readmissions_30_day', 'index_discharges', 2, 'readmission_rate_pct')}"


@query(_READM + f"select discharge_date, facility, {_readm} from rm where {_last('discharge_date', AS_OF, 90)} group by 1, 2")
def v_readmission_trend(spark, sf_dir):
    return views.readmissions_by(readmissions(spark, sf_dir), AS_OF, 90, ("discharge_date", "facility"))


@query(_READM + f"select diagnosis_category, {_readm}, round(avg(expected_rate) * 100 + 1e-9, 2) as expected_rate_pct from rm where {_last('discharge_date', AS_OF, 365)} group by 1 having sum(index_discharges) >= 10")
def v_readmission_by_diagnosis(spark, sf_dir):
    return views.readmissions_by_diagnosis(readmissions(spark, sf_dir), AS_OF)


@query(_READM + f"select payer_type, {_readm} from rm where {_last('discharge_date', AS_OF, 365)} group by 1")
def v_readmission_by_payer(spark, sf_dir):
    return views.readmissions_by(readmissions(spark, sf_dir), AS_OF, 365, ("payer_type",))


@query(_READM + f"select discharge_date, facility, {_n('readmissions_30_day', 'all_readmissions')}, {_n('preventable_30_day', 'preventable_readmissions')}, {_pct('preventable_30_day', 'readmissions_30_day', 1, 'preventable_pct')} from rm where {_last('discharge_date', AS_OF, 90)} group by 1, 2")
def v_preventable_readmissions(spark, sf_dir):
    return views.preventable_readmissions(readmissions(spark, sf_dir), AS_OF)


@query(_READM + f"select facility, diagnosis_category, {_n('index_discharges', 'total_discharges')}, {_n('readmissions_30_day', 'total_readmissions')}, round(avg(readmission_rate_30_day) * 100 + 1e-9, 1) as avg_readmission_rate_pct from rm where {_last('discharge_date', AS_OF, 90)} group by 1, 2")
def v_readmission_summary(spark, sf_dir):
    return views.readmission_summary(readmissions(spark, sf_dir), AS_OF)


@query(_IND + f"select indicator_category, indicator_code, indicator_name, {_n('numerator', 'total_events')}, {_n('denominator', 'total_population')}, round(avg(rate) * 1000 + 1e-9, 2) as rate_per_1000, round(avg(target_rate) * 1000 + 1e-9, 2) as target_per_1000, count(*) filter (where meets_target) as periods_meeting_target from ind where {_last('metric_date', ED_DAY, 30)} group by 1, 2, 3")
def v_quality_dashboard(spark, sf_dir):
    return views.indicator_summary(indicators(spark, sf_dir), ED_DAY)


# ---- panels


@query(_CENSUS + f"select round(avg(occupancy_rate) filter (where census_date >= date '{AS_OF}' - 1) + 1e-9, 1) as occupancy, cast(sum(midnight_census) filter (where census_date >= date '{AS_OF}' - 1) as bigint) as census, round(sum(admissions) / nullif(sum(operational_beds), 0) * 30, 2) as bed_turns from census where {_last('census_date', AS_OF, 30)}")
def panel_census_numbers(spark, sf_dir):
    return views.census_numbers(census(spark, sf_dir), AS_OF)


@query(_CENSUS + f"select census_date as time, round(avg(occupancy_rate) + 1e-9, 1) as occupancy, cast(85 as int) as target, {_n('midnight_census', 'total_census')}, {_n('admissions')}, {_n('discharges')} from census where census_date between date '2001-06-01' and date '{AS_OF}' group by 1")
def panel_census_lines(spark, sf_dir):
    return views.census_lines(census(spark, sf_dir), "2001-06-01", AS_OF)


@query(_CENSUS + f"select census_date, unit, midnight_census as patients, operational_beds as beds, round(midnight_census / nullif(operational_beds, 0) * 100, 1) as occupancy_pct, admissions, discharges from census where {_last('census_date', AS_OF, 1)}")
def panel_unit_occupancy(spark, sf_dir):
    return views.unit_occupancy(census(spark, sf_dir), AS_OF)


@query(_CENSUS + "select distinct facility from census")
def panel_facilities(spark, sf_dir):
    return views.facilities(census(spark, sf_dir))


_d1 = f"filter (where metric_date >= date '{ED_DAY}' - 1)"


@query(_ED + f"select cast(sum(arrivals) {_d1} as bigint) as ed_volume, round(avg(avg_door_to_provider) {_d1} + 1e-9, 0) as avg_wait, round(sum(left_without_seen) {_d1} / nullif(sum(arrivals) {_d1}, 0) * 100, 1) as lwbs_rate, round(sum(admitted) {_d1} / nullif(sum(arrivals) {_d1}, 0) * 100, 1) as admission_rate, round(avg(avg_length_of_stay) + 1e-9, 0) as avg_ed_los from ed where {_last('metric_date', ED_DAY, 7)}")
def panel_ed_numbers(spark, sf_dir):
    return views.ed_numbers(ed(spark, sf_dir), ED_DAY)


_window = f"metric_date between date '{ED_FIRST}' and date '{ED_DAY}'"


@query(_ED + f"select metric_date as time, {_n('arrivals', 'ed_volume')}, {_n('admitted', 'admissions')}, round(avg(avg_door_to_provider) + 1e-9, 0) as door_to_provider, round(avg(avg_length_of_stay) + 1e-9, 0) as ed_los from ed where {_window} group by 1")
def panel_ed_lines(spark, sf_dir):
    return views.ed_lines(ed(spark, sf_dir), ED_FIRST, ED_DAY)


@query(_ED + f"select metric_hour as hour, {_n('arrivals')} from ed where {_window} group by 1")
def panel_ed_hours(spark, sf_dir):
    return views.ed_hours(ed(spark, sf_dir), ED_FIRST, ED_DAY)


def _by(column: str, at: str) -> str:
    return _LOCATED + f"select {column}, count(*) as stays, round(avg(los_days) + 1e-9, 2) as avg_los from st where {at}::date between date '2000-08-01' and date '{AS_OF}' and {column} is not null group by 1"


@query(_by("encounter_type", "discharge_date") + " order by 3 desc nulls first, 1 limit 15")
def panel_los_by_type(spark, sf_dir):
    return views.stays_by(stays(spark, sf_dir), "encounter_type", "discharge_date", "2000-08-01", AS_OF, 15)


@query(_by("service_line", "discharge_date"))
def panel_los_by_service_line(spark, sf_dir):
    return views.stays_by(stays(spark, sf_dir), "service_line", "discharge_date", "2000-08-01", AS_OF)


@query(_by("department", "admission_date"))
def panel_stays_by_department(spark, sf_dir):
    return views.stays_by(stays(spark, sf_dir), "department", "admission_date", "2000-08-01", AS_OF)


@query(_by("discharge_disposition", "discharge_date"))
def panel_dispositions(spark, sf_dir):
    return views.stays_by(stays(spark, sf_dir), "discharge_disposition", "discharge_date", "2000-08-01", AS_OF)


@query(_LOCATED + f"select admission_date::date as time, round(avg(los_days) + 1e-9, 2) as avg_los from st where admission_date::date between date '2001-06-01' and date '{AS_OF}' group by 1")
def panel_los_lines(spark, sf_dir):
    return views.los_lines(stays(spark, sf_dir), "2001-06-01", AS_OF)


@query(ENC + f", g as (select *, floor(epoch(admission_date - lag(discharge_date) over (partition by patient_id order by admission_date nulls first, encounter_id)) / 86400.0) as d from enc) select round(avg(los_days) + 1e-9, 1) as los, round(count(*) filter (where d > 0 and d <= 30) / nullif(count(*), 0) * 100, 1) as readmission_rate from g where {_last('discharge_date::date', AS_OF, 30)}")
def panel_stay_numbers(spark, sf_dir):
    return views.stay_numbers(summaries.readmission_flags(std_encounters(spark, sf_dir)), AS_OF)


@query(_IND + f"select indicator_code, round(arg_max(rate, strftime(metric_date, '%Y%m%d') || facility) * 100, 2) as rate_pct from ind where {_last('metric_date', ED_DAY, 31)} group by 1")
def panel_latest_rates(spark, sf_dir):
    return views.latest_rates(indicators(spark, sf_dir), ED_DAY)


_ok = "round(count(*) filter (where meets_target) / nullif(count(*), 0) * 100, 1) as compliance_pct"


@query(_IND + f"select {_ok} from ind")
def panel_compliance(spark, sf_dir):
    return views.compliance(indicators(spark, sf_dir))


@query(_IND + f"select metric_date, {_ok} from ind group by 1")
def panel_compliance_lines(spark, sf_dir):
    return views.compliance(indicators(spark, sf_dir), ("metric_date",))


@query(_IND + f"select round(count(*) filter (where not meets_target) / nullif(count(*), 0) * 100, 1) as missed_pct from ind where starts_with(indicator_code, 'READM') and {_last('metric_date', ED_DAY, 30)}")
def panel_missed_targets(spark, sf_dir):
    return views.missed_targets(indicators(spark, sf_dir), ED_DAY, "READM")


@query(_IND + f"select metric_date as time, indicator_code as metric, facility, round(rate * 100, 2) as value, round(target_rate * 100, 2) as target from ind where {_window}")
def panel_indicator_lines(spark, sf_dir):
    return views.indicator_lines(indicators(spark, sf_dir), ED_FIRST, ED_DAY)


@query(_IND + "select indicator_category, count(*) as indicators from ind group by 1")
def panel_indicators_by_category(spark, sf_dir):
    return indicators(spark, sf_dir).groupBy("indicator_category").agg(F.count("*").alias("indicators"))
