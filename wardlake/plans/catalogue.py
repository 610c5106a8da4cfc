"""Queries over the driver's tables, each beside the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.functions import dates
from wardlake.functions import tables as T
from wardlake.operators import loads, metrics, phi, rules, standardise, summaries
from wardlake.plans import oracle as o
from wardlake.plans.fixtures import cte, raw
from wardlake.sources import fhir, hl7
from wardlake.sources.relational import read_parquet

AS_OF = "2001-08-01"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def std_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardise.split(standardise.encounters(raw(spark, sf_dir, "encounters")))[0]


def std(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return standardise.split(getattr(standardise, name)(raw(spark, sf_dir, name, wide=True)))[0]


# ---- standard forms

_enc_type = o.mapped("k", T.ENCOUNTER_TYPE, "k")
ENC = cte("encounters") + f""", e0 as (select *, lower({o.blank('encounter_type')}) as k,
  case when discharge_date < admission_date then discharge_date else admission_date end as a, case when discharge_date < admission_date then admission_date else discharge_date end as b from encounters),
enc as (select encounter_id, patient_id, {_enc_type} as encounter_type, a as admission_date, b as discharge_date, department, discharge_disposition, primary_diagnosis_code, drg_code, total_charges,
  round(epoch(b - a) / 3600.0, 2) as los_hours, round(epoch(b - a) / 3600.0 / 24, 2) as los_days, {_enc_type} = 'inpatient' as is_inpatient, {_enc_type} = 'emergency' as is_emergency, b is not null as is_completed,
  case when {_enc_type} = 'emergency' then cast(hour(a) as int) end as arrival_hour, case when {_enc_type} = 'emergency' then dayname(a) end as arrival_day from e0)
"""


@query(ENC + "select * from enc")
def encounters_std(spark, sf_dir):
    return std_encounters(spark, sf_dir)


_age = "(year(date '2001-08-01') - year(date_of_birth) - cast(strftime(date '2001-08-01', '%m%d') < strftime(date_of_birth, '%m%d') as int))"
_digits = "regexp_replace(phone, '[^0-9]', '', 'g')"
_ten = f"case when length({_digits}) = 11 and starts_with({_digits}, '1') then substr({_digits}, 2) else {_digits} end"
_title = "case when upper(trim({c})) = trim({c}) or lower(trim({c})) = trim({c}) then list_aggregate(list_transform(regexp_extract_all(lower(trim({c})), '([a-z]+|[^a-z]+)'), lambda x: concat(upper(x[1]), x[2:])), 'string_agg', '') else trim({c}) end"


@query(
    cte("patients")
    + f"""select patient_id, mrn, {_title.format(c='first_name')} as first_name, {_title.format(c='last_name')} as last_name, {o.mapped(f"lower({o.blank('gender')})", T.GENDER, "'unknown'")} as gender, date_of_birth,
  case when regexp_matches(postal_code, '^\\d{{1,4}}$') then lpad(postal_code, 5, '0') else postal_code end as postal_code,
  case when length(trim(state)) = 2 then upper(trim(state)) else {o.mapped('upper(trim(state))', T.STATES, 'substr(upper(trim(state)), 1, 2)')} end as state,
  case when length({_ten}) = 10 then concat('(', substr({_ten}, 1, 3), ') ', substr({_ten}, 4, 3), '-', substr({_ten}, 7, 4)) else phone end as phone,
  case when contains(email, '@') then lower(trim(email)) end as email, {o.mapped(f"upper({o.blank('marital_status')})", T.MARITAL, 'lower(trim(marital_status))')} as marital_status,
  sha256(concat('wardlake', ssn)) as ssn_hash, cast({_age} as int) as age, {o.bands(_age, *dates.LIFE_STAGES)} as age_group from patients"""
)
def patients_std(spark, sf_dir):
    return standardise.split(standardise.patients(raw(spark, sf_dir, "patients"), AS_OF))[0]


_dx = "upper(replace(trim(code), '.', ''))"
DX = cte("diagnoses") + f""", d0 as (select encounter_id, patient_id, rank, {_dx} as c, diagnosis_type as t, present_on_admission as p from diagnoses), d1 as (select *, {o.matches('c', T.DIAGNOSIS_CODES, 'UNKNOWN')} as s from d0)
"""


@query(
    DX
    + f"""select encounter_id, patient_id, rank, c as code, s as code_system, {o.mapped('lower(t)', T.DIAGNOSIS_TYPE, 'lower(t)')} as diagnosis_type, {o.mapped('upper(p)', T.PRESENT_ON_ADMISSION, 'upper(p)')} as present_on_admission,
  case when s = 'ICD-10-CM' then {o.mapped('substr(c, 1, 1)', T.CHAPTERS)} end as chapter, case when s = 'ICD-10-CM' then substr(c, 1, 3) end as category, case when s = 'ICD-10-CM' and length(c) >= 4 then substr(c, 1, 4) end as subcategory,
  substr(c, 1, 3) in ('E10', 'E11', 'E13') as is_diabetes, substr(c, 1, 3) in ('I10', 'I11', 'I12', 'I13') as is_hypertension, substr(c, 1, 3) = 'I50' as is_chf, substr(c, 1, 3) = 'J44' as is_copd, substr(c, 1, 3) = 'N18' as is_ckd,
  c like 'C%' as is_cancer, case when length(c) > 3 then concat(substr(c, 1, 3), '.', substr(c, 4)) else c end as display_code from d1"""
)
def diagnoses_std(spark, sf_dir):
    return std(spark, sf_dir, "diagnoses")


_cpt = "case " + " ".join(f"when n between {a} and {b} then {o.text(t)}" for a, b, t in T.CPT_CATEGORIES) + " end"
PX = cte("procedures") + f""", p0 as (select *, {o.matches('code', T.PROCEDURE_CODES, 'UNKNOWN')} as s from procedures), p1 as (select *, case when s = 'CPT-4' then cast(code as int) end as n from p0),
px as (select encounter_id, patient_id, code, s as code_system, {_cpt} as category, coalesce(n between 10000 and 69999, false) as is_surgical, s = 'CPT-4' and code like '99%' as is_em, duration_minutes, performed_date,
  dayname(performed_date) as procedure_day, cast(hour(performed_date) as int) as procedure_hour, charges from p1)
"""


@query(PX + "select * from px")
def procedures_std(spark, sf_dir):
    return std(spark, sf_dir, "procedures")


_lab = [(k, i) for i, k in enumerate(("low", "high", "critical_low", "critical_high"))]
_usual = ", ".join(o.hits("upper(test_name)", [(t, "cast(null as double)" if r[i] is None else f"cast({float(r[i])} as double)") for t, r in T.LAB_RANGES.items()]) + f" as {k}" for k, i in _lab)
_known = o.hits("upper(test_name)", [(t, "true") for t in T.LAB_RANGES], "false")
_category = o.hits("upper(test_name)", [(w, o.text(c)) for c, ws in T.LAB_CATEGORIES.items() for w in ws], "'other'")


@query(
    cte("labs")
    + f""", l0 as (select *, try_cast(regexp_replace(regexp_replace(trim(value), '^[<>]+', ''), '%$', '') as double) as v, {_usual}, {_known} as known from labs)
select source_id, patient_id, test_name, v as value, case when v is null then value end as value_string, case when v is not null then low end as reference_low, case when v is not null then high end as reference_high,
  {o.mapped('upper(interpretation)', T.INTERPRETATION, 'lower(interpretation)')} as interpretation, case when v is null then null when v < low or v > high then true when low is not null or high is not null then false end as is_abnormal,
  case when v is null or not known then null when v < critical_low or v > critical_high then true else false end as is_critical, case when v is null then null when v < low then round(v - low, 2) when v > high then round(v - high, 2) else 0 end as delta,
  {_category} as category, effective_date from l0"""
)
def labs_std(spark, sf_dir):
    return std(spark, sf_dir, "labs")


def _status(name: str, c: str) -> str:
    low, high, cl, ch = T.VITAL_RANGES[name]
    return f"case when {c} is null then null when {c} < {cl} then 'critical_low' when {c} > {ch} then 'critical_high' when {c} < {low} then 'low' when {c} > {high} then 'high' else 'normal' end as {name}_status"


_vital_names = ("heart_rate", "respiratory_rate", "systolic_bp", "diastolic_bp", "oxygen_saturation", "temperature")
_news = " + ".join(o.steps({"temperature": "t"}.get(k, k), table) for k, table in T.NEWS.items()) + " + case when oxygen_device is not null then 2 else 0 end"
VX = cte("vitals") + f""", v0 as (select *, case when temperature < 50 then round(temperature * 9 / 5 + 32, 1) else temperature end as t from vitals), v1 as (select *, {_news} as news from v0),
vx as (select source_id, patient_id, recorded_date, heart_rate, respiratory_rate, systolic_bp, diastolic_bp, t as temperature, oxygen_saturation, round((systolic_bp + 2 * diastolic_bp) / 3, 1) as mean_arterial_pressure,
  round(weight / ((height / 100) * (height / 100)), 1) as bmi, {', '.join(_status(k, 't' if k == 'temperature' else k) for k in _vital_names)}, cast(news as int) as news_score, case when news <= 4 then 'low' when news <= 6 then 'medium' else 'high' end as news_risk,
  case when systolic_bp < 120 and diastolic_bp < 80 then 'normal' when systolic_bp < 130 and diastolic_bp < 80 then 'elevated' when systolic_bp < 140 or diastolic_bp < 90 then 'stage_1' when systolic_bp < 180 and diastolic_bp < 120 then 'stage_2' else 'crisis' end as bp_class from v1)
"""


@query(VX + "select * from vx")
def vitals_std(spark, sf_dir):
    return std(spark, sf_dir, "vitals")


@query(VX + "select news_score, news_risk, bp_class, count(*) as readings from vx group by all")
def news_and_bp_counts(spark, sf_dir):
    return std(spark, sf_dir, "vitals").groupBy("news_score", "news_risk", "bp_class").agg(F.count("*").alias("readings"))


@query(VX + "select source_id, patient_id, heart_rate, heart_rate - lag(heart_rate) over (partition by patient_id order by recorded_date, source_id) as change from vx")
def vital_trend(spark, sf_dir):
    return summaries.vital_trend(std(spark, sf_dir, "vitals"), "heart_rate")


@query(cte("vitals") + "select patient_id, recorded_date, max(heart_rate) as heart_rate, max(systolic_bp) as systolic_bp from vitals group by all")
def vitals_pivot(spark, sf_dir):
    long = raw(spark, sf_dir, "vitals").unpivot(["patient_id", "recorded_date"], ["heart_rate", "systolic_bp"], "name", "value")
    return summaries.vitals_wide(long, ["heart_rate", "systolic_bp"])


_flat = lambda t: [(w, o.text(c)) for c, ws in t.items() for w in ws]
_any = lambda ws: "(" + " or ".join(f"contains(m, {o.text(w)})" for w in ws) + ")"
_doses = o.hits("f", [(k, f"cast({float(v)} as double)") for k, v in sorted(T.DOSES_A_DAY.items(), key=lambda x: -len(x[0]))])


@query(
    cte("medications")
    + f""", m0 as (select *, lower(medication_name) as m, lower(frequency) as f from medications)
select encounter_id, line, medication_name, {o.mapped('lower(route)', T.ROUTE, 'lower(route)')} as route, cast(nullif(regexp_extract(m, '(\\d+\\.?\\d*)\\s*(mg|g|mcg|ml|unit|units|meq)', 1), '') as double) as dose_value,
  nullif(regexp_extract(m, '(\\d+\\.?\\d*)\\s*(mg|g|mcg|ml|unit|units|meq)', 2), '') as dose_unit, contains(f, 'prn') or contains(f, 'as needed') as is_prn, {o.hits('m', _flat(T.DRUG_CLASSES))} as drug_class,
  {o.hits('m', _flat(T.HIGH_ALERT))} is not null as is_high_alert, {o.hits('m', _flat(T.HIGH_ALERT))} as high_alert_category, {_any(T.OPIOIDS)} as is_opioid, {_any(T.CONTROLLED)} as is_controlled, {_any(T.ANTICOAGULANTS)} as is_anticoagulant,
  {_doses} as doses_per_day, cast(end_date - start_date as int) as therapy_days from m0"""
)
def medications_std(spark, sf_dir):
    return std(spark, sf_dir, "medications")


# ---- summaries


@query(ENC + ", g as (select encounter_id, patient_id, floor(epoch(admission_date - lag(discharge_date) over (partition by patient_id order by admission_date nulls first, encounter_id)) / 86400.0) as d from enc) select encounter_id, patient_id, cast(d as bigint) as days_since_discharge, coalesce(d > 0 and d <= 30, false) as is_readmission from g")
def readmission_flags(spark, sf_dir):
    return summaries.readmission_flags(std_encounters(spark, sf_dir)).select("encounter_id", "patient_id", "days_since_discharge", "is_readmission")


@query(
    ENC
    + """, d as (select *, row_number() over (order by los_hours) as n, count(*) over () as c from enc where is_emergency and is_completed and los_hours > 0)
select (select count(*) from enc where is_emergency and is_completed) as total_visits, avg(los_hours) as avg_los_hours, min(los_hours) as min_los_hours, max(los_hours) as max_los_hours,
  count(case when discharge_disposition = 'admitted' then 1 end) as admitted, count(case when discharge_disposition in ('discharged', 'home') then 1 end) as discharged, count(case when discharge_disposition in ('ama', 'left_ama') then 1 end) as left_ama,
  max(case when n = c // 2 + 1 then los_hours end) as median_los_hours from d"""
)
def ed_summary(spark, sf_dir):
    return summaries.ed_summary(std_encounters(spark, sf_dir))


@query(ENC + "select discharge_disposition, count(*) as visits from enc where is_emergency and is_completed group by 1")
def ed_dispositions(spark, sf_dir):
    return summaries.ed_counts(std_encounters(spark, sf_dir), "discharge_disposition")


@query(ENC + "select arrival_hour, count(*) as visits from enc where is_emergency and is_completed group by 1")
def ed_arrival_hours(spark, sf_dir):
    return summaries.ed_counts(std_encounters(spark, sf_dir), "arrival_hour")


_conditions = ", ".join(f"max(cast(regexp_matches(c, {o.text(p)}) as int)) as {n}" for n, (_, p) in T.CHARLSON.items())
_points = " + ".join(f"{n} * {w}" for n, (w, _) in T.CHARLSON.items())


@query(
    DX.replace("with ", f"with patients as ({cte('patients')[len('with patients as ('):-2]}), ", 1)
    + f""", k as (select patient_id, {_conditions} from d1 group by patient_id), s as (select *, {_points} as charlson_index from k)
select s.patient_id, {', '.join(T.CHARLSON)}, charlson_index, a.age, charlson_index + case when a.age >= 50 then (a.age - 40) // 10 else 0 end as age_adjusted_index from s left join (select patient_id, {_age} as age from patients) a on s.patient_id = a.patient_id"""
)
def charlson_index(spark, sf_dir):
    people = standardise.patients(raw(spark, sf_dir, "patients"), AS_OF)
    return summaries.charlson(std(spark, sf_dir, "diagnoses"), people)


_OR = PX + ", s as (select * from px where is_surgical), dd as (select cast(performed_date as date) as day, count(*) as cases, sum(duration_minutes) as minutes, round(sum(duration_minutes) / 600.0 * 100, 1) as utilisation_pct from s group by 1)"


@query(_OR + " select * from dd")
def or_utilisation_daily(spark, sf_dir):
    return summaries.or_daily(std(spark, sf_dir, "procedures"))


@query(_OR + ", r as (select duration_minutes as d, row_number() over (order by duration_minutes) as n, count(*) over () as c from s) select (select count(*) from s) as total_cases, (select sum(duration_minutes) from s) as total_minutes, (select avg(duration_minutes) from s) as avg_minutes, (select min(duration_minutes) from s) as min_minutes, (select max(duration_minutes) from s) as max_minutes, (select max(d) from r where n = c // 2 + 1) as median_duration_minutes, (select count(*) from dd) as operating_days, (select avg(utilisation_pct) from dd) as avg_utilisation_pct")
def or_utilisation(spark, sf_dir):
    return summaries.or_utilisation(std(spark, sf_dir, "procedures"))


# ---- metrics


@query(
    ENC
    + """, spine as (select cast(unnest(generate_series(date '2001-06-01', date '2001-08-01', interval 1 day)) as date) as d),
m as (select d, count(*) as total_census, count(case when department = 'ICU' then 1 end) as icu_census, count(case when department in ('MED', 'SURG') then 1 end) as med_surg_census, count(case when encounter_type = 'observation' then 1 end) as observation_census
  from spine join enc on cast(admission_date as date) <= d and (discharge_date is null or cast(discharge_date as date) > d) group by d)
select spine.d as census_date, coalesce(total_census, 0) as total_census, coalesce(icu_census, 0) as icu_census, coalesce(med_surg_census, 0) as med_surg_census, coalesce(observation_census, 0) as observation_census,
  (select count(*) from enc where cast(admission_date as date) = spine.d) as admissions, (select count(*) from enc where cast(discharge_date as date) = spine.d) as discharges from spine left join m on m.d = spine.d"""
)
def census_daily(spark, sf_dir):
    return metrics.daily_census(std_encounters(spark, sf_dir), "2001-06-01", AS_OF)


@query(ENC + "select department, count(distinct encounter_id) as census, count(case when is_inpatient then 1 end) as inpatients from enc where admission_date <= timestamp '2001-06-15 00:00:00' and (discharge_date is null or discharge_date > timestamp '2001-06-15 00:00:00') group by 1")
def unit_census(spark, sf_dir):
    return metrics.unit_census(std_encounters(spark, sf_dir), F.lit("2001-06-15 00:00:00").cast("timestamp_ntz"))


@query(ENC + "select cast(admission_date as date) as metric_date, count(*) as ed_volume, count(case when discharge_disposition = 'admitted' then 1 end) as admissions, count(case when discharge_disposition = 'lwbs' then 1 end) as lwbs, avg(epoch(discharge_date - admission_date) / 60.0) as avg_los_minutes, round(count(case when discharge_disposition = 'admitted' then 1 end) / count(*) * 100, 2) as admission_rate_pct from enc where is_emergency group by 1")
def ed_throughput_daily(spark, sf_dir):
    return metrics.ed_daily(std_encounters(spark, sf_dir))


_NEXT = ENC + ", ip as (select *, (select min(x.admission_date) from enc x where x.is_inpatient and x.patient_id = enc.patient_id and x.admission_date > enc.discharge_date) as next_admission from enc where is_inpatient), gaps as (select *, date_trunc('month', discharge_date)::date as month, epoch(next_admission - discharge_date) / 86400.0 as gap from ip where is_completed)"


@query(_NEXT + " select month, count(*) as discharges, count(case when gap <= 7 then 1 end) as readmissions_7_day, count(case when gap <= 14 then 1 end) as readmissions_14_day, count(case when gap <= 30 then 1 end) as readmissions_30_day, round(count(case when gap <= 30 then 1 end) / count(*) * 100, 2) as rate_pct from gaps group by 1")
def readmission_windows(spark, sf_dir):
    return metrics.readmissions(std_encounters(spark, sf_dir))


_CONDITIONS = {"heart_failure": "I50", "copd": "J44", "pneumonia": "J18"}


@query(_NEXT + " select month, " + ", ".join(f"count(case when primary_diagnosis_code like '{p}%' then 1 end) as {n}_discharges, count(case when primary_diagnosis_code like '{p}%' and gap <= 30 then 1 end) as {n}_readmissions" for n, p in _CONDITIONS.items()) + " from gaps group by 1")
def readmission_monthly(spark, sf_dir):
    return metrics.readmissions_by_condition(std_encounters(spark, sf_dir), _CONDITIONS)


@query(ENC + "select date_trunc('month', discharge_date)::date as month, drg_code, count(*) as discharges, avg(los_hours) as avg_los_hours, round(avg(los_hours) / 24 / 4.5, 4) as los_index from enc where is_completed group by 1, 2")
def los_monthly(spark, sf_dir):
    return metrics.los_monthly(std_encounters(spark, sf_dir), "drg_code")


@query(ENC + "select department, count(*) as discharges, avg(los_hours) as avg_los, quantile_cont(los_hours, 0.5) as median_los, quantile_cont(los_hours, 0.25) as p25_los, quantile_cont(los_hours, 0.75) as p75_los, quantile_cont(los_hours, 0.9) as p90_los, min(los_hours) as min_los, max(los_hours) as max_los, count(case when los_hours >= 72 then 1 end) as long_stay_3_plus, count(case when los_hours >= 120 then 1 end) as long_stay_5_plus, count(case when los_hours >= 168 then 1 end) as long_stay_7_plus from enc where is_completed group by 1")
def los_stats(spark, sf_dir):
    return metrics.los_stats(std_encounters(spark, sf_dir), "department")


def _monthly(spark, sf_dir):
    e = std_encounters(spark, sf_dir)
    return e.groupBy(F.trunc(F.col("admission_date").cast("date"), "month").alias("month"), F.col("department").alias("unit")).agg(F.count_if(F.col("discharge_disposition") == "lwbs").alias("numerator"), F.count("*").alias("denominator"))


_MONTHLY = ENC + ", mm as (select date_trunc('month', admission_date)::date as month, department as unit, count(case when discharge_disposition = 'lwbs' then 1 end) as numerator, count(*) as denominator from enc group by 1, 2)"


@query(_MONTHLY + " select month, unit, numerator, denominator, numerator / denominator as rate, numerator / denominator - 0.03 as variance, numerator / denominator <= 0.03 as meets_target, percent_rank() over (partition by month order by numerator / denominator) as percentile_rank from mm")
def quality_indicators(spark, sf_dir):
    return metrics.indicator(_monthly(spark, sf_dir), 0.03)


@query(_MONTHLY + ", t as (select month, unit, numerator, denominator, lag(denominator) over (partition by unit order by month) as prior from mm), u as (select *, round((denominator - prior) / nullif(prior, 0) * 100, 2) as change_pct from t) select *, case when change_pct > 0 then 'up' when change_pct < 0 then 'down' when change_pct = 0 then 'flat' end as direction, case when abs(change_pct) < 5 then 'green' when abs(change_pct) < 10 then 'yellow' when change_pct is not null then 'red' end as status from u")
def kpi_trend(spark, sf_dir):
    return metrics.kpi_trend(_monthly(spark, sf_dir), "denominator", "unit")


@query("select cast(ts as date) as metric_date, count(*) as events, count(case when event_type = 'error' then 1 end) as flagged, avg(value) as avg_value, round(count(case when event_type = 'error' then 1 end) / count(*) * 100, 2) as flagged_pct from events group by 1")
def custom_daily_metric(spark, sf_dir):
    return metrics.daily_metric(table(spark, sf_dir, "events"), "ts", F.col("event_type") == "error", F.col("value"))


# ---- dates


_DAYS = "with d as (select cast(unnest(generate_series(date '2000-01-01', date '2002-12-31', interval 1 day)) as date) as full_date)\n"


@query("select distinct cast(strftime(o_orderdate, '%Y%m%d') as int) as date_key, cast(o_orderdate as date) as full_date, cast(year(o_orderdate) as int) as year, cast(quarter(o_orderdate) as int) as quarter, cast(month(o_orderdate) as int) as month, monthname(o_orderdate) as month_name, cast(weekofyear(o_orderdate) as int) as week_of_year, cast(day(o_orderdate) as int) as day_of_month, cast(dayofweek(o_orderdate) as int) as day_of_week, cast(isodow(o_orderdate) - 1 as int) as weekday_mon0, dayname(o_orderdate) as day_name, isodow(o_orderdate) >= 6 as is_weekend, cast(year(o_orderdate) + cast(month(o_orderdate) >= 10 as int) as int) as fiscal_year, cast(((month(o_orderdate) + 2) % 12) // 3 + 1 as int) as fiscal_quarter from orders")
def date_dimension(spark, sf_dir):
    seen = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    return dates.calendar(seen).drop("is_holiday", "holiday_name")


_M, _D, _W = "month(o_orderdate)", "day(o_orderdate)", "isodow(o_orderdate)"
_holiday = f"""case when {_M} = 1 and {_D} = 1 then 'New Year''s Day' when {_M} = 7 and {_D} = 4 then 'Independence Day' when {_M} = 11 and {_D} = 11 then 'Veterans Day' when {_M} = 12 and {_D} = 25 then 'Christmas Day'
  when {_M} = 1 and {_W} = 1 and {_D} between 15 and 21 then 'Martin Luther King Jr. Day' when {_M} = 2 and {_W} = 1 and {_D} between 15 and 21 then 'Presidents Day' when {_M} = 5 and {_W} = 1 and {_D} > 24 then 'Memorial Day'
  when {_M} = 9 and {_W} = 1 and {_D} <= 7 then 'Labor Day' when {_M} = 10 and {_W} = 1 and {_D} between 8 and 14 then 'Columbus Day' when {_M} = 11 and {_W} = 4 and {_D} between 22 and 28 then 'Thanksgiving Day' end"""


@query(f"select {_holiday} as holiday, count(*) as encounters from orders where {_holiday} is not null group by 1")
def holidays(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").withColumn("holiday", dates.federal_holiday(day)).where("holiday is not null").groupBy("holiday").agg(F.count("*").alias("encounters"))


@query(cte("patients") + f"select {o.bands(f'greatest({_age}, 0)', *dates.AGE_BANDS)} as age_band, count(*) as patients from patients group by 1")
def age_bands(spark, sf_dir):
    years = F.greatest(dates.age(F.col("date_of_birth"), F.lit(AS_OF).cast("date")), F.lit(0))
    return raw(spark, sf_dir, "patients").groupBy(dates.age_band(years, "band").alias("age_band")).agg(F.count("*").alias("patients"))


# ---- quality and protected information


_LABV = cte("labs") + ", l as (select *, try_cast(value as double) as v, upper(test_name) as n from labs)"
_plausible = "case " + " ".join(f"when contains(n, '{k}') then v between {a} and {b}" for k, (a, b) in T.PLAUSIBLE_LABS.items()) + " end"


@query(_LABV + f" select source_id, 'valid_lab_value' as rule, 'error' as severity from l where value is not null and v is null union all select source_id, 'lab_value_in_range', 'warning' from l where not coalesce({_plausible}, true)")
def rule_violations(spark, sf_dir):
    return rules.violations(raw(spark, sf_dir, "labs"), rules.standard_rules("lab", "2024-01-31"), "source_id")


_bad = "(not (heart_rate between 20 and 300))::int + (not (systolic_bp between 40 and 300 and diastolic_bp between 20 and 200 and diastolic_bp < systolic_bp))::int + (not (temperature between 85 and 115))::int + (not (oxygen_saturation between 0 and 100))::int"


@query(cte("vitals") + f", r as (select {_bad} as e from vitals) select count(*) as total, count(case when e = 0 then 1 end) as valid, count(case when e > 0 then 1 end) as invalid, cast(sum(e) as bigint) as errors, cast(0 as bigint) as warnings, round(count(case when e > 0 then 1 end) / count(*) * 100, 2) as error_rate_pct from r")
def rule_report(spark, sf_dir):
    return rules.report(raw(spark, sf_dir, "vitals"), rules.standard_rules("vital", "2024-01-31"))


@query("select count(*) as orphans from orders where not exists (select 1 from customer where c_custkey = o_custkey and c_custkey % 10 <> 0)")
def dq_orphans(spark, sf_dir):
    known = table(spark, sf_dir, "customer").where("c_custkey % 10 <> 0").select(F.col("c_custkey").alias("o_custkey"))
    return rules.orphans(table(spark, sf_dir, "orders"), known, "o_custkey")


@query(cte("encounters") + "select count(case when discharge_date is null then 1 end) as missing_discharge_date, count(case when patient_id is null then 1 end) as missing_patient_id from encounters")
def dq_required(spark, sf_dir):
    return rules.missing_counts(raw(spark, sf_dir, "encounters"), ["discharge_date", "patient_id"])


@query("select text, count(*) as rows from documents group by 1 having count(*) > 1")
def dq_duplicates(spark, sf_dir):
    return rules.duplicates(table(spark, sf_dir, "documents"), "text")


@query(cte("diagnoses") + f"select {_dx} as code, count(*) as rows from diagnoses where not regexp_matches({_dx}, '^[A-TV-Z]\\d[A-Z\\d]{{0,5}}$') group by 1")
def dq_icd(spark, sf_dir):
    bad = rules.violations(raw(spark, sf_dir, "diagnoses").withColumn("key", standardise.diagnosis_code(F.col("code"))), rules.standard_rules("diagnosis", AS_OF), "key")
    return bad.groupBy(F.col("key").alias("code")).agg(F.count("*").alias("rows"))


_phi = " union all ".join("select doc_id, '{k}' as kind from documents where {w}".format(k=k, w=" or ".join(f"regexp_matches(text, {o.text('(?i)' + p)})" for p in ps)) for k, ps in T.PHI_PATTERNS.items())


@query(f"select kind, 'text' as field, count(*) as findings, count(distinct doc_id) as records from ({_phi}) group by 1")
def phi_summary(spark, sf_dir):
    return phi.scan_summary(read_parquet(spark, f"{sf_dir}/documents.parquet", wide=True).select("doc_id", "text"), "doc_id")


_SAID = "concat(text, case conv_id % 6 when 0 then ' SSN: 123456789' when 1 then ' call (555) 123-4567' when 2 then ' a.b@example.org' when 3 then ' dob: 1/2/1990' when 4 then ' 10.0.0.1' else '' end)"


@query(f"with said as (select conv_id, turn, {_SAID} as text from conversations) " + _phi.replace("documents", "said").replace("doc_id", "conv_id, turn"))
def phi_hits(spark, sf_dir):
    df = table(spark, sf_dir, "conversations").select(F.struct("conv_id", "turn").alias("id"), F.expr(_SAID).alias("text"))
    return phi.scan(df, "id").select("id.conv_id", "id.turn", "kind")


@query(cte("patients") + "select patient_id, sha256(concat('s1:', mrn)) as mrn_hash, sha256(concat('s1:', ssn)) as ssn_hash from patients")
def hash_match(spark, sf_dir):
    return raw(spark, sf_dir, "patients").select("patient_id", phi.matching_hash(F.col("mrn"), "s1").alias("mrn_hash"), phi.matching_hash(F.col("ssn"), "s1").alias("ssn_hash"))


@query(cte("patients") + "select patient_id, ssn, phone, true as hidden, true as salted, true as moved from patients")
def encrypt_roundtrip(spark, sf_dir):
    """Values after encryption, rotation and decryption; whether what was stored differs from them, from a second encryption
    and from what rotation made of it."""
    old, new = (F.lit(k * 16).cast("binary") for k in ("a", "b"))
    plain = raw(spark, sf_dir, "patients").select("patient_id", "ssn", "phone").withColumns({"once": F.col("ssn"), "twice": F.concat("ssn", F.substring("phone", 1, 0)), "own": F.col("ssn")})
    secret = phi.encrypted(plain, ["phone", "once", "twice"], old)
    moved = phi.rotated(secret.withColumns({"before": F.col("once"), "ssn": F.col("once")}), ["phone", "ssn"], old, new)
    seen = moved.withColumns({"hidden": ~F.col("before").contains(F.col("own")), "salted": F.col("once") != F.col("twice"), "moved": F.col("ssn") != F.col("before")})
    return phi.decrypted(seen, ["ssn", "phone"], new).select("patient_id", "ssn", "phone", "hidden", "salted", "moved")


@query(cte("ed_hourly") + "select * from ed_hourly where facility = 'FAC-1'")
def facility_filter(spark, sf_dir):
    return phi.of_facility(raw(spark, sf_dir, "ed_hourly"), "FAC-1")


# ---- loads


@query("select o_orderkey, case when o_orderkey % 3 = 0 then 'new' else o_orderstatus end as status, o_totalprice from orders where o_orderkey % 3 <> 1 or o_orderkey % 2 = 0")
def upsert_latest(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), "o_totalprice")
    base = rows.where("o_orderkey % 3 <> 1")
    changed = rows.where("o_orderkey % 3 = 0").withColumn("status", F.lit("new")).withColumn("at", F.lit(2))
    stale = rows.where("o_orderkey % 3 = 0").withColumn("status", F.lit("stale")).withColumn("at", F.lit(1))
    added = rows.where("o_orderkey % 3 = 1 and o_orderkey % 2 = 0").withColumn("at", F.lit(1))
    return loads.upsert(base, changed.unionByName(stale).unionByName(added), ["o_orderkey"], "at")


@query("select o_orderkey, case when o_orderkey % 4 = 0 then 'set' else o_orderstatus end as status, o_totalprice from orders")
def upsert_subset(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), "o_totalprice")
    changed = rows.where("o_orderkey % 4 = 0").withColumns({"status": F.lit("set"), "o_totalprice": F.lit(0.0)})
    return loads.upsert_columns(rows, changed, ["o_orderkey"], ["status"])


@query("select c_custkey, case when c_custkey % 2 = 0 then 'old' else 'new' end as version from customer")
def insert_if_absent(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey")
    return loads.insert_if_absent(c.where("c_custkey % 2 = 0").withColumn("version", F.lit("old")), c.withColumn("version", F.lit("new")), ["c_custkey"])


@query("select event_id, ts from events where ts >= timestamp '2024-01-01 00:00:00' and ts >= date '2024-01-31' - 20")
def retention_delete(spark, sf_dir):
    return loads.retain(table(spark, sf_dir, "events").select("event_id", "ts"), "ts", "2024-01-31", 20)


@query("select event_id, ts from events where ts >= timestamp '2024-01-20 10:00:00'")
def watermark_incremental(spark, sf_dir):
    return loads.since(table(spark, sf_dir, "events").select("event_id", "ts"), F.col("ts"), "2024-01-20 12:00:00")


@query("select 'hospital' as source_system, event_type as entity_type, greatest(max(ts), timestamp '2024-01-15 00:00:00') as last_value from events group by event_type")
def watermark_advance(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    old = e.select(F.lit("hospital").alias("source_system"), F.col("event_type").alias("entity_type"), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz").alias("last_value")).distinct()
    return loads.advance(old, e.groupBy(F.lit("hospital").alias("source_system"), F.col("event_type").alias("entity_type")).agg(F.max("ts").alias("last_value")))


@query(
    """select c_custkey as patient_id, c_name as last_name, c_mktsegment as segment, date '2020-01-01' as effective_date, case when c_custkey % 3 = 0 then date '2021-01-01' end as expiration_date, c_custkey % 3 <> 0 as is_current from customer where c_custkey % 5 <> 0
union all select c_custkey, c_name, case when c_custkey % 3 = 0 then null else c_mktsegment end, date '2021-01-01', null, true from customer where c_custkey % 3 = 0 or c_custkey % 5 = 0"""
)
def dim_patient_scd2(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("patient_id"), F.col("c_name").alias("last_name"), F.col("c_mktsegment").alias("segment"))
    dim = c.where("patient_id % 5 <> 0").withColumns({"effective_date": F.lit("2020-01-01").cast("date"), "expiration_date": F.lit(None).cast("date"), "is_current": F.lit(True)})
    source = c.withColumn("segment", F.when(F.col("patient_id") % 3 != 0, F.col("segment")))
    return loads.scd2(dim, source, "patient_id", ["last_name", "segment"], "2021-01-01")


@query(ENC + "select encounter_id, patient_id, cast(strftime(admission_date, '%Y%m%d') as int) as admit_date_key, cast(strftime(discharge_date, '%Y%m%d') as int) as discharge_date_key, los_days, total_charges, is_emergency as is_ed_visit, coalesce((select count(*) from lineitem where l_orderkey = encounter_id), 0) as diagnosis_count from enc")
def fact_encounter_build(spark, sf_dir):
    e = std_encounters(spark, sf_dir)
    n = raw(spark, sf_dir, "diagnoses").groupBy("encounter_id").agg(F.count("*").alias("diagnosis_count"))
    return e.join(n, "encounter_id", "left").select("encounter_id", "patient_id", dates.date_key(F.col("admission_date")).alias("admit_date_key"), dates.date_key(F.col("discharge_date")).alias("discharge_date_key"), "los_days", "total_charges", F.col("is_emergency").alias("is_ed_visit"), F.coalesce("diagnosis_count", F.lit(0)).alias("diagnosis_count"))


# ---- messages and bundles


def _hl7(spark, sf_dir) -> DataFrame:
    e = raw(spark, sf_dir, "encounters", wide=True).join(raw(spark, sf_dir, "patients").select("patient_id", "last_name", F.trim("first_name").alias("given"), "date_of_birth"), "patient_id")
    stamp = lambda c, f="yyyyMMddHHmmss": F.coalesce(F.date_format(c, f), F.lit(""))
    pad = lambda n: F.lit("|" * n)
    lines = [
        F.concat(F.lit("MSH|^~\\&|ADM|HOSP|LAKE|HOSP|"), stamp(F.col("admission_date")), F.lit("||ADT^A01|C"), F.col("encounter_id").cast("string"), F.lit("|P|2.5")),
        F.concat(F.lit("EVN|A01|"), stamp(F.col("admission_date"))),
        F.concat(F.lit("PID|1||"), F.col("patient_id").cast("string"), F.lit("||"), F.col("last_name"), F.lit("^"), F.col("given"), F.lit("||"), stamp(F.col("date_of_birth"), "yyyyMMdd"), F.lit("|F")),
        F.concat(F.lit("PV1|1|E|"), F.col("department"), F.lit("^1^2"), pad(16), F.col("encounter_id").cast("string"), pad(26), stamp(F.col("discharge_date"))),
        F.concat(F.lit("DG1|1||"), F.col("primary_diagnosis_code"), F.lit("^Text^I10")),
    ]
    return hl7.headed(hl7.parsed(hl7.messages(e.select(F.concat_ws("\r", *lines).alias("value")))))


@query(cte("encounters") + "select concat('C', encounter_id) as control_id, cast(encounter_id as string) as encounter_id, cast(patient_id as string) as patient_id, 'emergency' as encounter_type, admission_date, discharge_date, department, 'active' as status from encounters")
def hl7_encounters(spark, sf_dir):
    out = hl7.encounters(_hl7(spark, sf_dir))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("admission_date", "discharge_date")})


@query(cte("encounters") + "select concat('C', encounter_id) as control_id, cast(patient_id as string) as patient_id, cast(1 as int) as rank, primary_diagnosis_code as code, 'Text' as description, cast(null as string) as diagnosis_type from encounters")
def hl7_diagnoses(spark, sf_dir):
    return hl7.diagnoses(_hl7(spark, sf_dir))


@query(cte("encounters").rstrip() + ", " + cte("patients")[5:] + "select concat('C', encounter_id) as control_id, cast(e.patient_id as string) as patient_id, last_name, trim(first_name) as first_name, date_of_birth, 'female' as gender from encounters e join patients p on e.patient_id = p.patient_id")
def hl7_patients(spark, sf_dir):
    return hl7.patients(_hl7(spark, sf_dir)).select("control_id", "patient_id", "last_name", "first_name", "date_of_birth", "gender")


def _fhir(spark, sf_dir) -> DataFrame:
    p, e = raw(spark, sf_dir, "patients", wide=True), raw(spark, sf_dir, "encounters", wide=True)
    code = lambda c: F.struct(F.array(F.struct(c.alias("code"))).alias("coding"))
    one = lambda *fields: F.to_json(F.struct(F.lit("Bundle").alias("resourceType"), F.array(F.struct(F.struct(*fields).alias("resource"))).alias("entry")))
    people = p.select(one(F.lit("Patient").alias("resourceType"), F.col("patient_id").cast("string").alias("id"), F.array(F.struct(code(F.lit("MR")).alias("type"), F.col("mrn").alias("value"))).alias("identifier"), F.array(F.struct(F.col("last_name").alias("family"), F.array(F.col("first_name"), F.lit("Q")).alias("given"))).alias("name"), F.date_format("date_of_birth", "yyyy-MM-dd").alias("birthDate"), F.array(F.struct(F.lit("phone").alias("system"), F.col("phone").alias("value"))).alias("telecom")).alias("value"))
    visits = e.select(one(F.lit("Encounter").alias("resourceType"), F.col("encounter_id").cast("string").alias("id"), F.lit("finished").alias("status"), F.struct(F.col("encounter_type").alias("code")).alias("class"), F.struct(F.concat(F.lit("Patient/"), F.col("patient_id").cast("string")).alias("reference")).alias("subject"), F.struct(F.date_format("admission_date", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("start"), F.date_format("discharge_date", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("end")).alias("period"), F.struct(code(F.col("discharge_disposition")).alias("dischargeDisposition")).alias("hospitalization"), F.array(F.struct(F.struct(F.lit("Location/7").alias("reference"), F.col("department").alias("display")).alias("location"))).alias("location"), F.struct(F.lit("Hospital").alias("display")).alias("serviceProvider"), F.array(code(F.col("primary_diagnosis_code"))).alias("reasonCode")).alias("value"))
    return fhir.resources(people.unionByName(visits))


@query(cte("patients") + "select cast(patient_id as string) as patient_id, mrn, concat(first_name, ' Q') as first_name, last_name, date_of_birth, phone from patients")
def fhir_patients(spark, sf_dir):
    return fhir.patients(_fhir(spark, sf_dir)).select("patient_id", "mrn", "first_name", "last_name", "date_of_birth", "phone")


@query(cte("encounters") + "select cast(encounter_id as string) as encounter_id, cast(patient_id as string) as patient_id, encounter_type, 'finished' as status, admission_date, discharge_date, discharge_disposition, department as location, '7' as location_id, 'Hospital' as service_provider, primary_diagnosis_code as reason_code from encounters")
def fhir_encounters(spark, sf_dir):
    out = fhir.encounters(_fhir(spark, sf_dir)).drop("admit_source")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("admission_date", "discharge_date")})
