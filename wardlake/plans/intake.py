"""Queries of raw records, files, bundles, messages, loads, the star and table checks, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.functions import dates
from wardlake.functions import tables as T
from wardlake.operators import loads, phi, rules, standardise, star, versioned
from wardlake.operators import raw as records
from wardlake.plans import oracle as o
from wardlake.plans.catalogue import _LABV, AS_OF, DX, ENC, ORACLE_SQL, PX, QUERIES, _age, _any, _category, _cpt, _digits, _doses, _dx, _flat, _known, _news, _status, _ten, _title, _usual, query, std_encounters, table
from wardlake.plans.fixtures import cte, raw
from wardlake.sources import fhir, flat, hl7, relational, scratch
from wardlake.streaming import streams

__all__ = ["ORACLE_SQL", "QUERIES"]


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def pick(by: Column, *values: str | None) -> Column:
    """The value at by % how many there are."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (by % len(values) + 1).cast("int"))


def picked(by: str, *values: str | None) -> str:
    return f"case {by} % {len(values)} " + " ".join(f"when {k} then {o.text(v)}" for k, v in enumerate(values)) + " end"


def kept(df: DataFrame, kind: str, **how) -> DataFrame:
    return standardise.split(records.standard(df, kind, **how))[0]


# ---- raw records in standard form

_VISIT = ("Active", "discharged", " CANCELED", "no-show", "weird", None)


@query(
    ENC
    + f""", s as (select *, lower(trim({picked('encounter_id', *_VISIT)})) as k from enc)
select cast(encounter_id as string) as encounter_id, cast(patient_id as string) as patient_id, encounter_type, admission_date, discharge_date, department, discharge_disposition, primary_diagnosis_code, drg_code, total_charges, los_hours, los_days,
  is_inpatient, is_emergency, is_completed, arrival_hour, arrival_day, {o.mapped('k', T.ENCOUNTER_STATUS, 'k')} as status, concat('H', encounter_id % 3) as facility, cast(null as string) as location, 'Dr. A' as attending_provider, cast(null as string) as admit_source,
  case when encounter_id % 2 = 0 then 'medicare' end as financial_class from s"""
)
def encounters_raw_std(spark, sf_dir):
    e = raw(spark, sf_dir, "encounters", wide=True)
    n = F.col("encounter_id")
    form = lambda c: F.when(n % 4 == 0, F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(n % 4 == 1, F.date_format(c, "yyyy-MM-dd HH:mm:ss")).when(n % 4 == 2, F.date_format(c, "MM/dd/yyyy HH:mm:ss")).otherwise(F.date_format(c, "yyyyMMddHHmmss"))
    turned = (n % 10 == 3) & F.col("discharge_date").isNotNull()
    first, last = F.when(turned, F.col("discharge_date")).otherwise(F.col("admission_date")), F.when(turned, F.col("admission_date")).otherwise(F.col("discharge_date"))
    source = e.select(
        text("encounter_id").alias("Source_ID"), text("patient_id").alias("patient_id"), F.col("encounter_type").alias("class"), pick(n, *_VISIT).alias("status"), form(first).alias("arrival_date"), form(last).alias("departure_date"),
        F.lit(" ").alias("department"), F.col("department").alias("unit"), F.concat(F.lit("H"), text(n % 3)).alias("hospital"), F.lit("Dr. A").alias("provider"), "discharge_disposition", "primary_diagnosis_code", "drg_code",
        F.when(n % 2 == 0, "medicare").alias("payer_class"), text("total_charges").alias("total_charges"), F.lit("left out").alias("other"),
    )
    return kept(source, "encounters")


@query(
    cte("patients")
    + f"""select cast(patient_id as string) as patient_id, mrn, {_title.format(c='first_name')} as first_name, {_title.format(c='last_name')} as last_name, {o.mapped(f"lower({o.blank('gender')})", T.GENDER, "'unknown'")} as gender, date_of_birth,
  case when regexp_matches(postal_code, '^\\d{{1,4}}$') then lpad(postal_code, 5, '0') else postal_code end as postal_code,
  case when length(trim(state)) = 2 then upper(trim(state)) else {o.mapped('upper(trim(state))', T.STATES, 'substr(upper(trim(state)), 1, 2)')} end as state,
  case when length({_ten}) = 10 then concat('(', substr({_ten}, 1, 3), ') ', substr({_ten}, 4, 3), '-', substr({_ten}, 7, 4)) else phone end as phone,
  case when contains(email, '@') then lower(trim(email)) end as email, {o.mapped(f"upper({o.blank('marital_status')})", T.MARITAL, 'lower(trim(marital_status))')} as marital_status,
  sha256(concat('wardlake', ssn)) as ssn_hash, cast({_age} as int) as age, {o.bands(_age, *dates.LIFE_STAGES)} as age_group, concat(patient_id, ' Main St') as address_line1, case when patient_id % 3 = 0 then 'Canada' else 'USA' end as country from patients"""
)
def patients_raw_std(spark, sf_dir):
    p = raw(spark, sf_dir, "patients")
    n = F.col("patient_id")
    born = F.when(n % 3 == 0, F.date_format("date_of_birth", "M/d/yyyy")).when(n % 3 == 1, F.date_format("date_of_birth", "yyyyMMdd")).otherwise(F.date_format("date_of_birth", "yyyy-MM-dd"))
    source = p.select(
        text("patient_id").alias("source_id"), "mrn", "first_name", "last_name", F.col("gender").alias("Sex"), born.alias("DOB"), F.concat(text("patient_id"), F.lit(" Main St")).alias("address"), "state", F.col("postal_code").alias("zip"),
        F.when(n % 3 == 0, "Canada").alias("country"), "phone", "email", "ssn", "marital_status",
    )
    return kept(source, "patients", as_of=AS_OF)


_SYSTEMS = ("icd10", " ICD-10-CM ", None)


@query(
    DX
    + f""", d2 as (select * exclude (s), case when rank % 3 < 2 then 'ICD-10-CM' else s end as s from d1 where not (rank = 1 and encounter_id % 9 = 0))
select cast(encounter_id as string) as encounter_id, cast(patient_id as string) as patient_id, cast(rank as int) as rank, c as code, s as code_system, {o.mapped('lower(t)', T.DIAGNOSIS_TYPE, 'lower(t)')} as diagnosis_type, {o.mapped('upper(p)', T.PRESENT_ON_ADMISSION, 'upper(p)')} as present_on_admission,
  case when s = 'ICD-10-CM' then {o.mapped('substr(c, 1, 1)', T.CHAPTERS)} end as chapter, case when s = 'ICD-10-CM' then substr(c, 1, 3) end as category, case when s = 'ICD-10-CM' and length(c) >= 4 then substr(c, 1, 4) end as subcategory,
  substr(c, 1, 3) in ('E10', 'E11', 'E13') as is_diabetes, substr(c, 1, 3) in ('I10', 'I11', 'I12', 'I13') as is_hypertension, substr(c, 1, 3) = 'I50' as is_chf, substr(c, 1, 3) = 'J44' as is_copd, substr(c, 1, 3) = 'N18' as is_ckd,
  c like 'C%' as is_cancer, case when length(c) > 3 then concat(substr(c, 1, 3), '.', substr(c, 4)) else c end as display_code, date '2001-01-31' + cast(rank as int) as onset_date, 'Text' as description from d2"""
)
def diagnoses_raw_std(spark, sf_dir):
    d = raw(spark, sf_dir, "diagnoses", wide=True)
    rank = F.when((F.col("rank") == 1) & (F.col("encounter_id") % 9 == 0), "0").otherwise(text("rank"))
    onset = F.date_add(F.lit("2001-01-31").cast("date"), F.col("rank").cast("int"))
    source = d.select(text("encounter_id").alias("encounter_id"), text("patient_id").alias("patient_id"), rank.alias("rank"), "code", pick(F.col("rank"), *_SYSTEMS).alias("code_system"), F.col("diagnosis_type").alias("type"), "present_on_admission", F.date_format(onset, "MM/dd/yyyy").alias("onset_date"), F.lit(" Text ").alias("description"))
    return kept(source, "diagnoses")


_DONE = ("done", "In Progress", "weird", None)


@query(
    PX
    + f""", q0 as (select *, case when code = '8151' then 'ICD-9-CM' else s end as named, lower({picked('encounter_id', *_DONE)}) as k from p1)
select cast(encounter_id as string) as encounter_id, cast(patient_id as string) as patient_id, code, named as code_system, {_cpt} as category, coalesce(n between 10000 and 69999, false) as is_surgical, named = 'CPT-4' and code like '99%' as is_em, duration_minutes, performed_date,
  dayname(performed_date) as procedure_day, cast(hour(performed_date) as int) as procedure_hour, charges, {o.mapped('k', T.PROCEDURE_STATUS, 'k')} as status from q0"""
)
def procedures_raw_std(spark, sf_dir):
    p = raw(spark, sf_dir, "procedures", wide=True)
    named = F.when(F.col("code") == "99213", "cpt").when(F.col("code") == "8151", " icd9")
    source = p.select(text("encounter_id").alias("encounter_id"), text("patient_id").alias("patient_id"), "code", named.alias("code_system"), pick(F.col("encounter_id"), *_DONE).alias("status"), F.concat(text("duration_minutes"), F.lit(".0")).alias("duration_minutes"), F.date_format("performed_date", "yyyy-MM-dd'T'HH:mm:ss").alias("performed_date"), text("charges").alias("charges"))
    return kept(source, "procedures")


_FINAL = ("F", "Canceled", None)


@query(
    cte("labs")
    + f""", l0 as (select *, try_cast(regexp_replace(regexp_replace(trim(value), '^[<>]+', ''), '%$', '') as double) as v, {_usual}, {_known} as known, lower({picked('source_id', *_FINAL)}) as k from labs),
l1 as (select * exclude (low, high), case when source_id % 3 = 0 then 5.0 when v is not null then low end as low, case when source_id % 4 = 0 then 300.0 when v is not null then high end as high from l0)
select cast(source_id as string) as source_id, cast(patient_id as string) as patient_id, test_name, v as value, case when v is null then value end as value_string, cast(low as double) as reference_low, cast(high as double) as reference_high,
  {o.mapped('upper(interpretation)', T.INTERPRETATION, 'lower(interpretation)')} as interpretation, case when v is null then null when v < low or v > high then true when low is not null or high is not null then false end as is_abnormal,
  case when v is null or not known then null when v < critical_low or v > critical_high then true else false end as is_critical, case when v is null then null when v < low then round(v - low, 2) when v > high then round(v - high, 2) else 0 end as delta,
  {_category} as category, date_trunc('second', effective_date) as effective_date, 'mg/dL' as value_unit, {o.mapped('k', T.LAB_STATUS, 'k')} as status from l1"""
)
def labs_raw_std(spark, sf_dir):
    n = F.col("source_id")
    source = raw(spark, sf_dir, "labs", wide=True).select(
        text("source_id").alias("source_id"), text("patient_id").alias("patient_id"), F.col("test_name").alias("description"), "value", F.lit("mg/dL").alias("unit"), F.when(n % 3 == 0, " 5").alias("reference_range_low"),
        F.when(n % 4 == 0, ">300").alias("reference_range_high"), F.col("interpretation").alias("abnormal_flag"), pick(n, *_FINAL).alias("status"), F.date_format("effective_date", "yyyy-MM-dd HH:mm:ss").alias("effective_date"),
    )
    return kept(source, "labs")


_NEWS = _news.replace("case when oxygen_device is not null then", "case when source_id % 9 = 0 or source_id % 5 = 0 then")


@query(
    cte("vitals")
    + f""", v0 as (select *, case when temperature < 50 then round(temperature * 9 / 5 + 32, 1) else temperature end as t, cast(source_id % 12 as int) as pain, case when source_id % 2 = 0 then weight * 0.453592 else weight end as kg,
  case when source_id % 2 = 0 then height / 2 * 0.0254 else height / 100 end as m from vitals where source_id % 12 <> 11 and source_id % 16 >= 3), v1 as (select *, {_NEWS} as news from v0)
select cast(source_id as string) as source_id, cast(patient_id as string) as patient_id, date_trunc('second', recorded_date) as recorded_date, heart_rate, respiratory_rate, systolic_bp, diastolic_bp, t as temperature, oxygen_saturation,
  case when source_id % 7 = 0 then 77.0 else round((systolic_bp + 2 * diastolic_bp) / 3, 1) end as mean_arterial_pressure, case when source_id % 11 = 0 then 20.5 else round(kg / (m * m), 1) end as bmi,
  {', '.join(_status(k, 't' if k == 'temperature' else k) for k in ('heart_rate', 'respiratory_rate', 'systolic_bp', 'diastolic_bp', 'oxygen_saturation', 'temperature'))}, {_status('pain_score', 'pain')},
  cast(news as int) as news_score, case when news <= 4 then 'low' when news <= 6 then 'medium' else 'high' end as news_risk,
  case when systolic_bp < 120 and diastolic_bp < 80 then 'normal' when systolic_bp < 130 and diastolic_bp < 80 then 'elevated' when systolic_bp < 140 or diastolic_bp < 90 then 'stage_1' when systolic_bp < 180 and diastolic_bp < 120 then 'stage_2' else 'crisis' end as bp_class from v1"""
)
def vitals_raw_std(spark, sf_dir):
    n = F.col("source_id")
    source = raw(spark, sf_dir, "vitals", wide=True).select(
        text("source_id").alias("source_id"), text("patient_id").alias("patient_id"), F.date_format("recorded_date", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("effective_date"), F.lit(0.0).alias("heart_rate"), F.concat(F.lit(" "), text("heart_rate")).alias("pulse"),
        text("respiratory_rate").alias("resp_rate"), text("systolic_bp").alias("sbp"), text("diastolic_bp").alias("dbp"), F.when(n % 7 == 0, "77").alias("map"), text("temperature").alias("temp"), text("oxygen_saturation").alias("spo2"),
        "oxygen_device", F.when(n % 5 == 0, "0.4").otherwise("0.21").alias("fio2"), "weight", F.when(n % 2 == 0, "LBS").otherwise("kg").alias("weight_unit"), F.when(n % 2 == 0, F.col("height") / 2).otherwise(F.col("height")).alias("height"),
        F.when(n % 2 == 0, "in").otherwise("cm").alias("height_unit"), F.when(n % 11 == 0, "20.5").otherwise("0").alias("bmi"), text(n % 12).alias("pain"), text(n % 16).alias("gcs"),
    )
    return kept(source, "vitals")


_ORDERS = ("on-hold", "X", None)


@query(
    cte("medications")
    + f""", m0 as (select *, lower(medication_name) as m, lower(frequency) as f, lower({picked('line', *_ORDERS)}) as k from medications where line <> 7)
select cast(encounter_id as string) as encounter_id, cast(line as string) as line, medication_name, {o.mapped('lower(route)', T.ROUTE, 'lower(route)')} as route,
  case when line % 3 = 0 then 250.0 else cast(nullif(regexp_extract(m, '(\\d+\\.?\\d*)\\s*(mg|g|mcg|ml|unit|units|meq)', 1), '') as double) end as dose_value,
  case when line % 3 = 0 then 'tab' else coalesce(nullif(regexp_extract(m, '(\\d+\\.?\\d*)\\s*(mg|g|mcg|ml|unit|units|meq)', 2), ''), 'tab') end as dose_unit, contains(f, 'prn') or contains(f, 'as needed') as is_prn, {o.hits('m', _flat(T.DRUG_CLASSES))} as drug_class,
  {o.hits('m', _flat(T.HIGH_ALERT))} is not null as is_high_alert, {o.hits('m', _flat(T.HIGH_ALERT))} as high_alert_category, {_any(T.OPIOIDS)} as is_opioid, {_any(T.CONTROLLED)} as is_controlled, {_any(T.ANTICOAGULANTS)} as is_anticoagulant,
  {_doses} as doses_per_day, cast(end_date - start_date as int) as therapy_days, {o.mapped('k', T.MEDICATION_STATUS, 'k')} as status from m0"""
)
def medications_raw_std(spark, sf_dir):
    n = F.col("line")
    source = raw(spark, sf_dir, "medications", wide=True).select(
        text("encounter_id").alias("encounter_id"), text("line").alias("source_id"), F.col("medication_name").alias("drug_name"), pick(n, *_ORDERS).alias("status"), pick(n, "250 tablets", "two", None).alias("dose"), F.lit("tab").alias("dose_unit"), "route",
        F.col("frequency").alias("sig"), F.date_format("start_date", "MM/dd/yyyy").alias("start_date"), text("end_date").alias("end_date"), F.when(n == 7, "-1").otherwise("30").alias("quantity"),
    )
    return kept(source, "medications")


# ---- files

@query(cte("patients") + "select cast(patient_id as string) as source_id, mrn, nullif(trim(gender), '') as gender, cast(date_of_birth as string) as date_of_birth, trim(state) as state, patient_id % 2 = 0 as first_layout from patients")
def csv_two_layouts(spark, sf_dir):
    """Patients as files in two orders of columns, under different names, read back as one."""
    p, at = raw(spark, sf_dir, "patients"), scratch.folder(spark, "layouts")
    p.where("patient_id % 2 = 0").select(F.col("patient_id").alias("Patient ID"), "mrn", F.col("gender").alias("Sex"), F.col("date_of_birth").alias("DOB"), "state").write.csv(f"{at}/patients_a.csv", header=True)
    p.where("patient_id % 2 = 1").select("state", F.col("date_of_birth").alias("Birth Date"), F.col("mrn").alias("Medical Record Number"), F.lit("x").alias("unknown"), F.col("gender").alias("gender"), F.col("patient_id").alias("patient_id")).write.csv(f"{at}/patients_b.csv", header=True)
    good, _ = flat.quarantined(flat.read(spark, at, "patients"))
    out = flat.canonical(good.withColumn("_source_layout", F.col("unknown").isNull()), "patients")
    return out.select("source_id", "mrn", "gender", "date_of_birth", "state", (F.col("source_id").cast("long") % 2 == 0).alias("first_layout"))


@query(cte("vitals") + "select cast(source_id as string) as source_id, cast(patient_id as string) as patient_id, heart_rate from vitals")
def csv_vitals(spark, sf_dir):
    at = scratch.folder(spark, "vitals")
    raw(spark, sf_dir, "vitals").select(F.col("source_id").alias("Result ID"), F.col("patient_id").alias("PATIENT_ID"), F.col("heart_rate").alias("Numeric Value")).write.csv(f"{at}/vitals.csv", header=True, sep="|")
    return flat.canonical(flat.quarantined(flat.read(spark, at, "vitals", sep="|"))[0], "vitals").select("source_id", "patient_id", F.col("value").cast("double").alias("heart_rate"))


@query("select c_custkey as source_id, concat('M', c_custkey) as mrn, c_name as last_name, n_name as city from customer join nation on c_nationkey = n_nationkey where c_custkey % 2 = 0")
def mapped_source(spark, sf_dir):
    """A known system's three tables, as canonical fields, through its mapping."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    null = F.lit(None).cast("string")
    c.select(F.col("c_custkey").alias("person_id"), null.alias("name_first"), F.col("c_name").alias("name_last"), null.alias("birth_dt_tm"), null.alias("sex_cd"), F.col("c_phone").alias("phone_num") if "c_phone" in c.columns else null.alias("phone_num"), F.when(F.col("c_custkey") % 2 == 0, "2024-02-01").otherwise("2023-01-01").alias("updt_dt_tm")).createOrReplaceTempView("PERSON")
    alias = c.select(F.col("c_custkey").alias("person_id"), F.concat(F.lit("M"), F.col("c_custkey")).alias("alias"), F.lit(10).alias("alias_pool_cd"))
    alias.unionByName(alias.withColumns({"alias": F.lit("other"), "alias_pool_cd": F.lit(11)})).createOrReplaceTempView("PERSON_ALIAS")
    c.select(F.col("c_custkey").alias("parent_entity_id"), null.alias("street_addr"), F.col("n_name").alias("city"), null.alias("state"), null.alias("zipcode")).createOrReplaceTempView("ADDRESS")
    spark.createDataFrame([(10, "MRN"), (12, "SSN")], "code_value int, CDF_MEANING string").createOrReplaceTempView("CODE_VALUE")
    return relational.mapped_records(spark, "b_patients", "2024-01-01").select("source_id", "mrn", "last_name", "city")


# ---- bundles and messages

def coded(c: Column) -> Column:
    return F.struct(F.array(F.struct(F.lit("http://codes").alias("system"), c.alias("code"))).alias("coding"), F.lit("Text").alias("text"))


def bundled(df: DataFrame, kind: str, patient: str, *fields: Column) -> DataFrame:
    one = F.struct(F.lit(kind).alias("resourceType"), F.struct(F.concat(F.lit("Patient/"), text(patient)).alias("reference")).alias("subject"), *fields)
    return fhir.resources(df.select(F.to_json(F.struct(F.array(F.struct(one.alias("resource"))).alias("entry"))).alias("value")))


def visit() -> Column:
    return F.struct(F.concat(F.lit("Encounter/"), text("encounter_id")).alias("reference")).alias("encounter")


@query(cte("diagnoses") + "select concat(encounter_id, '-', rank) as source_id, cast(patient_id as string) as patient_id, cast(encounter_id as string) as encounter_id, code, 'http://codes' as code_system, 'Text' as description, 'active' as clinical_status, date '2001-02-03' as onset_date from diagnoses")
def fhir_conditions(spark, sf_dir):
    d = raw(spark, sf_dir, "diagnoses")
    return fhir.conditions(bundled(d, "Condition", "patient_id", F.concat_ws("-", "encounter_id", "rank").alias("id"), visit(), coded(F.col("code")).alias("code"), coded(F.lit("active")).alias("clinicalStatus"), F.lit("2001-02-03T10:00:00+01:00").alias("onsetDateTime")))


@query(cte("procedures") + "select cast(encounter_id as string) as source_id, cast(patient_id as string) as patient_id, cast(encounter_id as string) as encounter_id, code, 'completed' as status, performed_date from procedures")
def fhir_procedures(spark, sf_dir):
    p = raw(spark, sf_dir, "procedures")
    at = F.date_format("performed_date", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    whole = F.col("encounter_id") % 2 == 0
    out = fhir.procedures(bundled(p, "Procedure", "patient_id", text("encounter_id").alias("id"), visit(), coded(F.col("code")).alias("code"), F.lit("completed").alias("status"), F.when(whole, at).alias("performedDateTime"), F.when(~whole, F.struct(at.alias("start"))).alias("performedPeriod")))
    return out.withColumn("performed_date", F.col("performed_date").cast("timestamp_ntz"))


@query(_LABV + " select cast(source_id as string) as source_id, cast(patient_id as string) as patient_id, 'laboratory' as category, 'C1' as code, 'Text' as test_name, v as value, case when v is null then value end as value_string, case when v is not null then 'mg' end as unit, 1.5 as reference_low, cast(null as double) as reference_high, interpretation, date_trunc('second', effective_date) as effective_date from l where source_id % 2 = 0")
def fhir_observations(spark, sf_dir):
    """Only those of the category asked for; numbers as quantities, other results as texts."""
    v = F.col("value").try_cast("double")
    category = F.when(F.col("source_id") % 2 == 0, "laboratory").otherwise("vital-signs")
    r = bundled(
        raw(spark, sf_dir, "labs", wide=True), "Observation", "patient_id", text("source_id").alias("id"), F.array(coded(category)).alias("category"), coded(F.lit("C1")).alias("code"), F.when(v.isNotNull(), F.struct(v.alias("value"), F.lit("mg").alias("unit"))).alias("valueQuantity"),
        F.when(v.isNull(), F.col("value")).alias("valueString"), F.array(coded(F.col("interpretation"))).alias("interpretation"), F.array(F.struct(F.struct(F.lit(1.5).alias("value")).alias("low"))).alias("referenceRange"), F.date_format("effective_date", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("effectiveDateTime"),
    )
    r = fhir.of_type(r, "Observation", category="laboratory")
    return fhir.observations(r).withColumn("effective_date", F.col("effective_date").cast("timestamp_ntz"))


@query(cte("medications") + "select concat(encounter_id, '-', line) as source_id, cast(line as string) as patient_id, cast(encounter_id as string) as encounter_id, medication_name, 'active' as status, frequency as dosage, route, cast(start_date as timestamp) as authored_date from medications")
def fhir_medications(spark, sf_dir):
    m = raw(spark, sf_dir, "medications", wide=True)
    dose = F.array(F.struct(F.col("frequency").alias("text"), coded(F.col("route")).alias("route")))
    out = fhir.medications(bundled(m, "MedicationRequest", "line", F.concat_ws("-", "encounter_id", "line").alias("id"), visit(), F.struct(F.col("medication_name").alias("text")).alias("medicationCodeableConcept"), F.lit("active").alias("status"), dose.alias("dosageInstruction"), text("start_date").alias("authoredOn")))
    return out.withColumn("authored_date", F.col("authored_date").cast("timestamp_ntz"))


def varied(spark, sf_dir) -> DataFrame:
    """Two messages to a text, with delimiters of their own in one of them: discharges of any class with two diagnoses, and
    results with a number and a text."""
    e = raw(spark, sf_dir, "encounters", wide=True)
    n, stamp = text("encounter_id"), F.date_format("admission_date", "yyyyMMddHHmmss")
    classes = pick(F.col("encounter_id"), *T.HL7_CLASS, "Z")
    adt = F.concat_ws("\r", F.concat(F.lit("MSH|@~\\&|ADM|H|L|H|"), stamp, F.lit("||ADT@A03|A"), n, F.lit("|P|2.5")), F.concat(F.lit("PID|1||"), text("patient_id"), F.lit("~second||Doe@Jo||19700102|"), pick(F.col("encounter_id"), *T.HL7_GENDER)), F.concat(F.lit("PV1|1|"), classes, F.lit("|"), F.col("department"), F.lit("@1|" + "|" * 15), n), F.lit("DG1|1||I10@One^two@X|||A"), F.lit("DG1|2||J44.1@Two|||F"))
    oru = F.concat_ws("\n", F.concat(F.lit("MSH|^~\\&|LAB|H|L|H|"), stamp, F.lit("||ORU^R01|R"), n, F.lit("|P|2.5")), F.concat(F.lit("PID|1||"), text("patient_id")), F.lit("OBR|1||||||20240101"), F.concat(F.lit("OBX|1|NM|GLU^Glucose||"), n, F.lit(".5|mg/dL||H||||||20240203040506")), F.lit("OBX|2|ST|NOTE^Note||fine @ rest|"))
    return hl7.headed(hl7.parsed(hl7.messages(e.select(F.concat(adt, F.lit("\r\n"), oru).alias("value")))))


@query(cte("encounters") + f"select concat('A', encounter_id) as control_id, cast(encounter_id as string) as encounter_id, cast(patient_id as string) as patient_id, {picked('encounter_id', *[*T.HL7_CLASS.values(), 'unknown'])} as encounter_type, department, 'finished' as status from encounters")
def hl7_discharges(spark, sf_dir):
    return hl7.encounters(varied(spark, sf_dir)).drop("admission_date", "discharge_date")


@query(cte("encounters") + "select concat('A', encounter_id) as control_id, cast(patient_id as string) as patient_id, cast(r as int) as rank, case when r = 1 then 'I10' else 'J44.1' end as code, case when r = 1 then 'One^two' else 'Two' end as description, case when r = 1 then 'A' else 'F' end as diagnosis_type from encounters, (values (1), (2)) t(r)")
def hl7_diagnosis_repeats(spark, sf_dir):
    return hl7.diagnoses(varied(spark, sf_dir))


@query(cte("encounters") + "select concat('R', encounter_id) as control_id, cast(patient_id as string) as patient_id, cast(r as int) as set_id, case when r = 1 then 'GLU' else 'NOTE' end as code, case when r = 1 then 'Glucose' else 'Note' end as test_name, case when r = 1 then encounter_id + 0.5 end as value, case when r = 2 then 'fine @ rest' end as value_string, case when r = 1 then 'mg/dL' end as unit, case when r = 1 then 'H' end as interpretation, case when r = 1 then timestamp '2024-02-03 04:05:06' else timestamp '2024-01-01 00:00:00' end as effective_date from encounters, (values (1), (2)) t(r)")
def hl7_results(spark, sf_dir):
    return hl7.observations(varied(spark, sf_dir)).withColumn("effective_date", F.col("effective_date").cast("timestamp_ntz"))


@query(cte("encounters") + f"select gender, count(*) as patients from (select {picked('encounter_id', *T.HL7_GENDER.values())} as gender from encounters) group by 1")
def hl7_genders(spark, sf_dir):
    return hl7.patients(varied(spark, sf_dir)).groupBy("gender").agg(F.count("*").alias("patients"))


# ---- streams

def census_of(spark, sf_dir, events: DataFrame, units: DataFrame) -> DataFrame:
    """The sums of the stream's steps by unit. The events come twice, in any order, in files of which a batch takes a quarter."""
    at, files = scratch.folder(spark, "moves"), 4 * max(2, spark.sparkContext.defaultParallelism)
    both = events.select(*[F.col(f.name).cast(f.dataType) for f in spark.createDataFrame([], streams.CENSUS_EVENT).schema.fields])
    both.unionByName(both).repartition(files, F.xxhash64("event_id", F.rand(7))).write.parquet(f"{at}/moves")
    steps = streams.live_census(spark.readStream.schema(streams.CENSUS_EVENT).option("maxFilesPerTrigger", files // 4).parquet(f"{at}/moves"), late="12000 days")
    store = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", streams.STATE_STORE)
    try:
        summed = streams.drained(steps, "steps", f"{at}/checkpoint", "append").groupBy("unit").agg(F.sum("step").alias("census"))
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", store)
    return units.join(summed, "unit", "left").select("unit", F.coalesce("census", F.lit(0)).alias("census"))


def census_events(e: DataFrame) -> DataFrame:
    """An admission and, where there is one, a discharge for each encounter."""
    event = lambda when, n, at, kind: e.where(when).select("encounter_id", (F.col("encounter_id") * 8 + n).alias("event_id"), F.col(at).alias("at"), F.lit(kind).alias("kind"), F.col("department").alias("unit"), F.lit(None).cast("long").alias("of"))
    return event(F.lit(True), 0, "admission_date", "admit").unionByName(event(F.col("discharge_date").isNotNull(), 1, "discharge_date", "discharge"))


@query(cte("encounters") + "select department as unit, count(*) - count(discharge_date) as census from encounters group by 1")
def live_census(spark, sf_dir):
    """Admissions and discharges as a stream of events; the steps that come of them add up to the batch result."""
    e = raw(spark, sf_dir, "encounters")
    return census_of(spark, sf_dir, census_events(e), e.select(F.col("department").alias("unit")).distinct())


@query(
    cte("encounters")
    + """, placed as (select case when encounter_id % 10 = 0 then 'STEP' else department end as unit, (discharge_date is null or encounter_id % 13 = 0) and not (encounter_id % 17 = 0 and encounter_id % 10 <> 0) as here from encounters)
select unit, count(case when here then 1 end) as census from placed group by 1"""
)
def live_census_corrected(spark, sf_dir):
    """The same with moves, and with discharges and admissions that are taken back."""
    e = raw(spark, sf_dir, "encounters")
    events, id_ = census_events(e), F.col("encounter_id")
    moves = events.where("kind = 'admit' and encounter_id % 10 = 0").withColumns({"event_id": id_ * 8 + 2, "kind": F.lit("move"), "unit": F.lit("STEP")})
    taken_back = ((F.col("kind") == "discharge") & (id_ % 13 == 0)) | ((F.col("kind") == "admit") & (id_ % 17 == 0) & (id_ % 10 != 0))
    cancels = events.where(taken_back).withColumns({"of": F.col("event_id"), "event_id": F.col("event_id") + 4, "kind": F.lit("cancel")})
    units = e.select(F.when(id_ % 10 == 0, "STEP").otherwise(F.col("department")).alias("unit")).distinct()
    return census_of(spark, sf_dir, events.unionByName(moves).unionByName(cancels), units)


@query(cte("encounters") + "select concat('C', encounter_id) as control_id, cast(patient_id as string) as patient_id from encounters")
def hl7_stream(spark, sf_dir):
    """Messages that land twice in a folder, taken in once."""
    e, at = raw(spark, sf_dir, "encounters"), scratch.folder(spark, "landing")
    message = F.concat(F.lit("MSH|^~\\&|ADM|H|L|H|20240101120000||ADT^A01|C"), text("encounter_id"), F.lit("|P|2.5\rPID|1||"), text("patient_id"), F.lit("\r"))
    both = e.select(message.alias("value")).unionByName(e.select(message.alias("value")))
    both.repartition(16).write.option("lineSep", "\n").text(f"{at}/in.hl7")
    taken = streams.hl7_intake(spark, at).select("control_id", hl7.field(hl7.segment("PID"), 3).alias("patient_id"))
    return streams.drained(taken, "intake", f"{at}/checkpoint", "append")


# ---- loads

_ROWS = "o_orderkey, o_orderstatus, o_totalprice"


@query("select o_orderkey, case when o_orderkey % 16 = 3 then 'X' else o_orderstatus end as status, o_totalprice from orders where o_orderkey % 2 = 0 or o_orderkey % 16 in (3, 5)")
def upsert_by_bucket(spark, sf_dir):
    """A table in buckets of its key, of which a load writes those that it touches."""
    rows, at = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), "o_totalprice"), scratch.folder(spark, "orders")
    versioned.create(rows.where("o_orderkey % 2 = 0 or o_orderkey % 16 = 3"), at, ["o_orderkey"], 8)
    versioned.upsert(rows.where("o_orderkey % 16 = 3").withColumns({"status": F.lit("X"), "at": F.lit(1), "unknown": F.lit("goes")}), at, ["o_orderkey"], "at", 8)
    versioned.upsert(rows.where("o_orderkey % 16 = 5").withColumn("at", F.lit(1)), at, ["o_orderkey"], "at", 8)
    return versioned.current(spark, at)


@query("select event_id, user_id, ts from events")
def load_in_two_steps(spark, sf_dir):
    """Events loaded up to a time and then as a whole, by the mark and a lookback, into one table."""
    e, at, marks = table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), scratch.folder(spark, "events"), scratch.folder(spark, "marks")
    for rows in (e.where("ts < timestamp_ntz '2024-01-15 00:00:00'"), e, e):
        loads.incremental_load(rows, at, marks, "events", "event", ["event_id"], ["ts"])
    return loads.current(spark, at)


@query("select c_custkey as patient_id, c_name as last_name, cast(null as string) as segment from customer union all select c_custkey, c_name, null from customer where c_custkey % 2 = 0")
def append_known_columns(spark, sf_dir):
    c, at = table(spark, sf_dir, "customer"), scratch.folder(spark, "people")
    shape = spark.createDataFrame([], f"patient_id {dict(c.dtypes)['c_custkey']}, last_name string, segment string").schema
    rows = c.select(F.col("c_custkey").alias("patient_id"), F.col("c_name").alias("last_name"), F.lit(1).alias("unknown"))
    loads.create(spark, at, shape)
    loads.append(rows, at, shape)
    loads.append(rows.where("patient_id % 2 = 0"), at, shape)
    return spark.read.parquet(at)


@query("select 'hospital' as source_system, event_type as entity_type, case when event_type = 'view' then timestamp '2020-01-01 00:00:00' else max(ts) end as last_value from events where event_type <> 'click' group by 2")
def watermark_reset(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    marks = e.groupBy(F.lit("hospital").alias("source_system"), F.col("event_type").alias("entity_type")).agg(F.max("ts").alias("last_value"))
    return loads.marks_of(loads.reset(loads.forgotten(marks, "hospital", "click"), "hospital", "view", "2020-01-01 00:00:00"), "hospital")


# ---- the star

def people(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("patient_id"), F.col("c_mktsegment").alias("segment"))
    day = lambda x: F.lit(x).cast("date")
    dim = c.where("patient_id % 7 <> 0").withColumns({"effective_date": day("2020-01-01"), "expiration_date": day(None), "is_current": F.lit(True)})
    return loads.scd2(dim, c.withColumn("segment", F.when(F.col("patient_id") % 3 == 0, "new").otherwise(F.col("segment"))).where("patient_id % 7 <> 0"), "patient_id", ["segment"], "2021-01-01")


_KEY = "concat(patient_id, '@', case when patient_id % 3 = 0 then '20210101' else '20200101' end)"


@query(
    ENC
    + f""", g as (select *, floor(epoch(admission_date - lag(discharge_date) over (partition by patient_id order by admission_date nulls first, encounter_id)) / 86400.0) as d from enc)
select encounter_id, {_KEY} as patient_key, cast(strftime(admission_date, '%Y%m%d') as int) as admission_date_key, cast(strftime(discharge_date, '%Y%m%d') as int) as discharge_date_key, encounter_type, discharge_disposition, los_hours, los_days,
  coalesce(n, 0) as diagnosis_count, coalesce(n, 0) as procedure_count, total_charges, coalesce(d > 0 and d <= 30, false) as is_readmission, cast(d as bigint) as days_since_discharge, is_emergency as is_ed_visit, encounter_id % 4 = 0 and is_inpatient as was_admitted_from_ed
from g left join (select l_orderkey, count(*) as n from lineitem group by 1) on l_orderkey = encounter_id where patient_id % 7 <> 0"""
)
def fact_encounters(spark, sf_dir):
    """Built once, and then loaded again over itself."""
    e = std_encounters(spark, sf_dir).withColumn("admit_source", F.when(F.col("encounter_id") % 4 == 0, "emergency"))
    new = star.fact_encounters(e, people(spark, sf_dir), raw(spark, sf_dir, "diagnoses"), raw(spark, sf_dir, "procedures"))
    old = new.where("encounter_id % 2 = 0").withColumn("total_charges", F.lit(0.0))
    return star.loaded_facts(old, new)


@query(DX + f"select {_KEY} as patient_key, cast(20010131 as int) as diagnosis_date_key, encounter_id, c as code, rank from d1 where patient_id % 7 <> 0 union all select null, cast(20010131 as int), encounter_id, c, rank from d1 where patient_id % 7 = 0")
def fact_diagnoses(spark, sf_dir):
    d = standardise.split(standardise.diagnoses(raw(spark, sf_dir, "diagnoses")))[0].withColumn("onset", F.lit("2001-01-31").cast("date"))
    return star.fact_rows(d, people(spark, sf_dir), "onset", "diagnosis_date_key", ["encounter_id", "code", "rank"])


@query("select p_partkey as code, p_name as description, cast(max(l_shipdate) as timestamp) as seen from lineitem join part on p_partkey = l_partkey group by 1, 2")
def dim_procedure(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey")).select(F.col("p_partkey").alias("code"), F.col("p_name").alias("description"), F.col("l_shipdate").cast("timestamp_ntz").alias("seen"), F.col("l_shipdate").alias("by"))
    return star.type1(rows, "code", ["description", "seen"], "by")


@query("with d as (select distinct cast(o_orderdate as date) as d from orders union select cast(unnest(generate_series(date '2000-08-01', date '2003-08-01', interval 1 day)) as date)) select cast(strftime(d, '%Y%m%d') as int) as date_key, d as full_date, dayname(d) as day_name, isodow(d) >= 6 as is_weekend from d")
def dim_date_rolling(spark, sf_dir):
    seen = dates.calendar(table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct())
    return star.rolling_dates(seen.select("date_key", "full_date", "day_name", "is_weekend"), AS_OF)


# ---- checks and protected information

@query(
    cte("encounters").rstrip() + ", " + cte("patients")[5:].rstrip() + ", " + cte("diagnoses")[5:]
    + f"""select 'orphaned_encounters' as "check", count(*) as count, 'warning' as severity from encounters where patient_id not in (select patient_id from patients where patient_id % 10 <> 0)
union all select 'duplicate_mrns', count(*), 'warning' from (select mrn from (select case when patient_id % 5 = 1 then 'same' else mrn end as mrn from patients where patient_id % 10 <> 0) group by 1 having count(*) > 1)
union all select 'future_dates', count(*), 'warning' from encounters where admission_date > timestamp '{AS_OF} 00:00:00' - interval 10 day + interval 1 day
union all select 'required_fields_encounters', count(*), 'error' from encounters where admission_date >= date '{AS_OF}' - 11 and encounter_id % 13 = 0
union all select 'invalid_icd_codes', count(*), 'warning' from diagnoses where not regexp_matches(code, '^[A-Z][0-9]{{2}}(\\.[0-9A-Z]{{0,4}})?$')"""
)
def table_issues(spark, sf_dir):
    as_of = "2001-07-22"
    e = raw(spark, sf_dir, "encounters").withColumn("created_at", F.col("admission_date")).withColumn("encounter_type", F.when(F.col("encounter_id") % 13 != 0, F.col("encounter_type")))
    p = raw(spark, sf_dir, "patients").where("patient_id % 10 <> 0").withColumn("mrn", F.when(F.col("patient_id") % 5 == 1, "same").otherwise(F.col("mrn")))
    return rules.issues(e, p, raw(spark, sf_dir, "diagnoses"), as_of)


@query(cte("patients") + "select patient_id, 'valid_mrn_format' as rule, 'error' as severity from patients where patient_id % 11 = 0 union all select patient_id, 'valid_dob', 'error' from patients where date_of_birth > date '2001-08-01' or patient_id % 13 = 0 union all select patient_id, 'reasonable_dob', 'warning' from patients where patient_id % 13 = 0 or (date_of_birth <= date '2001-08-01' and patient_id % 17 = 0) union all select patient_id, 'valid_gender', 'warning' from patients where lower(gender) not in ('male', 'female', 'other', 'unknown', 'm', 'f', 'o', 'u')")
def patient_rule_violations(spark, sf_dir):
    n = F.col("patient_id")
    born = F.when(n % 13 == 0, "soon").when((n % 17 == 0) & (F.col("date_of_birth") <= "2001-08-01"), "1801-01-01").otherwise(text("date_of_birth"))
    p = raw(spark, sf_dir, "patients").withColumns({"mrn": F.when(n % 11 == 0, " ").otherwise(F.col("mrn")), "date_of_birth": born})
    return rules.violations(p, rules.standard_rules("patient", AS_OF), "patient_id")


@query(cte("encounters") + "select encounter_id, 'valid_encounter_dates' as rule, 'error' as severity from encounters where discharge_date is not null and encounter_id % 10 = 3 union all select encounter_id, 'reasonable_los', 'warning' from encounters where discharge_date is not null and encounter_id % 10 = 4")
def encounter_rule_violations(spark, sf_dir):
    n, end = F.col("encounter_id"), F.col("discharge_date")
    moved = F.when(n % 10 == 3, F.col("admission_date") - F.make_interval(hours=F.lit(1))).when(n % 10 == 4, end + F.make_interval(days=F.lit(400))).otherwise(end)
    e = raw(spark, sf_dir, "encounters").withColumn("discharge_date", F.when(end.isNotNull(), moved))
    return rules.violations(e, rules.standard_rules("encounter", AS_OF), "encounter_id")


def messages_with_contacts(spark, sf_dir) -> DataFrame:
    """Conversations of which some turns hold a number, and each one's contacts as an array of structs and a map."""
    n = F.col("conv_id")
    said = F.when(n % 5 == 0, F.concat(F.col("text"), F.lit(" ssn: 123-45-6789"))).otherwise(F.lit("nothing"))
    contact = F.array(F.struct(F.lit("x").alias("kind"), F.when(n % 7 == 0, "mail a.b@example.org").otherwise("none").alias("value")))
    return table(spark, sf_dir, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("id"), said.alias("said"), contact.alias("contacts"), F.create_map(F.lit("note"), F.when(n % 3 == 0, "at 10.0.0.1").otherwise("-")).alias("more"), F.struct(F.concat(F.lit("P"), n).alias("first_name"), n.alias("size")).alias("who"))


_CONV = "with c as (select concat(conv_id, '-', turn) as id, conv_id as n from conversations) "


@query(_CONV + "select id, 'contacts.value' as field, 'email' as kind from c where n % 7 = 0 union all select id, 'more', 'ip_address' from c where n % 3 = 0")
def phi_nested(spark, sf_dir):
    df = messages_with_contacts(spark, sf_dir).select("id", "contacts", "more")
    return phi.scan(df, "id").select("id", "field", "kind")


@query(_CONV + "select count(*) as records_scanned, count(case when n % 7 = 0 or n % 3 = 0 then 1 end) as records_with_findings, count(case when n % 7 = 0 then 1 end) + count(case when n % 3 = 0 then 1 end) as findings, round(count(case when n % 7 = 0 or n % 3 = 0 then 1 end) / count(*) * 100, 2) as rate_pct from c")
def phi_batch(spark, sf_dir):
    return phi.batch_summary(messages_with_contacts(spark, sf_dir).select("id", "contacts", "more"), "id").drop("by_kind", "by_field")


@query(_CONV + "select 'email' as kind, 'contacts.value' as field, count(case when n % 7 = 0 then 1 end) as of_kind, count(case when n % 7 = 0 then 1 end) as in_field from c union all select 'ip_address', 'more', count(case when n % 3 = 0 then 1 end), count(case when n % 3 = 0 then 1 end) from c")
def phi_batch_totals(spark, sf_dir):
    """The summary's totals by kind and by field."""
    one = phi.batch_summary(messages_with_contacts(spark, sf_dir).select("id", "contacts", "more"), "id")
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(f).alias("field"), F.element_at("by_kind", F.lit(k)).alias("of_kind"), F.element_at("by_field", F.lit(f)).alias("in_field")) for k, f in (("email", "contacts.value"), ("ip_address", "more"))])
    return one.select(F.explode(pairs).alias("p")).select("p.*")


@query("select least(count(*), 500) as records_scanned from conversations")
def phi_batch_sample(spark, sf_dir):
    """The summary of 500 records."""
    return phi.batch_summary(messages_with_contacts(spark, sf_dir).select("id", "contacts", "more"), "id", sample=500).select("records_scanned")


@query("select concat(conv_id, '-', turn) as id, '[REDACTED]' as deep, conv_id as kept, '[REDACTED]' as listed, cast(null as bigint) as number, case when turn = 0 then '[REDACTED]' else 'see note' end as street from conversations")
def redacted_nested(spark, sf_dir):
    """What lies under a listed name in maps of structs and of arrays, and under a struct of such a name, is gone."""
    n = F.col("conv_id")
    who = F.create_map(F.lit("contact"), F.struct(F.concat(F.lit("S"), n).alias("ssn"), n.alias("size")), F.lit("Email"), F.struct(F.lit("x").alias("ssn"), n.alias("size")))
    lists = F.create_map(F.lit("mrn"), F.array(F.concat(F.lit("M"), n)), F.lit("notes"), F.array(F.lit("see note")))
    place = F.create_map(F.when(F.col("turn") == 0, "address").otherwise("place"), F.array(F.struct(F.lit("see note").alias("street"))))
    df = table(spark, sf_dir, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("id"), who.alias("who"), lists.alias("lists"), place.alias("at"))
    r = phi.redacted_by_name(df)
    first = lambda m: F.get(F.get(F.map_values(m), F.lit(0)), F.lit(0))
    return r.select("id", F.col("who")["contact"]["ssn"].alias("deep"), F.col("who")["contact"]["size"].alias("kept"), F.get(F.col("lists")["mrn"], F.lit(0)).alias("listed"), F.col("who")["Email"]["size"].alias("number"), first("at")["street"].alias("street"))


@query(_CONV + "select id, '[REDACTED]' as first_name, n as size, case when n % 5 <> 0 then 'nothing' end as said, n % 5 <> 0 as safe from c")
def redacted_log(spark, sf_dir):
    """Names are replaced at any depth, and texts with findings are told apart from those that are safe to log."""
    df = messages_with_contacts(spark, sf_dir)
    safe = phi.safe_to_log(df, ["said"])
    return phi.redacted_by_name(df.withColumn("safe", safe)).select("id", "who.first_name", "who.size", F.when(F.col("safe"), F.col("said")).alias("said"), "safe")


@query(_CONV + "select id, '1234****' as seen, 'call ([REDACTED] or [REDACTED]' as cleaned from c")
def redacted_text(spark, sf_dir):
    df = messages_with_contacts(spark, sf_dir).select("id", F.lit("12345678").alias("code"), F.lit("call (555) 123-4567 or a.b@example.org").alias("cleaned"))
    return phi.redacted(df, ["cleaned"]).select("id", phi.preview(F.col("code")).alias("seen"), "cleaned")


@query(cte("patients") + "select kind, field, count(*) as findings from (select unnest([{'kind': 'mrn', 'field': 'mrn'}, {'kind': 'name', 'field': 'last_name'}, {'kind': 'name', 'field': 'note'}], recursive := true) from patients) group by 1, 2 having kind <> ''")
def phi_by_field_name(spark, sf_dir):
    """Findings by the names of fields, and, with high sensitivity, by texts that look like names."""
    p = raw(spark, sf_dir, "patients").select("patient_id", F.lit("x").alias("mrn"), F.lit("y").alias("last_name"), F.lit("Jo Ann Doe").alias("note"))
    return phi.scan(p, "patient_id", high=True).groupBy("kind", "field").agg(F.count("*").alias("findings"))
