"""Clinical records derived from the driver's tables, as one SELECT each for Spark and for DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from wardlake.sources.relational import read_parquet

PATIENTS = """
select c_custkey as patient_id, concat('FAKE-', lpad(cast(c_custkey as string), 6, '0')) as mrn,
  case c_custkey % 4 when 0 then 'ALICE' when 1 then '  bob ' when 2 then 'McKay' else 'o''brien-smith' end as first_name, c_name as last_name,
  case c_custkey % 7 when 0 then 'M' when 1 then 'f' when 2 then 'MALE' when 3 then 'nb' when 4 then '' when 5 then 'X' else null end as gender,
  date '1930-01-01' + cast((c_custkey * 37) % 30000 as int) as date_of_birth,
  case c_nationkey % 4 when 0 then 'California' when 1 then 'ny' when 2 then 'Puerto Rico' else ' TX ' end as state,
  cast((c_custkey * 7919) % 100000 as string) as postal_code,
  case when c_custkey % 3 = 0 then concat('1', lpad(cast((c_custkey * 104729) % 10000000000 as string), 10, '0')) else lpad(cast((c_custkey * 104729) % 10000000000 as string), 10, '0') end as phone,
  case when c_custkey % 5 = 0 then 'none' else concat(' User', cast(c_custkey as string), '@Example.COM') end as email,
  lpad(cast((c_custkey * 15485863) % 1000000000 as string), 9, '0') as ssn,
  case c_custkey % 5 when 0 then 'M' when 1 then 's' when 2 then 'WIDOWED' when 3 then 'Separated' else null end as marital_status
from {customer}"""
_ENCOUNTERS = """
select o_orderkey as encounter_id, o_custkey as patient_id,
  case o_orderpriority when '1-URGENT' then 'ER' when '2-HIGH' then 'IP' when '3-MEDIUM' then 'OBS' when '4-NOT SPECIFIED' then 'op' else 'amb' end as encounter_type,
  case o_orderstatus when 'F' then 'home' when 'O' then 'admitted' else 'lwbs' end as discharge_disposition,
  case o_orderkey % 5 when 0 then 'ICU' when 1 then 'MED' when 2 then 'SURG' when 3 then 'ED' else 'CARD' end as department,
  case (o_orderkey * 3) % 7 when 0 then 'I50.9' when 1 then 'J44.1' when 2 then 'J18.9' else 'I10' end as primary_diagnosis_code,
  cast(o_orderkey % 9 as string) as drg_code, o_totalprice as total_charges, {admit} as admission_date,
  case when o_orderkey % 21 = 0 and o_orderdate >= timestamp '2001-06-01 00:00:00' then null else {leave} end as discharge_date
from {{orders}}"""
_STAY = "o_orderkey % 24 + 4 + (o_orderkey * 7) % 200"
ENCOUNTERS = _ENCOUNTERS.format(admit="timestampadd(HOUR, cast(o_orderkey % 24 as int), o_orderdate)", leave=f"timestampadd(HOUR, cast({_STAY} as int), o_orderdate)")
ENCOUNTERS_DUCKDB = _ENCOUNTERS.format(admit="o_orderdate + to_hours(o_orderkey % 24)", leave=f"o_orderdate + to_hours({_STAY})")
DIAGNOSES = """
select l_orderkey as encounter_id, o_custkey as patient_id, l_linenumber as rank,
  case l_partkey % 12 when 0 then 'E11.9' when 1 then ' i10' when 2 then 'I50.9' when 3 then 'J441' when 4 then 'N18.3' when 5 then 'J18.9' when 6 then 'K92.2' when 7 then 'E1122' when 8 then 'I21.3'
    when 9 then 'C50.911' when 10 then '0DTJ4ZZ' else 'B20' end as code,
  case l_linenumber % 4 when 0 then 'P' when 1 then 'secondary' when 2 then 'discharge' else null end as diagnosis_type, case l_returnflag when 'R' then 'yes' when 'A' then '0' else 'W' end as present_on_admission
from {lineitem} join {orders} on l_orderkey = o_orderkey"""
PROCEDURES = """
select l_orderkey as encounter_id, o_custkey as patient_id,
  case l_suppkey % 6 when 0 then '99213' when 1 then '27447' when 2 then '33533' when 3 then 'J1885' when 4 then '0SRD0J9' else '8151' end as code,
  cast(l_quantity * 5 as int) as duration_minutes, l_shipdate as performed_date, l_extendedprice as charges
from {lineitem} join {orders} on l_orderkey = o_orderkey"""
MEDICATIONS = """
select l_orderkey as encounter_id, l_linenumber as line,
  case l_partkey % 8 when 0 then 'Warfarin 5 MG Oral Tablet' when 1 then 'Metformin 500mg' when 2 then 'Morphine 2 mg/mL' when 3 then 'Amoxicillin 500 MG Capsule' when 4 then 'Lorazepam 0.5mg'
    when 5 then 'Insulin Lispro 100 units' when 6 then 'Acetaminophen 500 MG' else 'Potassium Chloride 20 mEq' end as medication_name,
  case l_linenumber % 4 when 0 then 'PO' when 1 then 'iv' when 2 then 'SubQ' else 'drip' end as route,
  case l_suppkey % 5 when 0 then 'BID' when 1 then 'q6h prn' when 2 then 'twice daily' when 3 then 'every 8 hours as needed' else 'weekly' end as frequency,
  cast(l_shipdate as date) as start_date, cast(l_shipdate as date) + cast(l_quantity as int) as end_date
from {lineitem}"""
LABS = """
select event_id as source_id, user_id as patient_id, ts as effective_date,
  case event_type when 'purchase' then 'Glucose' when 'view' then 'Potassium' when 'click' then 'Hemoglobin' when 'signup' then 'PCO2 arterial' else 'Widget' end as test_name,
  case event_id % 5 when 0 then concat('<', cast(event_id % 50 as string)) when 1 then concat(cast(event_id % 90 as string), '%') when 2 then 'Negative' when 3 then ' 7.5 ' else cast(event_id % 400 as string) end as value,
  case event_id % 4 when 0 then 'H' when 1 then 'critical low' when 2 then 'N' else null end as interpretation
from {events}"""
VITALS = """
select event_id as source_id, user_id as patient_id, ts as recorded_date, cast(30 + event_id % 120 as double) as heart_rate, cast(6 + event_id % 26 as double) as respiratory_rate,
  cast(70 + (event_id * 7) % 150 as double) as systolic_bp, cast(40 + (event_id * 3) % 70 as double) as diastolic_bp,
  case when event_id % 3 = 0 then cast(35 + event_id % 6 as double) else cast(94 + event_id % 10 as double) end as temperature,
  cast(85 + event_id % 16 as double) as oxygen_saturation, case when event_id % 9 = 0 then 'nasal cannula' else null end as oxygen_device,
  cast(50 + event_id % 60 as double) as weight, cast(150 + event_id % 45 as double) as height
from {events}"""
ED_HOURLY = """
select cast(ts as date) as metric_date, cast(hour(ts) as int) as metric_hour, concat('FAC-', cast(user_id % 3 as string)) as facility, count(*) as arrivals,
  count(case when event_type = 'purchase' then 1 end) as admitted, count(case when event_type = 'view' then 1 end) as discharged, count(case when event_type = 'error' then 1 end) as left_without_seen,
  avg(value) as avg_door_to_provider, max(value) as p_max
from {events} group by cast(ts as date), hour(ts), user_id % 3"""
LOCATIONS = """
select n_nationkey as location_key, n_name as unit, concat('FAC-', cast(n_regionkey as string)) as facility_name,
  case n_nationkey % 4 when 0 then 'ICU' when 1 then 'Med-Surg' when 2 then 'Step-Down' else 'Clinic' end as location_type,
  case n_regionkey when 0 then 'Cardiology' when 1 then 'Medical' else 'Surgical' end as service_line, cast(n_nationkey * 3 as int) as operational_beds, cast(n_nationkey * 3 + 2 as int) as licensed_beds
from {nation}"""
ARRIVALS = """
select ts as arrived, concat('FAC-', cast(user_id % 3 as string)) as facility, case event_id % 2 when 0 then 'Main' else 'Fast track' end as ed_location, event_id % 60 + 5 as wait_minutes, event_id * 13 % 400 + 60 as stay_minutes,
  case event_type when 'purchase' then 'admitted' when 'view' then 'discharged' when 'click' then 'transferred' when 'signup' then 'ama' else 'lwbs' end as disposition, event_id % 5 + 1 as esi
from {events}"""
OBSERVED = """
select cast(ts as date) as metric_date, concat('FAC-', cast(user_id % 3 as string)) as facility, value as amount,
  case event_type when 'purchase' then 'CAUTI' when 'view' then 'CLABSI' when 'click' then 'FALLS' when 'signup' then 'PRESSURE_INJ' else 'READM-30' end as indicator_code,
  case event_type when 'purchase' then 'Catheter infections' when 'view' then 'Central line infections' when 'click' then 'Falls' when 'signup' then 'Pressure injuries' else 'Readmissions in 30 days' end as indicator_name,
  case event_type when 'purchase' then 'infection' when 'view' then 'infection' when 'error' then 'outcome' else 'safety' end as indicator_category
from {events}"""

SPARK = {"patients": PATIENTS, "encounters": ENCOUNTERS, "diagnoses": DIAGNOSES, "procedures": PROCEDURES, "medications": MEDICATIONS, "labs": LABS, "vitals": VITALS, "ed_hourly": ED_HOURLY, "locations": LOCATIONS, "arrivals": ARRIVALS, "observed": OBSERVED}
DUCKDB = SPARK | {"encounters": ENCOUNTERS_DUCKDB}


def raw(spark: SparkSession, sf_dir: str, name: str, wide: bool = False) -> DataFrame:
    """The records of one kind. For wide work the table that they are made from row by row is dealt out if it is small."""
    text = SPARK[name]
    found = re.findall(r"\{(\w+)\}", text)
    return spark.sql(text, **{t: read_parquet(spark, f"{sf_dir}/{t}.parquet", wide=wide and t == found[0]) for t in found})


def cte(*names: str) -> str:
    """`with a as (...), ...` for the oracle."""
    return "with " + ", ".join(f"{n} as ({re.sub(r'[{}]', '', DUCKDB[n])})" for n in names) + "\n"
