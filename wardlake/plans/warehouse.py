"""Queries of the star's other dimensions and facts, of counts of loads and of written dates, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardlake.functions import dates
from wardlake.operators import loads, phi, standardise, star, summaries
from wardlake.plans.catalogue import AS_OF, ENC, ORACLE_SQL, QUERIES, query, std, std_encounters, table
from wardlake.plans.fixtures import cte, raw
from wardlake.plans.intake import _KEY, people
from wardlake.sources import scratch

__all__ = ["ORACLE_SQL", "QUERIES"]


def _fact(name: str, day: str, key: str, columns: str) -> str:
    """SQL of a fact table: _KEY for the patients that the dimension has (six in seven of the customers)."""
    return cte(name) + f"""select case when patient_id % 7 <> 0 and patient_id in (select c_custkey from customer) then {_KEY} end as patient_key, cast(strftime({day}, '%Y%m%d') as int) as {key}, {columns} from {name}"""


@query(_fact("procedures", "performed_date", "procedure_date_key", "encounter_id, trim(code) as code, charges"))
def fact_procedures(spark, sf_dir):
    p = std(spark, sf_dir, "procedures")
    return star.fact_rows(p, people(spark, sf_dir), "performed_date", "procedure_date_key", ["encounter_id", "code", "charges"])


@query(_fact("labs", "effective_date", "lab_date_key", "source_id, test_name"))
def fact_labs(spark, sf_dir):
    return star.fact_rows(std(spark, sf_dir, "labs"), people(spark, sf_dir), "effective_date", "lab_date_key", ["source_id", "test_name"])


@query(_fact("vitals", "recorded_date", "vital_date_key", "source_id, heart_rate, oxygen_saturation"))
def fact_vitals(spark, sf_dir):
    return star.fact_rows(raw(spark, sf_dir, "vitals"), people(spark, sf_dir), "recorded_date", "vital_date_key", ["source_id", "heart_rate", "oxygen_saturation"])


@query(
    cte("medications", "encounters")
    + f"""select case when patient_id % 7 <> 0 then {_KEY} end as patient_key, cast(strftime(start_date, '%Y%m%d') as int) as start_date_key, encounter_id, line, medication_name
from medications join (select encounter_id, patient_id from encounters) using (encounter_id)"""
)
def fact_medications(spark, sf_dir):
    m = raw(spark, sf_dir, "medications").join(raw(spark, sf_dir, "encounters").select("encounter_id", "patient_id"), "encounter_id")
    return star.fact_rows(m, people(spark, sf_dir), "start_date", "start_date_key", ["encounter_id", "line", "medication_name"])


@query(cte("diagnoses") + "select replace(upper(trim(code)), '.', '') as code, max(encounter_id) as last_encounter from diagnoses group by 1")
def dim_diagnosis(spark, sf_dir):
    d = std(spark, sf_dir, "diagnoses").withColumn("last_encounter", F.col("encounter_id"))
    return star.type1(d, "code", ["last_encounter"], "encounter_id")


@query(cte("medications") + "select medication_name, max(start_date) as last_start from medications group by 1")
def dim_medication(spark, sf_dir):
    m = raw(spark, sf_dir, "medications").withColumn("last_start", F.col("start_date"))
    return star.type1(m, "medication_name", ["last_start"], "start_date")


@query("select s_suppkey as provider_id, n_name as location, r_name as facility from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey")
def dim_provider(spark, sf_dir):
    """Each provider's newest place, of two versions."""
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    new = s.select(F.col("s_suppkey").alias("provider_id"), F.col("n_name").alias("location"), F.col("r_name").alias("facility"), F.lit(2).alias("version"))
    return star.type1(new.unionByName(new.withColumns({"location": F.lit("moved"), "version": F.lit(1)})), "provider_id", ["location", "facility"], "version")


# ---- loads

@query(
    cte("encounters").rstrip() + ", " + cte("patients")[5:]
    + """select 'encounters' as source, count(*) as extracted, count(case when encounter_id % 13 <> 0 then 1 end) as loaded, count(case when encounter_id % 13 = 0 then 1 end) as failed, 0 as phi_warnings, false as broken, count(case when encounter_id % 13 <> 0 then 1 end) as stored from encounters
union all select 'missing', 0, 0, 0, 0, true, 0
union all select 'patients', count(*), count(*), 0, count(case when contains(email, '@') then 1 end), false, count(*) from patients"""
)
def load_counts(spark, sf_dir):
    """Three sources, of which one cannot be read; stored: the rows that the folders hold afterwards."""
    folder = scratch.folder(spark, "load_counts")
    e = raw(spark, sf_dir, "encounters").withColumn("encounter_id", F.when(F.col("encounter_id") % 13 != 0, F.col("encounter_id")))
    sources = {"missing": lambda: spark.read.parquet(f"{folder}/nothing"), "encounters": lambda: standardise.encounters(e), "patients": lambda: standardise.patients(raw(spark, sf_dir, "patients"), AS_OF)}
    counts = loads.load_sources(spark, sources, folder, {"patients": lambda df: ~phi.safe_to_log(df, ["email", "first_name"])})
    stored = None
    for name in ("encounters", "patients"):
        n = loads.current(spark, f"{folder}/{name}").agg(F.count("*").alias("stored")).withColumn("source", F.lit(name))
        stored = n if stored is None else stored.unionByName(n)
    return counts.join(F.broadcast(stored), "source", "left").select("source", "extracted", "loaded", "failed", "phi_warnings", F.col("error").isNotNull().alias("broken"), F.coalesce("stored", F.lit(0)).alias("stored"))


@query(ENC + "select department, cast(sum(n) as bigint) as total, concat('{', string_agg(concat('\"', k, '\":', n), ',' order by k), '}') as dispositions from (select department, coalesce(discharge_disposition, 'unknown') as k, count(*) as n from enc where is_emergency and is_completed group by 1, 2) group by 1")
def disposition_maps(spark, sf_dir):
    e = std_encounters(spark, sf_dir).where("is_emergency and is_completed")
    return summaries.counts_as_map(e, ["department"], "discharge_disposition").select("department", "total", F.to_json("counts").alias("dispositions"))


# ---- dates as people write them

@query("select o_orderkey, case when o_orderkey % 11 = 10 then date '1900-01-01' else cast(o_orderdate as date) end as day from orders")
def written_dates(spark, sf_dir):
    """Order dates written in ten ways, and read again; what is no date becomes the default."""
    o, d, n = table(spark, sf_dir, "orders"), F.col("o_orderdate"), F.col("o_orderkey") % 11
    forms = ["yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd HH:mm:ss'+01:00'", "MM/dd/yyyy", "M/d/yy", "MM-dd-yyyy", "yyyyMMdd", "MMMM d, yyyy", "MMM d, yyyy", " yyyy-MM-dd'T'HH:mm:ss "]
    text = F.lit("soon")
    for k, form in enumerate(forms):
        text = F.when(n == k, F.date_format(d, form)).otherwise(text)
    return o.select("o_orderkey", dates.written_date(text, F.lit("1900-01-01")).alias("day"))
