"""Queries of what arrives from files, servers, messages, catalogs and streams, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardlake.functions import tables as T
from wardlake.operators import loads, standardise
from wardlake.plans import oracle as o
from wardlake.plans.catalogue import ORACLE_SQL, QUERIES, query, table
from wardlake.plans.fixtures import cte, raw
from wardlake.plans.intake import coded, picked, text, varied
from wardlake.sources import audit, fhir, flat, hl7, relational, scratch
from wardlake.streaming import streams

__all__ = ["ORACLE_SQL", "QUERIES"]


# ---- files


@query(
    """select cast(event_id as varchar) as source_id, event_type as value, true as fits, true as imported from events where event_id % 9 <> 4
union all select cast(event_id as varchar), null, false, null from events where event_id % 9 = 4"""
)
def csv_quarantine(spark, sf_dir):
    """Results of which every ninth line has a field too many: the others with their file and time of import, those with theirs."""
    at, n = scratch.folder(spark, "labs"), F.col("event_id")
    line = F.concat_ws(",", n, F.col("event_type"), F.when(n % 9 == 4, "more"))
    rows = table(spark, sf_dir, "events").groupBy((n % 12).alias("file")).agg(F.array_sort(F.collect_list(line)).alias("lines"))
    rows.select(F.concat(F.lit("Result ID,Value\n"), F.array_join("lines", "\n")).alias("value"), "file").write.partitionBy("file").text(f"{at}/labs.csv")
    good, bad = flat.quarantined(flat.read(spark, at, "labs").cache())
    named = lambda c: F.col(c).endswith(".txt")
    fits = flat.canonical(good, "labs").where(named("_source_file")).select("source_id", "value", F.lit(True).alias("fits"), F.col("_import_timestamp").isNotNull().alias("imported"))
    return fits.unionByName(bad.where(named("_source_file")).select(F.substring_index("_corrupt", ",", 1).alias("source_id"), F.lit(None).cast("string").alias("value"), F.lit(False).alias("fits"), F.lit(None).cast("boolean").alias("imported")))


@query("select cast(c_custkey as varchar) as id, c_mktsegment as segment, 1 as times from customer")
def csv_archived(spark, sf_dir):
    """Files taken in as a stream and moved away; what lands again later is read, what was moved is not."""
    at, n = scratch.folder(spark, "people"), F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(n.cast("string").alias("id"), F.col("c_mktsegment").alias("segment"))
    for half in (0, 1):
        rows.where(F.col("id").cast("long") % 2 == half).coalesce(1).write.mode("append").csv(f"{at}/in", header=True)
        stream = flat.arriving(spark, f"{at}/in", None, ["id", "segment"], f"{at}/done")
        taken = streams.drained(stream, "people", f"{at}/checkpoint", "append")
    return taken.groupBy("id", "segment").agg(F.count("*").cast("int").alias("times"))


@query("select o_orderkey, case when o_orderkey % 5 = 0 then date_trunc('day', o_orderdate) when o_orderkey % 24 * 100 + o_orderkey % 60 is not null then date_trunc('day', o_orderdate) + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60) end as at from orders")
def split_times(spark, sf_dir):
    """Days and clocks in columns of their own, the clock without leading zeros, or missing."""
    n = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(n, F.date_format("o_orderdate", "yyyyMMdd").alias("day"), F.when(n % 5 != 0, (n % 24 * 100 + n % 60).cast("string")).alias("clock"))
    return rows.select("o_orderkey", flat.joined_time(F.col("day"), F.col("clock")).cast("timestamp_ntz").alias("at"))


# ---- catalogs


@query("select cast(o_custkey as varchar) as source_id, 'M' || o_custkey as mrn, o_orderstatus as gender from orders where o_orderdate > timestamp '1999-01-01 00:00:00'")
def mapped_patients(spark, sf_dir):
    """Another known system's patients, changed after a time."""
    o_, null = table(spark, sf_dir, "orders"), F.lit(None).cast("string")
    named = {"PAT_ID": F.col("o_custkey").cast("string"), "PAT_MRN_ID": F.concat(F.lit("M"), F.col("o_custkey")), "SEX_C": F.col("o_orderstatus"), "UPDATE_DATE": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")}
    o_.select(*[named.get(c, null).alias(c) for c in ("PAT_ID", "PAT_MRN_ID", "PAT_FIRST_NAME", "PAT_LAST_NAME", "BIRTH_DATE", "SEX_C", "ADD_LINE_1", "CITY", "STATE_C", "ZIP", "HOME_PHONE", "EMAIL_ADDRESS", "UPDATE_DATE")]).createOrReplaceTempView("PATIENT")
    return relational.mapped_records(spark, "a_patients", "1999-01-01 00:00:00").select("source_id", "mrn", "gender")


@query("select cast(o_orderkey as varchar) as source_id, cast(o_custkey as varchar) as patient_id, o_orderpriority as encounter_type, o_orderdate as admission_date from orders where o_orderdate > timestamp '2000-06-01 00:00:00'")
def mapped_encounters(spark, sf_dir):
    null = F.lit(None).cast("string")
    named = {"PAT_ENC_CSN_ID": F.col("o_orderkey").cast("string"), "PAT_ID": F.col("o_custkey").cast("string"), "ENC_TYPE_C": F.col("o_orderpriority"), "HOSP_ADMSN_TIME": F.col("o_orderdate"), "UPDATE_DATE": F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")}
    table(spark, sf_dir, "orders").select(*[named.get(c, null).alias(c) for c in ("PAT_ENC_CSN_ID", "PAT_ID", "ENC_TYPE_C", "HOSP_ADMSN_TIME", "HOSP_DISCH_TIME", "DEPARTMENT_ID", "VISIT_PROV_ID", "UPDATE_DATE")]).createOrReplaceTempView("PAT_ENC")
    return relational.mapped_records(spark, "a_encounters", "2000-06-01 00:00:00").select("source_id", "patient_id", "encounter_type", F.col("admission_date").cast("timestamp_ntz").alias("admission_date"))


@query("select o_orderkey, o_custkey from orders where o_orderdate >= timestamp '2000-01-01 00:00:00' and o_custkey in (select c_custkey from customer where c_nationkey < 5)")
def catalog_since_and_ids(spark, sf_dir):
    """A catalog's table from a time on, for the ids of another; one that is not there has no rows."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("placed_orders")
    ids = table(spark, sf_dir, "customer").where("c_nationkey < 5").select(F.col("c_custkey").alias("o_custkey"))
    rows = relational.read_table(spark, "placed_orders", "2000-01-01 00:00:00", "o_orderdate", ids, "o_custkey").select("o_orderkey", "o_custkey")
    return rows.unionByName(relational.read_table(spark, "no_such_table", schema="o_orderkey long, o_custkey long"))


@query("select column_name as name, case column_type when 'BIGINT' then 'bigint' when 'VARCHAR' then 'string' when 'DOUBLE' then 'double' when 'INTEGER' then 'int' else 'timestamp_ntz' end as type, true as nullable, true as listed from (describe events)")
def catalog_columns(spark, sf_dir):
    """What the catalog tells of a table."""
    table(spark, sf_dir, "events").createOrReplaceTempView("landed_events")
    listed = relational.tables(spark).where("name = 'landed_events'").count() == 1
    return relational.columns(spark, "landed_events").withColumn("listed", F.lit(listed))


# ---- resources and messages


def _admissions(spark, sf_dir):
    """Encounters as resources that were last updated when their patient came, in one text each."""
    e = raw(spark, sf_dir, "encounters")
    one = F.struct(
        F.lit("Condition").alias("resourceType"), text("encounter_id").alias("id"), F.struct(F.date_format("admission_date", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("lastUpdated")).alias("meta"),
        F.struct(F.concat(F.lit("Patient/"), F.col("patient_id")).alias("reference")).alias("subject"), F.struct(F.concat(F.lit("Encounter/E"), F.col("encounter_id")).alias("reference")).alias("encounter"), coded(F.col("primary_diagnosis_code")).alias("code"),
    )
    return fhir.resources(e.select(F.to_json(F.struct(F.array(F.struct(one.alias("resource"))).alias("entry"))).alias("value")))


@query(
    cte("encounters")
    + """select 'since' as asked, cast(encounter_id as varchar) as source_id from encounters where admission_date >= timestamp '2000-01-01 00:00:00'
union all select 'ids', cast(encounter_id as varchar) from encounters where encounter_id in (1, 2, 3, 7)
union all select 'patients', cast(encounter_id as varchar) from encounters where patient_id in (1, 2, 4, 5)
union all select 'encounters', cast(encounter_id as varchar) from encounters where encounter_id in (3, 5) and admission_date >= timestamp '1990-01-01 00:00:00'"""
)
def fhir_changed(spark, sf_dir):
    """Resources changed since a time, by their ids, of some patients, and of some encounters."""
    r, out = _admissions(spark, sf_dir), None
    for asked, how in (("since", {"since": "2000-01-01 00:00:00"}), ("ids", {"ids": ["1", "2", "3", "7"]}), ("patients", {"patients": ["1", "2", "4", "5"]}), ("encounters", {"encounters": ["E3", "E5"], "since": "1990-01-01 00:00:00"})):
        rows = fhir.of_type(r, "Condition", **how).select(F.lit(asked).alias("asked"), F.col("r.id").alias("source_id"))
        out = rows if out is None else out.unionByName(rows)
    return out


_RACE, _ORIGIN = ("http://hl7.org/fhir/us/core/StructureDefinition/us-core-" + x for x in ("race", "ethnicity"))


@query(
    cte("patients")
    + """select cast(patient_id as varchar) as patient_id, mrn, ssn, first_name, last_name, date_of_birth, gender, '1 Main St' as address_line1, 'Town' as city, state, postal_code, phone, email, marital_status,
case when patient_id % 3 = 0 then 'R' || patient_id % 5 when patient_id % 3 = 1 then 'told' end as race, case when patient_id % 2 = 0 then 'O2' end as ethnicity, patient_id % 7 = 0 as deceased, case when patient_id % 7 = 0 then date '2001-02-03' end as deceased_date, case when patient_id % 4 = 0 then 'en' end as language from patients"""
)
def fhir_patients_in_full(spark, sf_dir):
    """Every column of a patient, with races as nested codes, as texts, or not told."""
    p, n = raw(spark, sf_dir, "patients"), F.col("patient_id")
    typed = lambda kind, v: F.struct(F.struct(F.array(F.struct(F.lit(kind).alias("code"))).alias("coding")).alias("type"), v.alias("value"))
    nested = F.array(F.struct(F.lit("other").alias("url"), F.struct(F.lit("no").alias("code")).alias("valueCoding")), F.struct(F.lit("ombCategory").alias("url"), F.struct(F.concat(F.lit("R"), n % 5).alias("code")).alias("valueCoding")))
    nested_type = "array<struct<url:string,valueCoding:struct<code:string>>>"
    extensions = F.array(
        F.struct(F.lit(_RACE).alias("url"), F.when(n % 3 == 1, "told").alias("valueString"), F.lit(None).cast("string").alias("valueCode"), F.when(n % 3 == 0, nested).alias("extension")),
        F.struct(F.lit(_ORIGIN).alias("url"), F.lit(None).cast("string").alias("valueString"), F.when(n % 2 == 0, "O2").alias("valueCode"), F.lit(None).cast(nested_type).alias("extension")),
    )
    one = F.struct(
        F.lit("Patient").alias("resourceType"), n.cast("string").alias("id"), F.array(typed("MR", F.col("mrn")), typed("SS", F.col("ssn"))).alias("identifier"), F.array(F.struct(F.col("last_name").alias("family"), F.array("first_name").alias("given"))).alias("name"),
        F.date_format("date_of_birth", "yyyy-MM-dd").alias("birthDate"), F.col("gender").alias("gender"), F.array(F.struct(F.array(F.lit("1 Main St")).alias("line"), F.lit("Town").alias("city"), F.col("state").alias("state"), F.col("postal_code").alias("postalCode"))).alias("address"),
        F.array(F.struct(F.lit("phone").alias("system"), F.col("phone").alias("value")), F.struct(F.lit("email").alias("system"), F.col("email").alias("value"))).alias("telecom"), coded(F.col("marital_status")).alias("maritalStatus"), extensions.alias("extension"),
        F.when(n % 7 == 0, True).alias("deceasedBoolean"), F.when(n % 7 == 0, "2001-02-03T04:05:06Z").alias("deceasedDateTime"), F.array(F.struct(coded(F.when(n % 4 == 0, "en")).alias("language"))).alias("communication"),
    )
    return fhir.patients(fhir.resources(p.select(F.to_json(F.struct(F.array(F.struct(one.alias("resource"))).alias("entry"))).alias("value"))))


@query(
    cte("encounters")
    + """select 'since' as asked, concat(k, encounter_id) as control_id from encounters, (values ('A'), ('R')) t(k) where date_trunc('second', admission_date) >= timestamp '2000-01-01 00:00:00'
union all select 'ids', concat(k, encounter_id) from encounters, (values ('A'), ('R')) t(k) where patient_id in (1, 2, 4)"""
)
def hl7_changed(spark, sf_dir):
    """Messages from a time on, and those of some patients."""
    m = varied(spark, sf_dir)
    since, ids = hl7.changed(m, "2000-01-01 00:00:00"), hl7.changed(m, ids=["1", "2", "4"])
    return since.select(F.lit("since").alias("asked"), "control_id").unionByName(ids.select(F.lit("ids").alias("asked"), "control_id"))


@query(cte("encounters") + "select concat('page ', encounter_id) as rejected from encounters where encounter_id % 3 = 0")
def hl7_rejected(spark, sf_dir):
    """What stands before the first message of a text and is none."""
    n = F.col("encounter_id")
    e = raw(spark, sf_dir, "encounters").select(F.concat(F.when(n % 3 == 0, F.concat(F.lit("page "), n, F.lit("\r"))).otherwise(F.lit(" ")), F.lit("MSH|^~\\&|A|H|L|H|20240101||ADT^A01|"), n, F.lit("|P|2.5\r")).alias("value"))
    return hl7.rejected(e).select(F.trim(F.regexp_replace("raw", "\r", "")).alias("rejected"))


@query(
    cte("patients")
    + f"""select cast(patient_id as varchar) as control_id, cast(patient_id as varchar) as patient_id, last_name, nullif(trim(first_name), '') as first_name, date_of_birth, {picked('patient_id', *T.HL7_GENDER.values())} as gender,
'1 Main St' as address_line1, 'Town' as city, trim(state) as state, postal_code, phone, ssn from patients"""
)
def hl7_patients_in_full(spark, sf_dir):
    """Every column of a PID segment."""
    p = raw(spark, sf_dir, "patients")
    codes = list(T.HL7_GENDER)
    gender = F.element_at(F.array(*[F.lit(c) for c in codes]), (F.col("patient_id") % len(codes) + 1).cast("int"))
    pid = F.concat_ws("|", F.lit("PID|1|"), F.col("patient_id"), F.lit(""), F.concat(F.col("last_name"), F.lit("^"), F.trim("first_name")), F.lit(""), F.date_format("date_of_birth", "yyyyMMdd"), gender, F.lit("|"), F.concat(F.lit("1 Main St^^Town^"), F.trim("state"), F.lit("^"), F.col("postal_code")), F.lit(""), F.col("phone"), F.lit("||||"), F.col("ssn"))
    message = F.concat(F.lit("MSH|^~\\&|A|H|L|H|20240101||ADT^A01|"), F.col("patient_id"), F.lit("|P|2.5\r"), pid, F.lit("\r"))
    return hl7.patients(hl7.headed(hl7.parsed(hl7.messages(p.select(message.alias("value"))))))


# ---- audit, streams and marks


@query("select ts as event_time, event_type, cast(user_id as varchar) as user_id, 'read' as action, 'patient' as resource_type, substr(sha256(cast(event_id as varchar)), 1, 16) as resource_hash, cast(ts as date) as event_date from events where cast(ts as date) between date '2024-01-05' and date '2024-01-09' and event_type = 'purchase' order by event_date desc, event_time desc, resource_hash limit 300")
def audit_search(spark, sf_dir):
    """Audit events written by day in two goes, one day's folder with a line that cannot be read; then those of some days."""
    at = scratch.folder(spark, "audit")
    events = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("event_time"), "event_type", F.col("user_id").cast("string").alias("user_id"), F.lit("read").alias("action"), F.lit("patient").alias("resource_type"), F.col("event_id").alias("resource_id"))
    for half in (0, 1):
        audit.append(events.where(F.col("resource_id") % 2 == half), at)
    spark.range(1).select(F.lit('{"event_time": ').alias("value")).write.mode("append").text(f"{at}/event_date=2024-01-06")
    found = audit.search(spark, at, "2024-01-05", "2024-01-09", event_type="purchase", limit=300)
    return found.withColumn("event_time", F.col("event_time").cast("timestamp_ntz")).select("event_time", "event_type", "user_id", "action", "resource_type", "resource_hash", "event_date")


@query("select date_trunc('hour', ts) as hour, event_type, count(*) as arrivals from events group by 1, 2")
def hourly_arrivals(spark, sf_dir):
    """Events by hour and kind, as a stream of four batches in order of time."""
    at, e = scratch.folder(spark, "arrivals"), table(spark, sf_dir, "events")
    e.repartitionByRange(4, "ts").write.parquet(f"{at}/in")
    out = streams.drained(streams.hourly_arrivals(spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{at}/in"), late="60 days"), "arrivals", f"{at}/checkpoint")
    return out.withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@query(cte("encounters") + "select encounter_id from encounters where greatest(admission_date, discharge_date) >= timestamp '2001-06-01 00:00:00' - interval 3 hour")
def watermark_over_two_times(spark, sf_dir):
    """Encounters of which the later of two times is past the mark, less the lookback; a missing one does not count."""
    e = raw(spark, sf_dir, "encounters")
    return loads.since(e, loads.event_time("admission_date", "discharge_date"), "2001-06-01 00:00:00", 3).select("encounter_id")


_IN_ORDER = list(T.DOSES_A_DAY.items())


@query(cte("medications") + f"select encounter_id, line, {o.hits('lower(frequency)', _IN_ORDER)} as doses from medications")
def doses_in_the_tables_order(spark, sf_dir):
    """Doses a day where the first pattern of the table counts, and not the longest."""
    m = standardise.medications(raw(spark, sf_dir, "medications", wide=True), compat=True)
    return standardise.split(m)[0].select("encounter_id", "line", F.col("doses_per_day").alias("doses"))
