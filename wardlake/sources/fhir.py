"""FHIR bundles landed as JSON: resources by type, as canonical columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.functions.dates import parse_time

_coding = "array<struct<system:string,code:string,display:string>>"
_concept = f"struct<coding:{_coding},text:string>"
_ref = "struct<reference:string,display:string>"
_range = "array<struct<low:struct<value:double>,high:struct<value:double>>>"
RESOURCE = (
    "struct<resourceType:string,id:string,status:string,meta:struct<lastUpdated:string>,"
    f"identifier:array<struct<type:{_concept},value:string>>,name:array<struct<family:string,given:array<string>>>,gender:string,birthDate:string,"
    "address:array<struct<line:array<string>,city:string,state:string,postalCode:string,country:string>>,telecom:array<struct<system:string,value:string>>,"
    f"maritalStatus:{_concept},extension:array<struct<url:string,valueString:string,valueCode:string,extension:array<struct<url:string,valueString:string,valueCoding:struct<code:string>>>>>,"
    f"deceasedBoolean:boolean,deceasedDateTime:string,communication:array<struct<language:{_concept}>>,location:array<struct<location:{_ref}>>,serviceProvider:{_ref},reasonCode:array<{_concept}>,"
    f"class:struct<code:string>,subject:{_ref},encounter:{_ref},period:struct<start:string,end:string>,hospitalization:struct<admitSource:{_concept},dischargeDisposition:{_concept}>,"
    f"code:{_concept},category:array<{_concept}>,clinicalStatus:{_concept},onsetDateTime:string,recordedDate:string,performedDateTime:string,performedPeriod:struct<start:string>,"
    f"valueQuantity:struct<value:double,unit:string>,valueString:string,valueCodeableConcept:{_concept},interpretation:array<{_concept}>,referenceRange:{_range},effectiveDateTime:string,"
    f"medicationCodeableConcept:{_concept},authoredOn:string,dosageInstruction:array<struct<text:string,route:{_concept}>>>"
)
BUNDLE = f"struct<resourceType:string,entry:array<struct<resource:{RESOURCE}>>>"


def resources(bundles: DataFrame, value: str = "value") -> DataFrame:
    """r: each resource of the bundles' JSON texts."""
    return bundles.select(F.explode(F.from_json(value, BUNDLE)["entry"]).alias("e")).select(F.col("e.resource").alias("r"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    return resources(spark.read.text(f"{folder}/*.json", wholetext=True))


def read_lines(spark: SparkSession, folder: str) -> DataFrame:
    """r: the resources of files that hold one in each line (*.ndjson). Such files are cut between tasks anywhere; blank lines
    and lines that are no JSON give none."""
    r = lines(spark, folder).select(F.from_json("value", RESOURCE).alias("r"))
    return r.where(F.col("r.resourceType").isNotNull())


def lines(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.text(f"{folder}/*.ndjson").where("trim(value) <> ''")


#: Where canonical columns lie in a resource, with their types. A server that puts them elsewhere overrides some.
PATHS = {
    "Patient": {
        "source_id": ("$.id", "string"), "mrn": ("$.identifier[0].value", "string"), "last_name": ("$.name[0].family", "string"), "first_name": ("$.name[0].given[0]", "string"),
        "gender": ("$.gender", "string"), "date_of_birth": ("$.birthDate", "date"), "city": ("$.address[0].city", "string"), "state": ("$.address[0].state", "string"),
        "postal_code": ("$.address[0].postalCode", "string"), "phone": ("$.telecom[0].value", "string"), "updated_at": ("$.meta.lastUpdated", "timestamp"),
    },
    "Encounter": {
        "source_id": ("$.id", "string"), "patient": ("$.subject.reference", "string"), "status": ("$.status", "string"), "class": ("$.class.code", "string"),
        "admission_date": ("$.period.start", "timestamp"), "discharge_date": ("$.period.end", "timestamp"), "updated_at": ("$.meta.lastUpdated", "timestamp"),
    },
    "Observation": {
        "source_id": ("$.id", "string"), "patient": ("$.subject.reference", "string"), "code": ("$.code.coding[0].code", "string"), "value": ("$.valueQuantity.value", "double"),
        "unit": ("$.valueQuantity.unit", "string"), "effective_date": ("$.effectiveDateTime", "timestamp"),
    },
}


def by_paths(records: DataFrame, kind: str, overrides: dict[str, tuple[str, str]] | None = None, value: str = "value") -> DataFrame:
    """The canonical columns of the resources of a kind, by PATHS and the user's overrides (column: path and type), which may
    add columns; a path of None leaves one out. Each text is parsed once, to a variant that keeps all of its fields; a path
    that a resource lacks, or whose value is not of the type, gives null. Texts that are no JSON are left out."""
    paths = {c: p for c, p in {**PATHS.get(kind, {}), **(overrides or {})}.items() if p is not None}
    parsed = records.select(F.try_parse_json(value).alias("v")).where(F.try_variant_get("v", "$.resourceType", "string") == kind)
    return parsed.select(*[F.try_variant_get("v", path, type_).alias(c) for c, (path, type_) in paths.items()])


def of_type(r: DataFrame, kind: str, since: str | None = None, ids: list[str] | None = None, patients: list[str] | None = None, encounters: list[str] | None = None, category: str | None = None) -> DataFrame:
    """Resources of a type: changed since, with one of the ids, of the patients or encounters, of a category."""
    out = r.where(F.col("r.resourceType") == kind)
    if since is not None:
        out = out.where(parse_time(F.col("r.meta.lastUpdated")) >= F.lit(since).cast("timestamp"))
    for wanted, c in ((ids, F.col("r.id")), (patients, reference_id(F.col("r.subject"))), (encounters, reference_id(F.col("r.encounter")))):
        if wanted is not None:
            out = out.where(c.isin(*wanted))
    return out if category is None else out.where(F.exists("r.category", lambda x: F.exists(x["coding"], lambda k: k["code"] == category)))


def first_code(concept: Column) -> Column:
    return F.get(concept["coding"], F.lit(0))["code"]


def reference_id(ref: Column) -> Column:
    return F.nullif(F.element_at(F.split(ref["reference"], "/"), -1), F.lit(""))


def identifier(kind: str) -> Column:
    return F.get(F.filter("r.identifier", lambda i: F.get(i["type"]["coding"], F.lit(0))["code"] == kind), F.lit(0))["value"]


def extension(url: str) -> Column:
    own = F.get(F.filter("r.extension", lambda x: x["url"] == url), F.lit(0))
    nested = F.get(F.filter(own["extension"], lambda x: x["url"] == "ombCategory"), F.lit(0))["valueCoding"]["code"]
    return F.coalesce(nested, own["valueString"], own["valueCode"])


def telecom(system: str) -> Column:
    return F.get(F.reverse(F.filter("r.telecom", lambda t: t["system"] == system)), F.lit(0))["value"]


def patients(r: DataFrame) -> DataFrame:
    name, home = F.get("r.name", F.lit(0)), F.get("r.address", F.lit(0))
    return of_type(r, "Patient").select(
        F.col("r.id").alias("patient_id"), identifier("MR").alias("mrn"), identifier("SS").alias("ssn"), F.array_join(name["given"], " ").alias("first_name"), name["family"].alias("last_name"),
        F.to_date("r.birthDate").alias("date_of_birth"), F.col("r.gender").alias("gender"), F.get(home["line"], F.lit(0)).alias("address_line1"), home["city"].alias("city"), home["state"].alias("state"),
        home["postalCode"].alias("postal_code"), telecom("phone").alias("phone"), telecom("email").alias("email"), first_code(F.col("r.maritalStatus")).alias("marital_status"),
        extension("http://hl7.org/fhir/us/core/StructureDefinition/us-core-race").alias("race"), extension("http://hl7.org/fhir/us/core/StructureDefinition/us-core-ethnicity").alias("ethnicity"),
        F.coalesce("r.deceasedBoolean", F.lit(False)).alias("deceased"), F.to_date(parse_time(F.col("r.deceasedDateTime"))).alias("deceased_date"), first_code(F.get("r.communication", F.lit(0))["language"]).alias("language"),
    )


def encounters(r: DataFrame) -> DataFrame:
    place = F.get("r.location", F.lit(0))["location"]
    return of_type(r, "Encounter").select(
        F.col("r.id").alias("encounter_id"), reference_id(F.col("r.subject")).alias("patient_id"), F.col("r.class.code").alias("encounter_type"), F.col("r.status").alias("status"),
        parse_time(F.col("r.period.start")).alias("admission_date"), parse_time(F.col("r.period.end")).alias("discharge_date"),
        first_code(F.col("r.hospitalization.dischargeDisposition")).alias("discharge_disposition"), first_code(F.col("r.hospitalization.admitSource")).alias("admit_source"),
        place["display"].alias("location"), reference_id(place).alias("location_id"), F.col("r.serviceProvider.display").alias("service_provider"), first_code(F.get("r.reasonCode", F.lit(0))).alias("reason_code"),
    )


def conditions(r: DataFrame) -> DataFrame:
    return of_type(r, "Condition").select(
        F.col("r.id").alias("source_id"), reference_id(F.col("r.subject")).alias("patient_id"), reference_id(F.col("r.encounter")).alias("encounter_id"), first_code(F.col("r.code")).alias("code"),
        F.get("r.code.coding", F.lit(0))["system"].alias("code_system"), F.col("r.code.text").alias("description"), first_code(F.col("r.clinicalStatus")).alias("clinical_status"), F.to_date(parse_time(F.col("r.onsetDateTime"))).alias("onset_date"),
    )


def procedures(r: DataFrame) -> DataFrame:
    return of_type(r, "Procedure").select(
        F.col("r.id").alias("source_id"), reference_id(F.col("r.subject")).alias("patient_id"), reference_id(F.col("r.encounter")).alias("encounter_id"), first_code(F.col("r.code")).alias("code"),
        F.col("r.status").alias("status"), parse_time(F.coalesce("r.performedDateTime", "r.performedPeriod.start")).alias("performed_date"),
    )


def observations(r: DataFrame) -> DataFrame:
    span = F.get("r.referenceRange", F.lit(0))
    return of_type(r, "Observation").select(
        F.col("r.id").alias("source_id"), reference_id(F.col("r.subject")).alias("patient_id"), first_code(F.get("r.category", F.lit(0))).alias("category"), first_code(F.col("r.code")).alias("code"), F.col("r.code.text").alias("test_name"),
        F.col("r.valueQuantity.value").alias("value"), F.coalesce("r.valueString", first_code(F.col("r.valueCodeableConcept"))).alias("value_string"), F.col("r.valueQuantity.unit").alias("unit"),
        span["low"]["value"].alias("reference_low"), span["high"]["value"].alias("reference_high"), first_code(F.get("r.interpretation", F.lit(0))).alias("interpretation"), parse_time(F.col("r.effectiveDateTime")).alias("effective_date"),
    )


def medications(r: DataFrame) -> DataFrame:
    dose = F.get("r.dosageInstruction", F.lit(0))
    return of_type(r, "MedicationRequest").select(
        F.col("r.id").alias("source_id"), reference_id(F.col("r.subject")).alias("patient_id"), reference_id(F.col("r.encounter")).alias("encounter_id"), F.col("r.medicationCodeableConcept.text").alias("medication_name"),
        F.col("r.status").alias("status"), dose["text"].alias("dosage"), first_code(dose["route"]).alias("route"), parse_time(F.col("r.authoredOn")).alias("authored_date"),
    )
