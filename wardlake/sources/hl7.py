"""HL7 v2 messages: files of several messages, split into segments, fields, repetitions and components by expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.functions import tables as T
from wardlake.functions.lookup import mapped


def messages(files: DataFrame, value: str = "value") -> DataFrame:
    """One row for each message of a text; what does not start with MSH is left to `rejected`."""
    return files.select(F.explode(F.split(F.col(value), r"(?=MSH\|)")).alias("raw")).where(F.trim("raw") != "").where(F.col("raw").startswith("MSH"))


def rejected(files: DataFrame, value: str = "value") -> DataFrame:
    return files.select(F.explode(F.split(F.col(value), r"(?=MSH\|)")).alias("raw")).where((F.trim("raw") != "") & ~F.col("raw").startswith("MSH"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    return messages(spark.read.text(f"{folder}/*.hl7", wholetext=True))


#: What the delimiters of a message become, so that all are split by the same ones: of fields, components, repetitions.
FIELD, COMPONENT, REPETITION = "\x1d", "\x1e", "\x1f"


def parsed(raw: DataFrame) -> DataFrame:
    """raw with segs: segments of fields of repetitions of components. The delimiters are the message's own, translated to
    fixed ones in one go; MSH-2, which lists them, stays whole."""
    marks = F.substring("raw", 5, 4)
    comp, rep = (F.when(F.substring(marks, k, 1).isin("", FIELD), F.lit(d)).otherwise(F.substring(marks, k, 1)) for k, d in ((1, "^"), (2, "~")))
    plain = F.call_function("translate", F.regexp_replace("raw", "\r\n|\n", "\r"), F.concat(F.substring("raw", 4, 1), comp, rep), F.lit(FIELD + COMPONENT + REPETITION))
    text = raw.withColumns({"_marks": marks, "_text": plain})
    lines = F.filter(F.split("_text", "\r"), lambda s: F.length(F.trim(s)) > 0)
    pieces = lambda x: F.transform(F.split(x, REPETITION), lambda r: F.split(r, COMPONENT))
    fields = lambda s: F.transform(F.split(s, FIELD), lambda x, i: F.when(s.startswith("MSH") & (i == 1), F.array(F.array(F.col("_marks")))).otherwise(pieces(x)))
    # explode, so that the message is split once and not again for every field taken from it
    return text.select(*raw.columns, F.explode(F.array(F.transform(lines, fields))).alias("segs"))


def segment(name: str, n: int = 0) -> Column:
    return F.get(F.filter("segs", lambda s: s[0][0][0] == name), F.lit(n))


def field(seg: Column, index: int, component: int = 0, repetition: int = 0) -> Column:
    """1-based field, 0-based component and repetition; missing and empty are null. In MSH, field n is item n - 1."""
    return F.nullif(F.get(F.get(F.get(seg, F.lit(index)), F.lit(repetition)), F.lit(component)), F.lit(""))


def timestamp(c: Column) -> Column:
    t = F.regexp_replace(c, r"[+-]\d{4}$", "")
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in ("yyyyMMddHHmmss.SSS", "yyyyMMddHHmmss", "yyyyMMddHHmm", "yyyyMMdd")])


def headed(df: DataFrame) -> DataFrame:
    m = segment("MSH")
    kind = F.concat_ws("^", field(m, 8, 0), field(m, 8, 1))
    return df.withColumns({"sending_app": field(m, 2), "receiving_app": field(m, 4), "message_time": timestamp(field(m, 6)), "message_type": kind, "control_id": field(m, 9)})


def changed(df: DataFrame, since: str | None = None, ids: list[str] | None = None) -> DataFrame:
    """Messages at or after a time, and of the given patients."""
    out = df if since is None else df.where(F.col("message_time") >= F.lit(since).cast("timestamp"))
    return out if ids is None else out.where(field(segment("PID"), 3).isin(*ids))


def patients(df: DataFrame) -> DataFrame:
    p = segment("PID")
    return df.where(F.col("message_type").startswith("ADT")).select(
        "control_id", field(p, 3).alias("patient_id"), field(p, 5, 0).alias("last_name"), field(p, 5, 1).alias("first_name"), F.to_date(timestamp(field(p, 7))).alias("date_of_birth"),
        mapped(field(p, 8), T.HL7_GENDER).alias("gender"), field(p, 11, 0).alias("address_line1"), field(p, 11, 2).alias("city"), field(p, 11, 3).alias("state"), field(p, 11, 4).alias("postal_code"),
        field(p, 13).alias("phone"), field(p, 19).alias("ssn"),
    )


def encounters(df: DataFrame) -> DataFrame:
    p, v, e = segment("PID"), segment("PV1"), segment("EVN")
    return df.where(F.col("message_type").startswith("ADT")).select(
        "control_id", F.coalesce(field(v, 19), field(v, 5)).alias("encounter_id"), field(p, 3).alias("patient_id"), F.coalesce(mapped(field(v, 2), T.HL7_CLASS), F.lit("unknown")).alias("encounter_type"),
        F.coalesce(timestamp(field(e, 2)), timestamp(field(v, 44))).alias("admission_date"), timestamp(field(v, 45)).alias("discharge_date"), field(v, 3, 0).alias("department"),
        F.when(F.col("message_type").endswith("A01"), "active").otherwise("finished").alias("status"),
    )


def diagnoses(df: DataFrame) -> DataFrame:
    p = segment("PID")
    d = F.col("d")
    return df.select("control_id", field(p, 3).alias("patient_id"), F.posexplode(F.filter("segs", lambda s: s[0][0][0] == "DG1")).alias("pos", "d")).select(
        "control_id", "patient_id", (F.col("pos") + 1).alias("rank"), field(d, 3, 0).alias("code"), field(d, 3, 1).alias("description"), field(d, 6).alias("diagnosis_type")
    )


def observations(df: DataFrame) -> DataFrame:
    """One row for each OBX of ORU messages: a number for types NM and SN, else text; OBX-14 or the order's OBR-7 as time."""
    p, o = segment("PID"), F.col("o")
    number = F.when(field(o, 2).isin("NM", "SN"), field(o, 5).try_cast("double"))
    return df.where(F.col("message_type").startswith("ORU")).select("control_id", field(p, 3).alias("patient_id"), field(segment("OBR"), 7).alias("ordered"), F.posexplode(F.filter("segs", lambda s: s[0][0][0] == "OBX")).alias("pos", "o")).select(
        "control_id", "patient_id", (F.col("pos") + 1).alias("set_id"), field(o, 3, 0).alias("code"), field(o, 3, 1).alias("test_name"), number.alias("value"), F.when(number.isNull(), field(o, 5)).alias("value_string"),
        field(o, 6).alias("unit"), field(o, 8).alias("interpretation"), timestamp(F.coalesce(field(o, 14), F.col("ordered"))).alias("effective_date"),
    )
