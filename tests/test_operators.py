"""Single operators on literal rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wardlake.functions import dates
from wardlake.functions import tables as T
from wardlake.functions.lookup import mapped
from wardlake.operators import loads, phi, rules, standardise, summaries
from wardlake.sources import audit, flat, hl7, relational
from wardlake.streaming import streams


def one(spark, column, **values):
    types = {str: "string", float: "double", int: "bigint", date: "date", datetime: "timestamp_ntz", type(None): "string"}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {types[type(v)]}" for k, v in values.items()))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "number"), [("<5", 5.0), (" 7.5 ", 7.5), ("90%", 90.0), ("Negative", None), ("", None), (None, None)])
def test_lab_number(spark, text, number):
    assert one(spark, standardise.lab_number(F.col("v")), v=text) == number


@pytest.mark.parametrize(("name", "want"), [("ALICE", "Alice"), ("o'brien-smith", "O'Brien-Smith"), ("McKay", "McKay"), ("  bob ", "Bob")])
def test_names(spark, name, want):
    assert one(spark, standardise.title_name(F.col("v")), v=name) == want


@pytest.mark.parametrize(("text", "want"), [("2024-02-03", date(2024, 2, 3)), ("2/3/2024", date(2024, 2, 3)), ("20240203", date(2024, 2, 3)), ("31/12/2023", date(2023, 12, 31)), ("no", None)])
def test_dates(spark, text, want):
    assert one(spark, dates.parse_date(F.col("v")), v=text) == want


def test_age_before_and_on_birthday(spark):
    assert one(spark, dates.age(F.col("b"), F.col("d")), b=date(2000, 6, 2), d=date(2020, 6, 1)) == 19
    assert one(spark, dates.age(F.col("b"), F.col("d")), b=date(2000, 6, 2), d=date(2020, 6, 2)) == 20


def test_unmapped_and_null(spark):
    assert one(spark, mapped(F.col("v"), T.GENDER, F.lit("unknown")), v="zz") == "unknown"
    assert one(spark, mapped(F.col("v"), T.GENDER, F.lit("unknown")), v=None) is None


@pytest.mark.parametrize(("s", "d", "want"), [(110.0, 70.0, "normal"), (125.0, 75.0, "elevated"), (190.0, 85.0, "stage_1"), (150.0, 95.0, "stage_2"), (190.0, 125.0, "crisis")])
def test_blood_pressure(spark, s, d, want):
    assert one(spark, standardise.bp_class(F.col("s"), F.col("d")), s=s, d=d) == want


@pytest.mark.parametrize(("text", "kind"), [("ssn: 123-45-6789", "ssn"), ("call (555) 123-4567", "phone"), ("a.b@example.org", "email"), ("dob: 1/2/1990", "date_of_birth"), ("MRN: A123", "mrn"), ("at 10.0.0.1", "ip_address")])
def test_phi(spark, text, kind):
    assert one(spark, phi.has_kind(F.col("v"), kind), v=text) is True
    assert one(spark, phi.has_kind(F.col("v"), kind), v="nothing here") is False


def test_npi(spark):
    assert one(spark, rules.npi_valid(F.col("v")), v="1234567893") is True
    assert one(spark, rules.npi_valid(F.col("v")), v="1234567890") is False


def test_upsert_twice_is_once(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "k int, v string, at int")
    once = loads.upsert(base, new, ["k"], "at")
    twice = loads.upsert(once, new, ["k"], "at")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [(1, "a"), (2, "d"), (3, "e")]


def test_history_has_one_current_row(spark):
    dim = spark.createDataFrame([(1, None, date(2020, 1, 1), None, True), (2, "x", date(2020, 1, 1), None, True)], "id int, v string, effective_date date, expiration_date date, is_current boolean")
    out = loads.scd2(dim, spark.createDataFrame([(1, "new"), (2, "x"), (3, None)], "id int, v string"), "id", ["v"], "2021-01-01")
    assert sorted((r["id"], r["v"] or "", r["is_current"]) for r in out.collect()) == [(1, "", False), (1, "new", True), (2, "x", True), (3, "", True)]


def test_versions(spark, tmp_path):
    loads.publish(spark.range(3), str(tmp_path))
    loads.publish(spark.range(5), str(tmp_path))
    assert loads.current(spark, str(tmp_path)).count() == 5


def test_csv(spark, tmp_path):
    (tmp_path / "patients.csv").write_text("Patient ID,Sex,DOB\n1,M,2000-01-01\n2,F\n3,,x,extra\n")
    df = flat.read(spark, str(tmp_path), "patients", ["Patient ID", "Sex", "DOB"])
    good, bad = flat.quarantined(df.cache())
    assert [(r["source_id"], r["gender"]) for r in flat.canonical(good, "patients").collect()] == [("1", "M")]
    assert bad.count() == 2
    assert flat.read(spark, str(tmp_path), "labs", ["a"]).count() == 0


def test_hl7_observations(spark):
    text = "MSH|^~\\&|LAB|H|X|H|20240101120000||ORU^R01|7|P|2.5\rPID|1||55\rOBR|1||||||20240101\rOBX|1|NM|GLU^Glucose||0|mg/dL||N\rOBX|2|ST|NOTE^Note||fine\rjunk"
    out = hl7.observations(hl7.headed(hl7.parsed(hl7.messages(spark.createDataFrame([(text,), ("broken",)], "value string"))))).collect()
    assert [(r["patient_id"], r["code"], r["value"], r["value_string"], r["effective_date"]) for r in out] == [("55", "GLU", 0.0, None, datetime(2024, 1, 1)), ("55", "NOTE", None, "fine", datetime(2024, 1, 1))]


def test_only_small_tables_are_dealt_out(spark, tmp_path):
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    spark.range(40).selectExpr("id", "id % 3 as k").coalesce(1).write.parquet(one)
    spark.range(40).repartition(spark.sparkContext.defaultParallelism).write.parquet(many)
    plan = lambda df: df._jdf.queryExecution().toString()
    dealt = relational.read_parquet(spark, one, wide=True)
    assert sorted(r["id"] for r in dealt.collect()) == list(range(40))
    narrow = plan(dealt.where("k > 1").select("id"))
    assert "RoundRobinPartitioning" in narrow and "GreaterThan(k,1)" in narrow
    assert "ReadSchema: struct<id:bigint>" in plan(dealt.select("id"))
    assert all("RoundRobin" not in plan(df) for df in (relational.read_parquet(spark, one), relational.read_parquet(spark, many, wide=True)))


def test_tables(spark):
    spark.createDataFrame([(1, "2024-01-01"), (2, "2024-02-01")], "patient_id int, updated_at string").createOrReplaceTempView("people")
    assert relational.read_table(spark, "people", since="2024-01-15").count() == 1
    assert relational.read_table(spark, "nowhere").count() == 0
    assert relational.query(spark, "select * from people where patient_id = :id", id=2).count() == 1


def test_audit(spark, tmp_path):
    events = spark.createDataFrame([(datetime(2024, 1, 1, 8), "read", "u1", "view", "patient", "5"), (datetime(2024, 1, 2, 8), "read", "u2", "view", "patient", "6")], "event_time timestamp, event_type string, user_id string, action string, resource_type string, resource_id string")
    audit.append(events, str(tmp_path))
    assert [r["user_id"] for r in audit.search(spark, str(tmp_path), "2024-01-01", "2024-01-02").collect()] == ["u2", "u1"]


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = streams.hourly_arrivals(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")))
    got = streams.drained(stream, "arrivals", str(tmp_path / "checkpoint"))
    want = streams.hourly_arrivals(events)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("March 5, 2024", "2024-03-05"), ("mar 5, 2024", "2024-03-05"), ("03-05-2024", "2024-03-05"), ("25/12/2023", "2023-12-25"), ("1/2/69", "1969-01-02"), ("1/2/68", "2068-01-02"),
        ("2024-03-05T10:00:00.123Z", "2024-03-05"), ("2024-03-05 10:00:00+02:00", "2024-03-05"), ("2/29/72", "1972-02-29"), ("13/13/2023", "1900-01-01"), ("Smarch 1, 2024", "1900-01-01"), ("", "1900-01-01"), (None, "1900-01-01"),
    ],
)
def test_written_dates_and_default(spark, text, want):
    assert str(one(spark, dates.written_date(F.col("v").cast("string"), F.lit("1900-01-01")), v=text)) == want


def test_counts_as_map_of_missing_values(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("a", "x"), ("b", None)], "g string, k string")
    rows = {r["g"]: (r["total"], r["counts"]) for r in summaries.counts_as_map(df, ["g"], "k").collect()}
    assert rows == {"a": (3, {"unknown": 1, "x": 2}), "b": (1, {"unknown": 1})}
    assert summaries.counts_as_map(df.where("false"), ["g"], "k").count() == 0
