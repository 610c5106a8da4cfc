"""Sketches, expected stays, redaction, rules, the census stream and sources against plain versions of what they compute."""

import random
from types import SimpleNamespace

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from oracle_check import difference
from pyspark.sql import functions as F
from pyspark.sql import types as st

from wardlake.operators import expected, metrics, phi, rules, sketches
from wardlake.plans import upkeep
from wardlake.sources import fhir, flat, hl7, relational
from wardlake.streaming import streams


def test_merged_sketches_keep_their_error_bounds(spark):
    rnd = np.random.default_rng(1)
    values = rnd.lognormal(1, 1, 40_000).round(2)
    rows = spark.createDataFrame([(f"u{k % 3}", int(k % 31), float(v), int(v * 1000) % 9000) for k, v in enumerate(values)], "unit string, day int, v double, who long").cache()
    daily = sketches.quantile_table(rows, ["unit", "day"], "v")
    for keys, mask in ((["unit"], lambda k: k % 3 == 1), ([], lambda k: k >= 0)):
        own = np.sort(values[[mask(k) for k in range(len(values))]])
        merged = sketches.merged_quantiles(daily, keys)
        for q in (0.05, 0.5, 0.9, 0.99):
            got = (merged.where("unit = 'u1'") if keys else merged).select(sketches.quantile(q)).first()[0]
            assert abs(np.searchsorted(own, got) / len(own) - q) <= 2 * sketches.RANK_ERROR
    who = sketches.merged_distinct(sketches.distinct_table(rows, ["unit", "day"], "who"), [])
    assert who.select(sketches.distinct()).first()[0] == rows.select("who").distinct().count() and who.first()["records"] == len(values)


def test_distinct_beyond_what_a_sketch_keeps(spark):
    days = sketches.distinct_table(spark.range(200_000).select((F.col("id") % 10).alias("day"), (F.col("id") % 90_000).alias("who")), ["day"], "who", lg=10)
    assert sketches.merged_distinct(days, [], lg=10).select(sketches.distinct()).first()[0] == pytest.approx(90_000, rel=4 / 2**5)


def test_patients_are_exact_beyond_a_sketch(spark, tmp_path):
    rows = "select i as o_orderkey, i * 7 % 50021 as o_custkey, 'F' as o_orderstatus, 1.0 as o_totalprice, timestamp '1999-01-01' + to_days(cast(i % 700 as int)) as o_orderdate, '2-HIGH' as o_orderpriority from range(250000) t(i)"
    duckdb.sql(f"copy ({rows}) to '{tmp_path}/orders.parquet'")
    assert difference(spark, str(tmp_path), upkeep.QUERIES["patients_of_any_range"], upkeep.ORACLE_SQL["patients_of_any_range"]) == ""


def cases(seed=2, n=400):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        a, b = rnd.choice(["x", "y", None, "z"]), rnd.randrange(3)
        los = round(2 + 3 * (a == "x") - (b == 1) + rnd.random(), 3) if rnd.random() < 0.9 else None
        rows.append((a, b, los, None if los is None else int(rnd.random() < 1 / (1 + np.exp(-(los - 3))))))
    return rows


def test_fits_equal_dense_ones(spark):
    rows = cases()
    df = spark.createDataFrame(rows, "a string, b int, los double, back int")
    known = [r for r in rows if r[2] is not None]
    x = np.array([[1.0, r[0] == "x", r[0] == "y", r[0] is None, r[1] == 1, r[1] == 2] for r in known], float)
    y, back = np.array([r[2] for r in known]), np.array([r[3] for r in known], float)
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    w = np.zeros(6)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x, x.T @ (back - p))
    kept = df.where("los is not null")
    linear, logit = (expected.fit(df, ["a", "b"], c, logistic=l) for c, l in (("los", False), ("back", True)))
    got = kept.select("a", "b", "los", linear.alias("e"), logit.alias("p")).collect()
    want = {(r[0], r[1]): (e, p) for r, e, p in zip(known, x @ beta, 1 / (1 + np.exp(-x @ w)), strict=True)}
    for r in got:
        assert (r["e"], r["p"]) == pytest.approx(want[r["a"], r["b"]], abs=1e-7)


def test_strata_and_ratio(spark):
    df = spark.createDataFrame([("u", "a", 2.0), ("v", "a", 4.0), ("v", None, 1.0), ("u", None, None)], "unit string, kind string, los double")
    rows = {r["unit"]: r for r in expected.observed_over_expected(expected.by_strata(df, ["kind"], "los"), ["unit"], "los").collect()}
    assert (rows["u"]["observed"], rows["u"]["expected"], rows["v"]["expected"], rows["v"]["n"]) == (2.0, 3.0, 4.0, 2)


def test_too_many_levels_are_an_error(spark):
    with pytest.raises(ValueError, match="levels"):
        expected.fit(spark.range(900).withColumn("y", F.lit(1.0)), ["id"], "y")


def test_nothing_stays_under_a_listed_name(spark):
    inner = "struct<ssn: string, note: string, size: int>"
    shape = f"id int, m map<string, {inner}>, l map<string, array<string>>, n map<string, map<string, {inner}>>, a array<{inner}>, address struct<street: string, no: int, more: array<{inner}>>, k map<int, {inner}>, MRN array<int>"
    secret = ("SECRET", "SECRET", 7)
    row = (1, {"mrn": secret, "other": ("SECRET", "fine", 1)}, {"Mrn": ["SECRET"], "x": ["fine"]}, {"phone": {"x": secret}, "x": {"ssn": secret, "y": ("SECRET", "fine", 2)}}, [("SECRET", "fine", 3)], ("SECRET", 7, [secret]), {5: ("SECRET", "fine", 4)}, [7])
    out = phi.redacted_by_name(spark.createDataFrame([row, (2, None, None, None, None, None, None, None)], shape)).orderBy("id")
    kept, empty = out.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).collect()
    assert "SECRET" not in kept[0] and "7" not in kept[0] and kept[0].count("fine") == 5 and all(f'"size":{k}' in kept[0] for k in (1, 2, 3, 4)) and '"id":1' in kept[0]
    assert out.collect()[1]["m"] is None
    assert isinstance(out.schema["m"].dataType.valueType.fields[2].dataType, st.IntegerType)


def test_batch_totals_and_sample(spark):
    df = spark.createDataFrame([(k, "a@b.org" if k % 2 else "x", "10.0.0.1" if k % 3 == 0 else None) for k in range(30)], "id int, said string, seen string")
    one = phi.batch_summary(df, "id").first()
    assert (one["by_kind"], one["by_field"], one["records_scanned"]) == ({"email": 15, "ip_address": 10}, {"said": 15, "seen": 10}, 30)
    ten = [phi.batch_summary(df, "id", sample=10).first() for _ in range(2)]
    assert ten[0] == ten[1] and ten[0]["records_scanned"] == 10


def test_rules_of_users(spark):
    df = spark.createDataFrame([(10, 1), (None, 1), (300, None)], "hr int, n int")
    own = [rules.Rule("a", "v", "error", F.col("hr") > 20), rules.Rule("b", "v", "error", F.lit(False))]
    new = [rules.user_rule(df, "b", "v", "warning", "n = 1"), rules.user_rule(df, "c", "v", "error", "missing > 1"), rules.user_rule(df, "d", "v", "error", "not even SQL (")]
    both = rules.with_rules(own, new, remove=("d",))
    assert [(r["rule"], r["severity"], r["failures"], r["records"]) for r in rules.failures_by_rule(df, both).collect()] == [("a", "error", 1, 3), ("b", "warning", 0, 3), ("c", "error", 3, 3)]
    assert [r.name for r in rules.with_rules(both, only=("a", "c"))] == ["a", "c"]


def test_emergency_department_at_a_time(spark):
    at = lambda s: f"2024-01-02 {s}" if s else None
    rows = [("08:00", "09:00", None, None), ("09:00", None, None, "admit_pending"), ("09:30", "11:00", None, None), ("07:00", "07:10", "09:50", None), ("08:00", "08:30", "12:00", None), ("10:30", None, None, None)]
    df = spark.createDataFrame([(at(a), at(b), at(c), d) for a, b, c, d in rows] + [("2024-01-01 09:00", None, None, None)], "a string, p string, d string, discharge_disposition string")
    df = df.select(*[F.col(c).cast("timestamp_ntz").alias(n) for c, n in (("a", "admission_date"), ("p", "provider_contact"), ("d", "discharge_date"))], "discharge_disposition", F.lit(True).alias("is_emergency"))
    assert tuple(metrics.ed_now(df, F.lit("2024-01-02 10:00").cast("timestamp_ntz")).first()) == (4, 2, 1, 1, 45.0)


def plain_census(events):
    units = {}
    for e in {e[0] for e in events}:
        own = {x[1]: x for x in events if x[0] == e}
        gone = {x[5] for x in own.values() if x[3] == "cancel"}
        stays = sorted((x[2], x[1], x) for x in own.values() if x[3] != "cancel" and x[1] not in gone)
        if stays and stays[-1][2][3] != "discharge":
            unit = stays[-1][2][4] or "Unknown"
            units[unit] = units.get(unit, 0) + 1
    return units


@pytest.mark.parametrize("seed", [1, 2])
def test_census_of_events_in_any_order(spark, tmp_path, seed):
    rnd, events = random.Random(seed), []
    for e in range(40):
        for k in range(rnd.randrange(1, 6)):
            kind = rnd.choice(["admit", "move", "move", "discharge", "cancel"])
            events.append((e, e * 10 + k, f"2024-01-{rnd.randrange(1, 28):02d} 10:00:00", kind, rnd.choice(["A", "B", None]), e * 10 + rnd.randrange(k) if kind == "cancel" and k else None))
    both = [*events, *events, (None, 1, "2024-01-01 10:00:00", "admit", "A", None)]
    rnd.shuffle(both)
    shape = streams.CENSUS_EVENT.replace("at timestamp", "at string")
    for k in range(3):
        spark.createDataFrame(both[k::3], shape).withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", streams.STATE_STORE)
    steps = streams.live_census(spark.readStream.schema(streams.CENSUS_EVENT).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), late="400 days")
    got = streams.drained(steps, "steps", str(tmp_path / "checkpoint"), "append").groupBy("unit").agg(F.sum("step").alias("n")).where("n <> 0")
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert {r["unit"]: r["n"] for r in got.collect()} == plain_census(events)


class OneGroup:
    """A group's state, and how often it was read."""

    def __init__(self):
        self.value, self.reads, self.timers = None, 0, set()
        self.registerTimer, self.deleteTimer = self.timers.add, self.timers.remove

    def getValueState(self, *_):
        return self

    def get(self):
        self.reads += 1
        return self.value

    def update(self, value):
        self.value = value


def test_a_group_of_encounters_is_one_state(spark):
    rnd, events = random.Random(5), []
    for e in range(500):
        for k in range(rnd.randrange(1, 6)):
            events.append((e, e * 10 + k, rnd.randrange(1, 9) * 10**6, rnd.choice(["admit", "move", "discharge", "cancel"]), rnd.choice(["A", "B", "Unknown"]), e * 10 + rnd.randrange(k) if k and rnd.random() < 0.5 else -1))
    both = [*events, *events]
    rnd.shuffle(both)
    group, census, times, steps = OneGroup(), streams.Census(10**6), SimpleNamespace(getCurrentWatermarkInMs=lambda: 0), []
    census.init(group)
    for k in range(4):
        columns = dict(zip(("encounter_id", "event_id", "micros", "kind", "unit", "of"), map(list, zip(*both[k::4], strict=True)), strict=True))
        rows = [b.to_pandas() for b in streams.dealt(iter([pa.RecordBatch.from_pydict({"group": [7] * len(both[k::4]), **columns})]))]
        assert len(rows[0]) == 1
        steps += census.handleInputRows(7, iter(rows), times)
    found = pd.concat(steps).groupby("unit")["step"].sum()
    assert {u: n for u, n in found.items() if n} == plain_census(events) and group.reads == 4 and len(group.timers) == 1


def test_encounters_that_are_over_are_forgotten(spark, tmp_path):
    ended = [(e, e * 10 + k, f"2024-01-0{k + 1} 10:00:00", kind, "A", None) for e in range(30) for k, kind in enumerate(("admit", "discharge"))]
    files = [[*ended, (30, 300, "2024-01-01 10:00:00", "admit", "B", None)], [(99, 990, "2024-03-01 10:00:00", "admit", None, None)], [(99, 991, "2024-03-02 10:00:00", "move", "C", None), (5, 59, "2024-01-03 10:00:00", "admit", "A", None)]]
    for rows in files:
        spark.createDataFrame(rows, streams.CENSUS_EVENT.replace("at timestamp", "at string")).withColumn("at", F.col("at").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", streams.STATE_STORE)
    steps = streams.live_census(spark.readStream.schema(streams.CENSUS_EVENT).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), late="1 day", keep_days=1, groups=3)
    got = streams.drained(steps, "over", str(tmp_path / "checkpoint"), "append").groupBy("unit").agg(F.sum("step").alias("n")).where("n <> 0")
    assert {r["unit"]: r["n"] for r in got.collect()} == {"B": 1, "C": 1}
    held = spark.read.format("statestore").option("stateVarName", "events").load(str(tmp_path / "checkpoint")).select("value.events").collect()
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert sorted({e for r in held for e in pa.ipc.open_stream(r[0]).read_all()["encounter_id"].to_pylist()}) == [30, 99]


def test_the_database_filters(spark):
    url, driver = "jdbc:derby:memory:pushed;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    rows = spark.range(100).select(F.col("id"), (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.col("id").cast("int"))).alias("at"))
    rows.write.format("jdbc").options(url=url, dbtable="t", **driver).save()
    df = relational.read_jdbc(spark, url, "t", "ID", parts=4, since="2024-03-01", at="AT", ids=spark.createDataFrame([(70,), (70,), (80,), (3,)], "id long"), id_column="id", **driver)
    assert sorted(r["id"] for r in df.collect()) == [70, 80]
    plan = df._jdf.queryExecution().toString()
    assert "PushedFilters: [*IsNotNull(at), *GreaterThanOrEqual(at" in plan
    assert relational.read_jdbc(spark, url, "t", "id", parts=4, **driver).rdd.getNumPartitions() == 4 and relational.read_jdbc(spark, url, "t", **driver).count() == 100


def test_many_files_of_two_layouts(spark, tmp_path):
    for k in range(120):
        (tmp_path / f"patients_{k}.csv").write_text(("Patient ID,Sex\n1,M\n" if k % 2 else '﻿sex,"PATIENT  ID",DOB\nF,2,2001-01-01\n'), encoding="utf-8")
    (tmp_path / "patients_empty.csv").write_text("")
    rows = flat.canonical(flat.read(spark, str(tmp_path), "patients"), "patients").groupBy("source_id", "gender", "date_of_birth").count().collect()
    assert sorted(map(tuple, rows), key=str) == [("1", "M", None, 60), ("2", "F", "2001-01-01", 60)]


def test_sources_of_odd_files(spark, tmp_path):
    (tmp_path / "labs.csv").write_text("title\nLab ID;Value\n1;a\n2;b;c;d\n")
    good, bad = flat.quarantined(flat.read(spark, str(tmp_path), "labs", sep=";", skip_rows=1).cache())
    assert [(r["lab_id"], r["value"], r["_source_file"]) for r in good.collect()] == [("1", "a", "labs.csv")] and [tuple(r) for r in bad.collect()] == [("2;b;c;d", "labs.csv")]
    assert flat.preview(spark, str(tmp_path / "labs.csv"), 1, ";").count() == 1
    clock = spark.createDataFrame([("20240102", "930"), ("2024-01-02", None), ("soon", "1")], "d string, t string").select(flat.joined_time(F.col("d"), F.col("t")).alias("x"))
    assert [str(r["x"]) for r in clock.collect()] == ["2024-01-02 09:30:00", "2024-01-02 00:00:00", "None"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "patients_1.csv").write_text("id,sex\n1,M\n")
    stream = flat.arriving(spark, str(tmp_path / "in"), "patients", ["id", "sex"], str(tmp_path / "done"))
    assert [tuple(r) for r in streams.drained(stream, "people", str(tmp_path / "c"), "append").collect()] == [("1", "M")]


def test_messages_since_and_rejected(spark):
    text = "noise\rMSH|^~\\&|A|H|L|H|20240101120000||ADT^A01|1|P|2.5\rPID|1||7\rMSH|^~\\&|A|H|L|H|20240103120000||ADT^A01|2|P|2.5\rPID|1||8\r"
    files = spark.createDataFrame([(text,)], "value string")
    assert [r["raw"].strip() for r in hl7.rejected(files).collect()] == ["noise"]
    headed = hl7.headed(hl7.parsed(hl7.messages(files)))
    assert [r["control_id"] for r in hl7.changed(headed, "2024-01-02 00:00:00").collect()] == ["2"] and [r["control_id"] for r in hl7.changed(headed, ids=["7"]).collect()] == ["1"]


def test_catalog_and_codes(spark):
    spark.range(3).createOrReplaceTempView("known_rows")
    assert ("known_rows", True) in [tuple(r) for r in relational.tables(spark).collect()]
    assert [tuple(r)[:2] for r in relational.columns(spark, "known_rows").collect()] == [("id", "bigint")]
    codes = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert [r[0] for r in codes.select(rules.not_deprecated(F.col("c"), ["b"])).collect()] == [True, False, True]


def test_paths_of_a_resource_are_overridden(spark):
    rows = spark.createDataFrame([('{"resourceType":"Encounter","id":"1","period":{"start":"2024-01-02T03:04:05Z"},"x":[{"y":3.5}]}',), ("{",), (None,), ('{"resourceType":"Patient","id":"2"}',)], "value string")
    got = fhir.by_paths(rows, "Encounter", {"status": None, "y": ("$.x[0].y", "double"), "class": ("$.x", "int")}).collect()
    assert len(got) == 1 and got[0]["y"] == 3.5 and "status" not in got[0] and got[0]["class"] is None and str(got[0]["admission_date"]) == "2024-01-02 03:04:05"
