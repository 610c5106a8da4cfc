"""Versioned tables: loads at once, failures, pruning, splitting, retention and vacuum."""

import os
import threading

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from wardlake.operators import loads, versioned


def keyed(spark, lo, hi, v="a"):
    return spark.range(lo, hi).select("id", F.lit(v).alias("v"), F.lit(1).alias("at"))


def values(spark, root):
    rows = [(r["id"], r["v"]) for r in versioned.current(spark, root).collect()]
    assert len({k for k, _ in rows}) == len(rows)  # no key twice
    return dict(rows)


def test_loads_at_once_both_survive(spark, tmp_path):
    root = str(tmp_path / "t")
    versioned.create(keyed(spark, 0, 100), root, ["id"], 4)
    failed = []

    def load(k):
        try:
            versioned.upsert(keyed(spark, 1000 + k, 1001 + k, f"w{k}").unionByName(keyed(spark, k, k + 1, f"w{k}")), root, ["id"], "at")
        except Exception as e:  # noqa: BLE001  told below
            failed.append(e)

    threads = [threading.Thread(target=load, args=(k,)) for k in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed
    want = {k: "a" for k in range(100)} | {k: f"w{k}" for k in range(6)} | {1000 + k: f"w{k}" for k in range(6)}
    assert values(spark, root) == want
    chain = [versioned.manifest(spark, root, v) for v in versioned.versions(spark, root)]
    assert [m.built_on for m in chain] == [None, *range(6)]


def test_a_load_that_comes_second_is_replayed(spark, tmp_path, monkeypatch):
    root, recorded = str(tmp_path / "t"), versioned.record
    versioned.create(keyed(spark, 0, 10), root, ["id"])

    def late(*args):  # between reading the version and recording the next another load comes first
        monkeypatch.setattr(versioned, "record", recorded)
        versioned.upsert(keyed(spark, 3, 5, "first"), root, ["id"], "at")
        return recorded(*args)

    monkeypatch.setattr(versioned, "record", late)
    versioned.upsert(keyed(spark, 4, 12, "second"), root, ["id"], "at")
    assert values(spark, root) == {0: "a", 1: "a", 2: "a", 3: "first", **{k: "second" for k in range(4, 12)}}


def test_a_published_table_tells_of_another_writer(spark, tmp_path):
    root = str(tmp_path / "t")
    versioned.publish(keyed(spark, 0, 3), root, built_on=None)
    versioned.publish(keyed(spark, 0, 4), root, built_on=0)
    with pytest.raises(versioned.Conflict):
        versioned.publish(keyed(spark, 0, 9), root, built_on=0)
    assert versioned.rewritten(spark, root, lambda df: df.where("id > 0")).version == 2 and len(values(spark, root)) == 3


def test_a_number_is_recorded_once(spark, tmp_path):
    root = str(tmp_path / "t")
    m = versioned.create(keyed(spark, 0, 3), root, ["id"])
    assert not versioned.record(spark, root, m) and len(os.listdir(f"{root}/_versions")) == 1


def test_a_rename_never_replaces(spark, tmp_path):
    """What other stores than local ones use."""
    at = [versioned._at(spark, str(tmp_path / n))[0] for n in ("a", "b")]
    for n in ("a", "b"):
        (tmp_path / n).write_text(n)
    none = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getLocalFSFileContext()
    with pytest.raises(Exception, match="AlreadyExists"):
        context.rename(*at, none)
    assert (tmp_path / "b").read_text() == "b"


def test_other_buckets_or_keys_are_an_error(spark, tmp_path):
    root = str(tmp_path / "t")
    versioned.create(keyed(spark, 0, 1000), root, ["id"], 8)
    for how in ({"keys": ["id"], "buckets": 64}, {"keys": ["v"]}):
        with pytest.raises(ValueError, match="has keys"):
            versioned.upsert(keyed(spark, 0, 1008), root, by="at", **how)
    versioned.upsert(keyed(spark, 500, 1008), root, ["id"], "at")
    assert len(values(spark, root)) == 1008


def test_a_load_opens_only_what_may_hold_its_keys(spark, tmp_path):
    root = str(tmp_path / "t")
    versioned.create(keyed(spark, 0, 4000), root, ["id"], 16)
    assert versioned.upsert(keyed(spark, 100_000, 100_500, "new"), root, ["id"], "at") == []  # beyond every zone
    one = versioned.upsert(keyed(spark, 77, 78, "one"), root, ["id"], "at")
    assert len(one) == 1  # of 16 leaves and their later parts
    holes = spark.range(0, 4000).where("id % 2 = 0").select("id", F.lit("even").alias("v"), F.lit(1).alias("at"))
    versioned.create(holes, root, ["id"], 16)
    odd = versioned.upsert(holes.where("id < 20").withColumn("id", F.col("id") + 1), root, ["id"], "at")
    assert len(odd) <= 1  # inside the zones: the filters keep them shut, but for one in a hundred or so
    assert len(values(spark, root)) == 2010


def test_leaves_split_as_they_grow_and_gather_their_parts(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    monkeypatch.setattr(versioned, "MOST_PARTS", 3)
    versioned.create(keyed(spark, 0, 100), root, ["id"], rows_a_part=100)
    for k in range(1, 8):
        versioned.upsert(keyed(spark, 100 * k - 5, 100 * k + 100, str(k)), root, ["id"], "at")
    m = versioned.manifest(spark, root)
    assert max(p.bits for p in m.parts) in (3, 4) and sum(p.rows for p in m.parts) == 800
    assert values(spark, root) == {n: str(min(7, (n + 5) // 100)) if n >= 95 else "a" for n in range(800)}


def test_older_rows_lose_and_loads_are_stamped(spark, tmp_path):
    root = str(tmp_path / "t")
    shape = "id long, v string, at int, updated_at timestamp_ntz"
    versioned.create(spark.createDataFrame([(1, "kept", 5, None), (2, "old", 1, None), (None, "null", 1, None)], shape), root, ["id"])
    versioned.upsert(spark.createDataFrame([(1, "late", 4, None), (2, "new", 2, None)], shape), root, ["id"], "at", newer_only=True, stamp="updated_at")
    rows = {r["id"]: r for r in versioned.current(spark, root).collect()}
    assert {k: r["v"] for k, r in rows.items()} == {1: "kept", 2: "new", None: "null"} and rows[2]["updated_at"] and not rows[1]["updated_at"]


def test_a_batch_that_runs_again_counts_once(spark, tmp_path):
    root = str(tmp_path / "t")
    days = spark.sql("select id, date_add(date '2024-01-01', cast(id % 3 as int)) as day from range(9)")
    versioned.create_dated(spark, root, days.schema, "day")
    assert [versioned.append(days, root, ("s", k)) for k in (0, 0, 1)] == [9, 0, 9]
    assert versioned.append(days, root, ("other", 0)) == 9 and versioned.current(spark, root).count() == 27


def test_retention_reads_no_row(spark, tmp_path):
    root = str(tmp_path / "t")
    days = spark.sql("select id, case when id < 9 then date_add(date '2024-01-01', cast(id % 3 as int)) end as day from range(10)")
    versioned.create_dated(spark, root, days.schema, "day")
    versioned.append(days, root)
    for p in versioned.manifest(spark, root).parts:  # rows that cannot be read
        for f in os.listdir(p.path):
            os.truncate(f"{p.path}/{f}", 0)
    assert [tuple(r)[1:] for r in versioned.retain(spark, {root: "2024-01-03"}).collect()] == [(2, 6, 4)]
    assert [tuple(r)[1:] for r in versioned.retain(spark, {root: "2024-01-03"}).collect()] == [(0, 0, 4)]


def test_vacuum_keeps_what_a_version_names(spark, tmp_path):
    root = str(tmp_path / "t")
    versioned.create(keyed(spark, 0, 100), root, ["id"], 4)
    first = {p.path for p in versioned.manifest(spark, root).parts}
    for k in range(4):
        versioned.upsert(keyed(spark, 0, 1, f"{k}"), root, ["id"], "at")
    os.makedirs(f"{root}/data/left-by-a-failure")
    assert versioned.vacuum(spark, root, keep=9) == []
    gone = versioned.vacuum(spark, root, keep=2, orphan_hours=0)
    assert versioned.versions(spark, root) == [3, 4] and f"{root}/data/left-by-a-failure" in gone
    assert len(values(spark, root)) == 100 and versioned.current(spark, root, version=3).count() == 100
    kept = {p.path for p in versioned.manifest(spark, root).parts}
    assert first & kept and not kept & set(gone) and not any(os.path.exists(g) for g in gone)


def test_a_failed_reload_keeps_the_last_good_table(spark, tmp_path):
    good = spark.range(5).withColumn("_errors", F.array().cast("array<string>"))
    bad = good.withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long"))
    for df in (good, bad):
        told = loads.load_sources(spark, {"s": lambda df=df: df}, str(tmp_path)).first()
    assert "broken" in told["error"] and loads.current(spark, str(tmp_path / "s")).count() == 5


def test_incremental_loads_of_two_writers(spark, tmp_path):
    at, marks = str(tmp_path / "t"), str(tmp_path / "m")
    row = lambda k, when, v: (k, when, v)
    make = lambda *rows: spark.createDataFrame(rows, "id long, ts string, v string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    loads.incremental_load(make(row(1, "2024-01-01 10:00:00", "a"), row(2, "2024-01-01 11:00:00", "a")), at, marks, "s", "e", ["id"], ["ts"])
    loads.incremental_load(make(row(2, "2024-01-01 12:00:00", "b"), row(3, "2024-01-01 09:30:00", "late"), row(4, "2024-01-01 08:00:00", "too late")), at, marks, "s", "e", ["id"], ["ts"])
    assert {r["id"]: r["v"] for r in loads.current(spark, at).collect()} == {1: "a", 2: "b", 3: "late"}
    with pytest.raises(PySparkException):
        loads.incremental_load(make(row(5, "2024-01-02 12:00:00", "x")).withColumn("v", F.raise_error(F.lit("no")).cast("string")), at, marks, "s", "e", ["id"], ["ts"])
    assert [str(r["last_value"]) for r in loads.current(spark, marks).collect()] == ["2024-01-01 12:00:00"]
