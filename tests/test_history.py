"""History from changes in any order against a plain version of it."""

import random

import pytest
from pyspark.sql import functions as F

from wardlake.operators import history, versioned

SHAPE = "id long, v string, w int, at date, seen int"


def plain(rows):
    out = []
    for key in {r[0] for r in rows if r[0] is not None and r[3] is not None}:
        newest = {}
        for r in sorted((r for r in rows if r[0] == key and r[3] is not None), key=lambda r: r[4]):
            newest[r[3]] = r
        kept = []
        for r in (newest[d] for d in sorted(newest)):
            if not kept or kept[-1][1:3] != r[1:3]:
                kept.append(r)
        ends = [*[r[3] for r in kept[1:]], None]
        out += [(key, r[1], r[2], r[3], e, e is None) for r, e in zip(kept, ends, strict=True)]
    return sorted(out, key=str)


def changes(seed, n=60):
    rnd = random.Random(seed)
    days = [f"2024-01-{d:02d}" for d in range(1, 20)]
    return [(rnd.randrange(6), rnd.choice(["a", "b", None]), rnd.choice([1, None]), rnd.choice(days), k) for k in range(n)] + [(None, "x", 1, "2024-01-01", 99), (1, "x", 1, None, 98)]


def framed(spark, rows):
    return spark.createDataFrame(rows, SHAPE.replace("at date", "at string")).withColumn("at", F.col("at").cast("date"))


def rows_of(dim):
    return sorted(((r[0], r[1], r[2], str(r[3]), r[4] and str(r[4]), r[5]) for r in dim.select("id", "v", "w", "effective_date", "expiration_date", "is_current").collect()), key=str)


def test_versions_of_all_changes(spark):
    rows = changes(1)
    seen = history.sightings(framed(spark, rows), "id", ["v", "w"], "at", "seen")
    assert rows_of(history.versions(seen, "id", ["v", "w"], "at")) == plain(rows)


@pytest.mark.parametrize("seed", [2, 3])
def test_any_order_of_loads_is_one_load(spark, tmp_path, seed):
    rows = changes(seed)
    loads = [rows[k::4] for k in range(4)]
    random.Random(seed).shuffle(loads)
    seen, dim = str(tmp_path / "seen"), str(tmp_path / "dim")
    history.create(framed(spark, loads[0]), seen, dim, "id", ["v", "w"], "at", "seen")
    for part in [*loads[1:], loads[2]]:  # the last one twice
        history.load(framed(spark, part), seen, dim, "id", ["v", "w"], "at", "seen")
    assert rows_of(versioned.current(spark, dim)) == plain(rows)


def test_a_change_between_equal_sightings_makes_three_versions(spark, tmp_path):
    seen, dim = str(tmp_path / "seen"), str(tmp_path / "dim")
    history.create(framed(spark, [(1, "a", 1, "2024-01-01", 1), (1, "a", 1, "2024-01-09", 2)]), seen, dim, "id", ["v", "w"], "at", "seen")
    assert len(rows_of(versioned.current(spark, dim))) == 1
    history.load(framed(spark, [(1, "b", 1, "2024-01-05", 3)]), seen, dim, "id", ["v", "w"], "at", "seen")
    assert [r[1] for r in sorted(rows_of(versioned.current(spark, dim)), key=lambda r: r[3])] == ["a", "b", "a"]
    facts = spark.sql("select 1 as id, date(d) as at from values ('2023-12-31'), ('2024-01-01'), ('2024-01-08'), ('2024-01-09') t(d)")
    assert [r["v"] for r in history.as_of(facts, versioned.current(spark, dim), "id", "at", ["v"]).orderBy("at").collect()] == [None, "a", "b", "a"]
