"""Tables of Parquet folders in versions: loads at once all survive, and a failed load leaves the last good version.

root/_versions holds one small JSON manifest for each version, that of the highest number being current. It names the version
that it was built on, the schema, how rows are laid out, the parts (folders under root/data that hold the rows) with their
counts and zones, the last batch taken of each stream, and marks. A load writes its parts aside and then records a manifest
under the next number, which only one writer can do. Whoever comes second replays its load on the version that the first one
made (`commit`).

Rows of a keyed table lie by the lowest bits of their key's hash. A leaf (so many bits, their value) may have several parts.
Beside its rows each part has `keys`: a Bloom filter of its keys, as rows of (word, mask). An upsert opens only the parts
whose leaf, zone (least and largest first key) and filter its keys fall in; new keys become parts of their own. A leaf that
outgrows `rows_a_part` is split by one more bit when it is written next, and one with many parts is written as one.

Rows of a dated table lie by day, so that days are dropped without a look at any row (`retain`).

Manifests are recorded by a link on local file systems and elsewhere by a rename that never replaces: the store must have one,
as Spark's own stream checkpoints ask for.
"""

from __future__ import annotations

import json
import os
import time
from collections import Counter
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as st

BUCKET, DAY = "_bucket", "_day"
ROWS_A_PART = 4_000_000
#: Parts of one leaf that the next load of it makes one.
MOST_PARTS = 8
#: Keys for each 64-bit word of a filter, in which every key sets three bits.
KEYS_A_WORD = 4
#: How often a load is replayed before it gives up.
TRIES = 50


class Conflict(RuntimeError):
    """Another writer came first."""


@dataclass(frozen=True)
class Part:
    """A folder of rows; of a keyed table with its leaf, filter and zone (texts, cast to the key's type), of a dated one its day."""

    path: str
    rows: int
    bits: int = 0
    bucket: int = 0
    keys: str | None = None
    words: int = 0
    low: str | None = None
    high: str | None = None
    day: str | None = None


@dataclass(frozen=True)
class Manifest:
    version: int
    built_on: int | None
    schema: str
    keys: list[str] = field(default_factory=list)
    buckets: int = 1
    rows_a_part: int = ROWS_A_PART
    leading: int = 0
    date: str | None = None
    parts: list[Part] = field(default_factory=list)
    batches: dict[str, int] = field(default_factory=dict)
    marks: dict[str, str] = field(default_factory=dict)

    @property
    def lead(self) -> list[str]:
        """The columns of the key that rows are laid out by."""
        return self.keys[: self.leading or None]

    @property
    def struct(self) -> st.StructType:
        return st.StructType.fromJson(json.loads(self.schema))


# ---- versions


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[int]:
    at, fs = _at(spark, f"{root}/_versions")
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(at) if f.getPath().getName().isdigit()) if fs.exists(at) else []


def manifest(spark: SparkSession, root: str, version: int | None = None) -> Manifest | None:
    """The manifest of a version, the newest by default; None if there is no version at all."""
    if version is None:
        known = versions(spark, root)
        if not known:
            return None
        version = known[-1]
    held = json.loads("".join(r["value"] for r in spark.read.text(f"{root}/_versions/{version:09d}", wholetext=True).collect()))  # one file
    return Manifest(**{**held, "parts": [Part(**p) for p in held["parts"]]})


def record(spark: SparkSession, root: str, made: Manifest) -> bool:
    """Records a manifest under its number; False if that number is taken."""
    aside, fs = _at(spark, f"{root}/_versions/.{uuid4().hex}")
    out = fs.create(aside)
    out.write(bytearray(json.dumps(asdict(made)).encode()))
    out.close()
    to, _ = _at(spark, f"{root}/_versions/{made.version:09d}")
    try:
        if fs.getUri().getScheme() == "file":
            os.link(aside.toUri().getPath(), to.toUri().getPath())
        else:
            never_replace = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(aside, to, never_replace)
    except FileExistsError:
        return False
    except Py4JJavaError as e:
        if "AlreadyExists" not in str(e.java_exception):
            raise
        return False
    finally:
        fs.delete(aside, False)
    return True


def commit(spark: SparkSession, root: str, change: Callable[[Manifest | None], Manifest | None], batch: tuple[str, int] | None = None) -> Manifest | None:
    """Records what change() makes of the newest manifest as the next version; when another writer came first, change() is
    asked again with what that one made. change() writes folders of its own and may give None for nothing to do.

    batch: a stream's name and the number of its batch. One that the table has taken already is left alone, so a batch that
    is run again after a failure counts once.
    """
    for _ in range(TRIES):
        old = manifest(spark, root)
        if batch and old and old.batches.get(batch[0], -1) >= batch[1]:
            return old
        made = change(old)
        if made is None:
            if not batch or old is None:
                return old
            made = old
        number = {} if batch is None else {batch[0]: batch[1]}
        made = replace(made, version=old.version + 1 if old else 0, built_on=old.version if old else None, batches={**made.batches, **number})
        if record(spark, root, made):
            return made
    raise Conflict(f"other writers changed {root} {TRIES} times")


def current(spark: SparkSession, root: str, schema: st.StructType | None = None, version: int | None = None) -> DataFrame:
    """The rows of a version, the newest by default; without any, no rows of the given schema."""
    held = manifest(spark, root, version)
    if held is None and schema is None:
        raise FileNotFoundError(f"no version under {root}")
    return spark.createDataFrame([], schema) if held is None else read(spark, held.struct, [p.path for p in held.parts])


def read(spark: SparkSession, schema: st.StructType, paths: list[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def fitted(rows: DataFrame, schema: st.StructType) -> DataFrame:
    """rows in the columns and types of a table: unknown columns go, missing ones are null."""
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def latest(rows: DataFrame, keys: list[str], by: str) -> DataFrame:
    """The newest row of each key; all of a key's columns decide between equals."""
    order = [F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in rows.columns if c not in keys and c != by]]
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


# ---- whole tables


def publish(df: DataFrame, root: str, built_on: int | None = -1) -> str:
    """Makes df the table's next version and returns its folder. A write that fails leaves the version before it. built_on:
    the version that df was made from (None: there was none); if the table has moved on since, Conflict is raised. Without
    it df replaces whatever is there."""
    spark, path = df.sparkSession, f"{root}/data/{uuid4().hex}"
    df.write.parquet(path)
    rows = spark.read.parquet(path).count()

    def change(old: Manifest | None) -> Manifest:
        if built_on != -1 and (old.version if old else None) != built_on:
            raise Conflict(f"{root} is at version {old and old.version}, not {built_on}")
        base = old or Manifest(0, None, "")
        return replace(base, schema=df.schema.json(), keys=[], date=None, parts=[Part(path, rows)])

    commit(spark, root, change)
    return path


def rewritten(spark: SparkSession, root: str, change: Callable[[DataFrame], DataFrame]) -> Manifest:
    """Replaces the rows of a whole table by what change() makes of them, however many writers do so at once."""

    def again(old: Manifest | None) -> Manifest:
        if old is None:
            raise FileNotFoundError(f"no version under {root}")
        df, path = change(read(spark, old.struct, [p.path for p in old.parts])), f"{root}/data/{uuid4().hex}"
        df.write.parquet(path)
        return replace(old, schema=df.schema.json(), parts=[Part(path, spark.read.parquet(path).count())])

    return commit(spark, root, again)


# ---- keyed tables


def key_hash(keys: list[str], seed: int = 0) -> Column:
    return F.xxhash64(*keys) if not seed else F.xxhash64(F.lit(seed), *keys)


def leaf(bits: int) -> Column:
    """The value of the lowest `bits` bits of the column _h."""
    return F.col("_h").bitwiseAND(F.lit((1 << bits) - 1))


def filter_bits(words: Column) -> tuple[Column, Column]:
    """(the word of a filter of that many words, the bits in it) of the key whose second hash is the column _g."""
    bit = lambda at: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned("_g", at).bitwiseAND(F.lit(63)).cast("int"))
    return F.pmod(F.shiftrightunsigned("_g", 20), words), bit(0).bitwiseOR(bit(6)).bitwiseOR(bit(12))


def _keyed(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.select(F.col(keys[0]).alias("_k"), key_hash(keys).alias("_h"), key_hash(keys, 7).alias("_g"))


def _write_keyed(spark: SparkSession, rows: DataFrame, root: str, m: Manifest, bits: int) -> list[Part]:
    """Writes rows as parts of leaves of `bits` bits, each with its filter and zone. A leaf's rows may be several tasks'."""
    path = f"{root}/data/{uuid4().hex}"
    placed = rows.withColumn("_h", key_hash(m.lead)).withColumn(BUCKET, leaf(bits)).drop("_h")
    placed.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(path)
    written = spark.read.schema(st.StructType([*m.struct.fields, st.StructField(BUCKET, st.LongType())])).parquet(path)
    keyed = written.select(BUCKET, F.col(m.keys[0]).alias("_k"), key_hash(m.lead, 7).alias("_g"))
    zone = [f(F.col("_k")).cast("string").alias(c) for f, c in ((F.min, "low"), (F.max, "high"))]
    counts = keyed.groupBy(BUCKET).agg(F.count("*").alias("rows"), *zone).withColumn("words", F.lit(1) + F.floor(F.col("rows") / KEYS_A_WORD)).collect()  # a row a part
    if not counts:
        return []
    sizes = spark.createDataFrame([(r[BUCKET], r["words"]) for r in counts], f"{BUCKET} long, words long")
    word, mask = filter_bits(F.col("words"))
    keyed.join(sizes, BUCKET).groupBy(BUCKET, word.alias("word")).agg(F.bit_or(mask).alias("mask")).hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(f"{path}-keys")
    return [Part(f"{path}/{BUCKET}={r[BUCKET]}", r["rows"], bits, r[BUCKET], f"{path}-keys/{BUCKET}={r[BUCKET]}", r["words"], r["low"], r["high"]) for r in counts]


def bits_for(rows: int, m: Manifest) -> int:
    """How many bits of the hash leave at most rows_a_part rows in a leaf."""
    return max((m.buckets - 1).bit_length(), (-(-rows // m.rows_a_part) - 1).bit_length() if rows else 0)


def create(df: DataFrame, root: str, keys: list[str], buckets: int = 1, rows_a_part: int = ROWS_A_PART, leading: int = 0) -> Manifest:
    """A keyed table of df (each key once), in place of what is there. buckets: how many leaves it has at least; leading: by
    how many of the key's columns rows are laid out, all by default."""
    spark = df.sparkSession
    m = Manifest(0, None, df.schema.json(), keys, buckets, rows_a_part, leading)
    parts = _write_keyed(spark, df, root, m, bits_for(df.count(), m))
    return commit(spark, root, lambda old: replace(old or m, schema=m.schema, keys=keys, buckets=buckets, rows_a_part=rows_a_part, leading=leading, date=None, parts=parts))


def may_hold(spark: SparkSession, m: Manifest, rows: DataFrame) -> list[Part]:
    """The parts that may hold keys of rows: by leaf, then by zone, then by filter. Only the filters of parts that pass the
    first two are read, and no part itself."""
    if not m.parts:
        return []
    kind = m.struct[m.keys[0]].dataType
    shape = "part int, bits int, bucket long, words long, low string, high string"
    entries = spark.createDataFrame([(k, p.bits, p.bucket, p.words, p.low, p.high) for k, p in enumerate(m.parts)], shape)
    depths = F.array(*[F.struct(F.lit(d).alias("bits"), leaf(d).alias("bucket")) for d in sorted({p.bits for p in m.parts})])
    keyed = _keyed(rows, m.lead)
    placed = keyed.select("_k", "_g", F.explode(depths).alias("at")).select("_k", "_g", "at.*").join(entries, ["bits", "bucket"])
    inside = F.coalesce(F.col("_k").between(F.col("low").cast(kind), F.col("high").cast(kind)), F.lit(True))
    placed = placed.where(inside)
    near = [r["part"] for r in placed.select("part").distinct().collect()]  # parts at most
    if not near:
        return []
    word, mask = filter_bits(F.col("words"))
    asked = placed.select("part", word.alias("word"), mask.alias("wanted"))
    paths = spark.createDataFrame([(k, m.parts[k].keys.rsplit("/data/", 1)[1]) for k in near], "part int, tail string")
    tail = F.regexp_extract(F.input_file_name(), r"/data/([^/]+/[^/]+)/[^/]+$", 1)
    held = spark.read.schema("word long, mask long").parquet(*[m.parts[k].keys for k in near]).withColumn("tail", tail).join(paths, "tail")
    found = asked.join(held, ["part", "word"]).where(F.col("mask").bitwiseAND(F.col("wanted")) == F.col("wanted"))
    return [m.parts[r["part"]] for r in found.select("part").distinct().collect()]


def upsert(updates: DataFrame, root: str, keys: list[str], by: str, buckets: int | None = None, batch: tuple[str, int] | None = None, newer_only: bool = False, stamp: str | None = None) -> list[str]:
    """Upserts into a keyed table and returns the folders that were opened for it. Of rows of one key the newest by `by`
    counts, and it replaces what the table has; with newer_only (by is then a column of the table) only if that is not newer.
    Columns that the table lacks go. stamp: a column of the table that gets the time of the load in the rows it writes.
    Keys or a number of buckets other than the table's are an error: rows would be looked for where they are not.
    """
    spark = updates.sparkSession
    m = manifest(spark, root)
    if m is None:
        raise FileNotFoundError(f"no version under {root}")
    if m.keys != keys or buckets not in (None, m.buckets):
        raise ValueError(f"{root} has keys {m.keys} in {m.buckets} buckets, not {keys} in {buckets}")
    if newer_only and by not in m.struct.names:
        raise ValueError(f"{root} has no column {by}")
    new, aside, opened = fitted(latest(updates, keys, by), m.struct), f"{root}/data/{uuid4().hex}-load", []
    if stamp:
        new = new.withColumn(stamp, F.current_timestamp().cast(m.struct[stamp].dataType))
    new.write.parquet(aside)  # worked out once, however often the load is replayed
    new = read(spark, m.struct, [aside])
    count = new.count()

    def change(old: Manifest) -> Manifest | None:
        if not count:
            return None
        touched = may_hold(spark, old, new)
        bits = bits_for(sum(p.rows for p in old.parts) + count, old)
        crowded = {k for k, n in Counter((p.bits, p.bucket) for p in old.parts).items() if n >= MOST_PARTS}
        touched += [p for p in old.parts if (p.bits, p.bucket) in crowded and p not in touched]
        opened[:] = [p.path for p in touched]
        base = read(spark, old.struct, opened)
        rows = latest(base.unionByName(new), keys, by) if newer_only else base.join(new, keys, "left_anti").select(base.columns).unionByName(new)
        return replace(old, parts=[p for p in old.parts if p not in touched] + _write_keyed(spark, rows, root, old, bits))

    try:
        commit(spark, root, change, batch)
    finally:
        at, fs = _at(spark, aside)
        fs.delete(at, True)
    return opened


def replace_keys(keys: DataFrame, root: str, change: Callable[[DataFrame], DataFrame]) -> Manifest:
    """Rewrites the parts that may hold rows of keys (distinct values of the columns that lead the table's key) by change(),
    which is given those parts' rows."""
    spark = keys.sparkSession

    def again(old: Manifest) -> Manifest:
        touched = may_hold(spark, old, keys)
        rows = change(read(spark, old.struct, [p.path for p in touched]))
        return replace(old, parts=[p for p in old.parts if p not in touched] + _write_keyed(spark, rows, root, old, bits_for(sum(p.rows for p in old.parts), old)))

    return commit(spark, root, again)


def of_keys(keys: DataFrame, root: str) -> DataFrame:
    """The rows of keys (as in replace_keys); parts that cannot hold any are not opened."""
    m = manifest(keys.sparkSession, root)
    return read(keys.sparkSession, m.struct, [p.path for p in may_hold(keys.sparkSession, m, keys)]).join(keys, m.lead, "left_semi")


# ---- dated tables


def create_dated(spark: SparkSession, root: str, schema: st.StructType, date: str) -> Manifest:
    """An empty table whose rows lie by the day of the column `date`."""
    return commit(spark, root, lambda old: replace(old or Manifest(0, None, ""), schema=schema.json(), keys=[], date=date, parts=[]))


def append(rows: DataFrame, root: str, batch: tuple[str, int] | None = None) -> int:
    """Appends rows to a dated table and returns how many they were; 0 for a batch that it has taken already."""
    spark, added = rows.sparkSession, []
    m = manifest(spark, root)
    if m is None or m.date is None:
        raise ValueError(f"{root} is no dated table")
    if batch and m.batches.get(batch[0], -1) >= batch[1]:
        return 0
    path = f"{root}/data/{uuid4().hex}"
    fitted(rows, m.struct).withColumn(DAY, F.to_date(m.date).cast("string")).hint("rebalance", F.col(DAY)).write.partitionBy(DAY).parquet(path)
    written = spark.read.schema(st.StructType([*m.struct.fields, st.StructField(DAY, st.StringType())])).parquet(path)
    days = written.groupBy(DAY).agg(F.count("*").alias("rows")).collect()  # a row a day
    parts = [Part(f"{path}/{DAY}={r[DAY] or '__HIVE_DEFAULT_PARTITION__'}", r["rows"], day=r[DAY]) for r in days]

    def change(old: Manifest) -> Manifest | None:
        added[:] = parts
        return replace(old, parts=[*old.parts, *parts]) if parts else None

    commit(spark, root, change, batch)
    return sum(p.rows for p in added)


def retain(spark: SparkSession, keep_from: dict[str, str]) -> DataFrame:
    """Drops the days before the given one from each dated table; table, parts_dropped, rows_deleted, rows_kept. Manifests
    alone decide: no row is read, and nothing is written but the next manifest. Rows without a day stay."""
    out = []
    for root, day in keep_from.items():
        gone: list[Part] = []

        def change(old: Manifest | None, root: str = root, day: str = day, gone: list[Part] = gone) -> Manifest | None:
            if old is None or old.date is None:
                raise ValueError(f"{root} is no dated table")
            gone[:] = [p for p in old.parts if p.day is not None and p.day < day]
            return replace(old, parts=[p for p in old.parts if p not in gone]) if gone else None

        left = commit(spark, root, change)
        out.append((root, len(gone), sum(p.rows for p in gone), sum(p.rows for p in left.parts)))
    return spark.createDataFrame(out, "table string, parts_dropped long, rows_deleted long, rows_kept long")


def vacuum(spark: SparkSession, root: str, keep: int = 2, orphan_hours: float = 24.0) -> list[str]:
    """Removes the versions before the newest `keep` and every folder that no version left refers to; returns the folders.
    Folders that no version ever named (of loads that failed) go once they are older than orphan_hours, as a load under way
    has such folders too."""
    known = versions(spark, root)
    kept, gone = known[-keep:], known[:-keep]
    top = lambda p: p.rsplit("/data/", 1)[1]
    named = {v: [x for p in manifest(spark, root, v).parts for x in (p.path, p.keys) if x] for v in known}
    used = Counter(top(x) for v in kept for x in named[v])
    out = sorted({x for v in gone for x in named[v] if not used[top(x)]})
    for x in out:
        at, fs = _at(spark, x)
        fs.delete(at, True)
    heads = {top(x).split("/")[0] for v in known for x in named[v]}
    alive = {x.split("/")[0] for x in used}
    at, fs = _at(spark, f"{root}/data")
    for f in fs.listStatus(at) if fs.exists(at) else []:
        name = f.getPath().getName()
        old = time.time() - f.getModificationTime() / 1000 >= orphan_hours * 3600
        if name not in alive and (name in heads or old):
            fs.delete(f.getPath(), True)
            out += [] if name in heads else [f"{root}/data/{name}"]
    for v in gone:
        at, fs = _at(spark, f"{root}/_versions/{v:09d}")
        fs.delete(at, False)
    return out
