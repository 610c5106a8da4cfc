"""Structured Streaming jobs: HL7 intake, hourly arrivals, live census, and loads batch by batch, each batch once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from wardlake.operators import versioned
from wardlake.sources import hl7

#: State that a processor keeps by key lies in this store.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def hourly_arrivals(events: DataFrame, at: str = "ts", late: str = "2 hours") -> DataFrame:
    """Events an hour and kind, in tumbling windows; later than `late` they no longer count."""
    timed = events.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", late)
    return timed.groupBy(F.window("_at", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("arrivals")).select(F.col("w.start").alias("hour"), "event_type", "arrivals")


def hl7_intake(spark: SparkSession, folder: str, late: str = "2 hours") -> DataFrame:
    """Messages from files that land in a folder, each control id once within `late`."""
    files = spark.readStream.format("text").option("wholetext", True).load(f"{folder}/*.hl7")
    return hl7.headed(hl7.parsed(hl7.messages(files))).withWatermark("message_time", late).dropDuplicatesWithinWatermark(["control_id"])


# ---- live census

#: An event of an encounter: kind is admit, move, discharge or cancel; a cancel names in `of` the event that it takes back.
CENSUS_EVENT = "encounter_id long, event_id long, at timestamp, kind string, unit string, of long"
CENSUS_STEP = "unit string, step int, micros long"
#: Encounters are kept in so many groups. A group is read and written as one, some 10 ms at least, whenever an event of it comes,
#: so this many suit up to some ten million encounters that are kept at a time. Fixed for a checkpoint's life, as a group's number
#: follows from it.
CENSUS_GROUPS = 1024
#: An event as a group keeps it, without nulls; here: whether it is what puts its encounter where it is.
#: Events that a task gathers before it deals them to the groups.
GATHERED = 1 << 17
_HELD = pa.schema([("encounter_id", pa.int64()), ("event_id", pa.int64()), ("kind", pa.string()), ("micros", pa.int64()), ("unit", pa.string()), ("of", pa.int64()), ("here", pa.bool_())])


def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Events with their group's number as a row for each group that has some: the newest one's time, and a list of each column."""

    def rows(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        events = pa.Table.from_batches(held)
        events = events.take(np.argsort(events["group"].to_numpy(), kind="stable")).combine_chunks()
        group = events["group"].to_numpy()
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        ends = pa.array(np.append(first, len(group)).astype("int32"))
        lists = {c: pa.ListArray.from_arrays(ends, events[c].combine_chunks()) for c in _HELD.names[:-1]}
        return pa.RecordBatch.from_pydict({"group": group[first], "newest": np.maximum.reduceat(events["micros"].to_numpy(), first), **lists})

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= GATHERED:
            yield rows(held)
            held, n = [], 0
    if n:
        yield rows(held)


def _ranks(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Texts as their places among the distinct ones, and these in order."""
    coded = texts.combine_chunks().dictionary_encode()
    names = coded.dictionary.to_numpy(zero_copy_only=False)
    order = np.argsort(names)
    rank = np.empty(len(names), np.int64)
    rank[order] = np.arange(len(names))
    return rank[coded.indices.to_numpy()], names[order]


def _ends(*sorted_by: np.ndarray) -> np.ndarray:
    """Whether a row is the last of its values."""
    return np.append(np.logical_or.reduce([x[1:] != x[:-1] for x in sorted_by]), True)


def place_events(known: pa.Table, new: pa.Table) -> tuple[pa.Table, pd.DataFrame]:
    """The events of a group's encounters with those that come, and the steps by which the encounters' places change.

    Where an encounter is follows from all of its events that are not taken back: the unit of its last admission or move,
    nowhere after its last discharge. Events of one time follow each other by their ids; of an event that comes again the
    greatest content counts, whichever came first."""
    both = pa.concat_tables([known, new])
    e, k, micros, of, here = (both[c].to_numpy() for c in ("encounter_id", "event_id", "micros", "of", "here"))
    (kind, kinds), (unit, units) = _ranks(both["kind"]), _ranks(both["unit"])
    order = np.lexsort((of, unit, micros, kind, k, e))
    e, k, kind, micros, unit, of, here, fresh = (x[order] for x in (e, k, kind, micros, unit, of, here, np.arange(len(e)) >= len(known)))

    first = np.flatnonzero(np.append(True, e[1:] != e[:-1]))
    which = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(e))))  # the encounter's number
    newest = np.maximum.reduceat(np.where(fresh, micros, np.iinfo(np.int64).min), first)
    before, after = np.full(len(first), -1), np.full(len(first), -1)
    before[which[here]] = unit[here]

    kept = _ends(e, k)
    e, k, kind, micros, unit, of, which = (x[kept] for x in (e, k, kind, micros, unit, of, which))
    is_kind = lambda name: kinds[kind] == name
    cancel = is_kind("cancel")
    stays = ~cancel
    if cancel.any():
        ids = np.unique(np.concatenate((k, of[cancel])))
        one = lambda which, k: which * len(ids) + np.searchsorted(ids, k)
        stays &= ~np.isin(one(which, k), one(which[cancel], of[cancel]))
    stays = np.flatnonzero(stays)
    stays = stays[np.lexsort((k[stays], micros[stays], which[stays]))]
    last = stays[_ends(which[stays])] if len(stays) else stays
    last = last[~is_kind("discharge")[last]]
    after[which[last]] = unit[last]
    here = np.zeros(len(e), bool)
    here[last] = True

    left, come = ((before != after) & (x >= 0) for x in (before, after))
    steps = pd.DataFrame({"unit": np.concatenate((units[before[left]], units[after[come]])), "step": np.repeat(np.array([-1, 1], "int32"), [left.sum(), come.sum()]), "micros": np.concatenate((newest[left], newest[come]))})
    return pa.table([e, k, pa.array(kinds, pa.string()).take(kind), micros, pa.array(units, pa.string()).take(unit), of, here], _HELD), steps


def forgotten_at(held: pa.Table, keep_ms: int) -> np.ndarray:
    """For each event of place_events() the time in ms at which its encounter may be forgotten; -1 while it is somewhere."""
    e = held["encounter_id"].to_numpy()
    first = np.flatnonzero(np.append(True, e[1:] != e[:-1]))
    over = np.where(np.logical_or.reduceat(held["here"].to_numpy(), first), -1, np.maximum.reduceat(held["micros"].to_numpy(), first) // 1000 + keep_ms)
    return np.repeat(over, np.diff(np.append(first, len(e))))


class Census(StatefulProcessor):
    """Keeps the events of each encounter of a group until it has been over for `keep_ms`, and gives the steps by which their
    places change.

    The places follow from the sets of events alone, so neither their order nor repeats nor corrections matter. An encounter
    that is nowhere may go at its last event's time and keep_ms: a group has a timer for the first that may, or for an earlier
    time. Events older than the watermark come too late.
    """

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("events", "events binary, timer long")

    def known(self) -> tuple[pa.Table, int]:
        found = self.held.get()
        return (_HELD.empty_table(), -1) if found is None else (pa.ipc.open_stream(found[0]).read_all(), found[1])

    def keep(self, held: pa.Table, timer: int) -> None:
        over = forgotten_at(held, self.keep_ms)
        due = int(over.min(where=over >= 0, initial=np.iinfo(np.int64).max))
        if (over >= 0).any() and (timer < 0 or due < timer):
            if timer >= 0:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(timer := due)
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, _HELD, options=pa.ipc.IpcWriteOptions(compression="zstd")) as to:
            to.write_table(held)
        self.held.update((out.getvalue().to_pybytes(), timer))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known, timer = self.known()
        lists = pd.concat(list(rows))
        new = pa.table([pa.array(np.concatenate(lists[f.name].to_list()), f.type) for f in _HELD if f.name != "here"], _HELD.names[:-1])
        new = new.filter(pa.array(new["micros"].to_numpy() > timerValues.getCurrentWatermarkInMs() * 1000))
        if len(new):
            held, steps = place_events(known, new.append_column("here", pa.repeat(False, len(new))))
            self.keep(held, timer)
            if len(steps):
                yield steps

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, _ = self.known()
        over, now = forgotten_at(held, self.keep_ms), max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        left = held.filter(pa.array((over < 0) | (over > now)))
        if len(left):
            self.keep(left, -1)
        else:
            self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


def live_census(events: DataFrame, late: str = "2 hours", keep_days: int = 30, groups: int = CENSUS_GROUPS) -> DataFrame:
    """events (CENSUS_EVENT) as steps (unit, +1 or -1, the time of the newest event behind it). The sums of the steps by unit
    are the census. Events later than `late` no longer count; encounters that are over are forgotten keep_days after their last
    event. A null unit is Unknown."""
    at, long = F.unix_micros(F.col("at").cast("timestamp")), lambda c: F.col(c).cast("long")
    real = events.where("encounter_id is not null and event_id is not null and at is not null").select(
        F.pmod(F.xxhash64(long("encounter_id")), F.lit(groups)).alias("group"), long("encounter_id").alias("encounter_id"), long("event_id").alias("event_id"), F.coalesce("kind", F.lit("")).alias("kind"),
        at.alias("micros"), F.coalesce("unit", F.lit("Unknown")).alias("unit"), F.coalesce(long("of"), F.lit(-1).cast("long")).alias("of"),
    )
    few = real.mapInArrow(dealt, "group long, newest long, encounter_id array<long>, event_id array<long>, kind array<string>, micros array<long>, unit array<string>, of array<long>")
    # the newest time is for the watermark; pandas holds those of these years
    newest = F.greatest(F.least(F.timestamp_micros("newest"), F.lit("2262-01-01").cast("timestamp")), F.lit("1678-01-01").cast("timestamp"))
    timed = few.withColumn("newest", newest).withWatermark("newest", late)
    steps = timed.groupBy("group").transformWithStateInPandas(Census(keep_days * 86_400_000), CENSUS_STEP, "Append", "EventTime")
    return steps.select("unit", "step", F.timestamp_micros("micros").alias("at"))


# ---- loads and results


def load_batches(stream: DataFrame, root: str, name: str, checkpoint: str, keys: list[str] | None = None, by: str | None = None) -> StreamingQuery:
    """Loads a stream into the versioned table at root, each batch once: upserts by keys into a keyed table, appends to a dated
    one. A version names the last batch of `name` that it holds. So a batch that was recorded, but not yet in the checkpoint
    when the job died, is left alone when it runs again."""

    def load(batch: DataFrame, number: int) -> None:
        if keys:
            versioned.upsert(batch, root, keys, by, batch=(name, number))
        else:
            versioned.append(batch, root, batch=(name, number))

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drained(stream: DataFrame, name: str, checkpoint: str, mode: str = "complete") -> DataFrame:
    """Everything there is so far, through the stream, as a table in the folder beside the checkpoint: appended files, or in
    complete mode the last batch's result as the newest version. Drained again from the same checkpoint it goes on."""
    spark, at = stream.sparkSession, f"{checkpoint.rstrip('/')}-rows"
    out = stream.writeStream.queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "complete":
        out.foreachBatch(lambda batch, _: versioned.publish(batch, at)).start().awaitTermination()
        return versioned.current(spark, at, stream.schema)
    out.format("parquet").option("path", at).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(at)
