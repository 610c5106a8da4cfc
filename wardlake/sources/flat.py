"""Delimited files: one glob for each kind of record, every column read as text, names brought to canonical ones."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: What exports call the canonical columns, by kind of record.
ALIASES = {
    "patients": {
        "source_id": ["patient_id"], "mrn": ["mrn", "medical_record_number"], "first_name": ["first_name"], "last_name": ["last_name"],
        "date_of_birth": ["date_of_birth", "dob", "birth_date"], "gender": ["gender", "sex"], "address_line1": ["address", "address_line_1"], "city": ["city"], "state": ["state"],
        "postal_code": ["zip", "zip_code", "postal_code"], "phone": ["phone", "phone_number"], "email": ["email", "email_address"], "ssn": ["ssn", "social_security"],
    },
    "encounters": {
        "source_id": ["encounter_id", "visit_id"], "patient_id": ["patient_id", "patient_mrn"], "encounter_type": ["encounter_type", "visit_type", "class"],
        "admission_date": ["admission_date", "admit_date", "arrival_date"], "discharge_date": ["discharge_date", "departure_date"], "location": ["location", "department", "unit"],
        "attending_provider": ["provider", "attending_physician"], "status": ["status"],
    },
    "diagnoses": {
        "source_id": ["diagnosis_id"], "patient_id": ["patient_id"], "encounter_id": ["encounter_id", "visit_id"], "code": ["code", "icd_code", "diagnosis_code", "icd10_code"],
        "description": ["description", "diagnosis_description"], "diagnosis_type": ["type", "diagnosis_type"], "onset_date": ["onset_date", "diagnosis_date"],
    },
    "labs": {
        "source_id": ["result_id", "lab_id"], "patient_id": ["patient_id"], "encounter_id": ["encounter_id"], "code": ["test_code", "loinc_code", "order_code"],
        "description": ["test_name", "result_name"], "value": ["result_value", "value", "numeric_value"], "value_unit": ["result_unit", "unit", "units"],
        "reference_range_low": ["reference_low", "ref_range_low"], "reference_range_high": ["reference_high", "ref_range_high"], "interpretation": ["abnormal_flag", "flag"],
        "effective_date": ["result_date", "collection_date", "test_date"],
    },
}
ALIASES["vitals"] = ALIASES["labs"]
PATTERNS = {"patients": "patient*.csv", "encounters": "encounter*.csv", "diagnoses": "diagnos*.csv", "procedures": "procedure*.csv", "labs": "lab*.csv", "vitals": "vital*.csv", "medications": "medication*.csv"}
CORRUPT = "_corrupt"
#: A record: what lies between line breaks that are not in quotes.
RECORD = r'(?:"(?:[^"]|"")*+"|[^"\n]++|")++'


def plain(name: str) -> str:
    return "_".join(name.strip().lower().split())


def files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """path of each file with content that a glob finds under a folder; of folders among them, all files below. Spark lists
    them and opens none."""
    try:
        return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{folder}/{pattern}").where("length > 0").select("path")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string")


def first_line(path: str, skip: int, encoding: str) -> str:
    """The line after `skip` others: as many KB of the file as it takes, compressed or not."""
    plain_path = re.sub("^file:/*", "/", path)
    store, at = (fs.LocalFileSystem(), plain_path) if plain_path.startswith("/") else fs.FileSystem.from_uri(path)
    with store.open_input_stream(at, compression="detect") as stream, io.TextIOWrapper(stream, encoding, errors="replace", newline=None) as text:
        for _ in range(skip):
            text.readline()
        return text.readline().rstrip("\r\n").removeprefix("\ufeff")


def headers(found: DataFrame, sep: str = ",", skip_rows: int = 0, encoding: str = "UTF-8") -> DataFrame:
    """path and names (of the header's columns) of each of the files: tasks read their beginnings."""

    def first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([header_names(first_line(p, skip_rows, encoding), sep) for p in paths], pa.list_(pa.string()))], ["path", "names"])

    tasks = found.sparkSession.sparkContext.defaultParallelism * 4
    return found.repartition(tasks, "path").mapInArrow(first_lines, "path string, names array<string>")


def header_names(line: str, sep: str) -> list[str]:
    """Column names of a header line, plain; a name that comes again gets a number."""
    names = [plain(n) for n in next(csv.reader([line], delimiter=sep), [])]
    return [n if names[:i].count(n) == 0 else f"{n}_{names[:i].count(n) + 1}" for i, n in enumerate(names)]


def read(spark: SparkSession, folder: str, kind: str, columns: list[str] | None = None, sep: str = ",", encoding: str = "UTF-8", header: bool = True, skip_rows: int = 0, multi_line: bool = False) -> DataFrame:
    """All files of a kind, each bound by the names of its own header, with their provenance and, for lines that do not fit
    it, the line in `_corrupt`. Files with the same header are one scan; a column that some files lack is null there. Without
    a header all files have `columns`, in order. No file: no rows.

    skip_rows lines before the header are dropped; such files are read whole, one to a task. A quoted field may hold line breaks
    there, and in all files with `multi_line`, which keeps Spark from cutting a file between tasks.

    Tasks read the headers, and the driver gets the paths of each distinct header, which the scans need.
    """
    found = files(spark, folder, PATTERNS[kind])
    known = headers(found, sep, skip_rows, encoding) if header else found.withColumn("names", F.array(*[F.lit(plain(c)) for c in columns]))
    groups = {tuple(r["names"]): sorted(r["paths"]) for r in known.groupBy("names").agg(F.collect_list("path").alias("paths")).collect()}
    frames = []
    for names, paths in sorted(groups.items()):
        schema = StructType([StructField(c, StringType()) for c in [*names, CORRUPT]])
        options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "nullValue": "", "escape": '"'}
        if skip_rows:
            text = spark.read.text(paths, wholetext=True).withColumn("_source_file", F.element_at(F.split(F.input_file_name(), "/"), -1))
            body = F.regexp_replace("value", rf"^(?:[^\n]*\n){{{skip_rows}}}", "")
            lines = text.select(F.explode(F.slice(F.regexp_extract_all(body, F.lit(RECORD), F.lit(0)), F.lit(1 + header), F.lit(2**31 - 1))).alias("line"), "_source_file").where("trim(line, '\r') != ''")
            ddl = ", ".join(f"`{f.name}` string" for f in schema.fields)
            frames.append(lines.select(F.from_csv(F.rtrim("line", F.lit("\r")), ddl, {**options, "multiLine": "true"}).alias("r"), "_source_file").select("r.*", "_source_file"))
        else:
            lines = spark.read.schema(schema).options(encoding=encoding, header=header, multiLine=multi_line, **options).csv(paths)
            frames.append(lines.withColumn("_source_file", F.element_at(F.split(F.input_file_name(), "/"), -1)))
    if not frames:
        none = StructType([StructField(c, StringType()) for c in [*map(plain, columns or []), CORRUPT, "_source_file"]])
        frames = [spark.createDataFrame([], none)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).withColumn("_import_timestamp", F.current_timestamp())


def preview(spark: SparkSession, path: str, rows: int = 5, sep: str = ",") -> DataFrame:
    """The first rows of one file, under its own column names."""
    return spark.read.csv(path, header=True, sep=sep).limit(rows)


def arriving(spark: SparkSession, folder: str, kind: str | None, columns: list[str], archive: str | None = None, sep: str = ",") -> DataFrame:
    """The files of a kind (or all) as a stream, each read once. Consumed ones are moved to the archive folder, if one is given."""
    reader = spark.readStream.schema(StructType([StructField(c, StringType()) for c in columns])).options(sep=sep, header=True, enforceSchema=False, pathGlobFilter=PATTERNS.get(kind, "*"))
    if archive:
        reader = reader.options(cleanSource="archive", sourceArchiveDir=archive)
    return reader.csv(folder)


def canonical(df: DataFrame, kind: str, custom: dict[str, str] | None = None) -> DataFrame:
    """The canonical columns that the file has, blank as null. Names are compared without case; several names of one
    column are coalesced, custom ones (file's name: canonical) first. Kinds without names of their own keep all columns."""
    have = {plain(c): c for c in df.columns}
    own: dict[str, list[str]] = {}
    for name, to in (custom or {}).items():
        own.setdefault(to, []).append(plain(name))
    for to, names in ALIASES.get(kind, {}).items():
        own.setdefault(to, []).extend(names)
    cols = [F.coalesce(*[F.nullif(F.trim(F.col(f"`{have[n]}`")), F.lit("")) for n in names if n in have]).alias(to) for to, names in own.items() if any(n in have for n in names)]
    if not own:
        cols = [F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")).alias(n) for n, c in have.items() if not c.startswith("_")]
    return df.select(*cols, *[c for c in df.columns if c in ("_source_file", "_import_timestamp")])


def quarantined(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fitting rows, lines that do not fit with their file)."""
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT), df.where(F.col(CORRUPT).isNotNull()).select(CORRUPT, "_source_file")


def joined_time(day: Column, clock: Column) -> Column:
    """A timestamp from yyyyMMdd and HHmm columns, the latter padded."""
    return F.try_to_timestamp(F.concat(F.regexp_replace(day, "-", ""), F.lpad(F.coalesce(clock, F.lit("0")), 4, "0")), F.lit("yyyyMMddHHmm"))
