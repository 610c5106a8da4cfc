"""Database tables: JDBC or catalog, and SQL of the user's own with named parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes below which a table is small.
SMALL = 1 << 30


def read_parquet(spark: SparkSession, *paths: str, wide: bool = False) -> DataFrame:
    """Parquet files. For wide work, much of it for each row, a small table of fewer files than the session has cores is dealt
    out over them, as a small file is often one row group and so one task. Other tables are read as they lie, without a
    shuffle. Filters and columns reach the scan either way."""
    df = spark.read.parquet(*paths)
    cores = spark.sparkContext.defaultParallelism
    if not wide or len(df.inputFiles()) >= cores:
        return df
    size = spark.read.format("binaryFile").load(list(paths)).agg(F.sum("length")).first()[0] or 0  # lists files, opens none
    return df.repartition(cores) if size < SMALL else df


def read_jdbc(
    spark: SparkSession, url: str, name: str, split_on: str | None = None, low: object = None, high: object = None, parts: int = 8,
    since: str | None = None, at: str = "updated_at", ids: DataFrame | None = None, id_column: str = "patient_id", **options: str,
) -> DataFrame:
    """A table read in `parts` ranges of a numeric, date or time column, or in one. Without bounds the database is asked for the
    column's least and greatest value; they only deal out the rows, none is left out. since: rows of that time or later, which
    the database filters; ids: rows of these ids."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=name, **options)
    by_name = {c.lower(): c for c in reader.load().columns}
    if split_on:
        split_on = by_name[split_on.lower()]
        if low is None or high is None:
            quoted = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(split_on)
            found = spark.read.format("jdbc").options(url=url, dbtable=f"(select min({quoted}) as low, max({quoted}) as high from {name}) bounds", **options).load().first()
            low, high = (b if a is None else a for a, b in zip((low, high), found, strict=True))
        if low is not None and low != high:  # without rows, or with one value, there is nothing to deal out
            reader = reader.options(partitionColumn=split_on, lowerBound=str(low), upperBound=str(high), numPartitions=parts)
    df = reader.load()
    if since is not None:
        df = df.where(F.col(by_name[at.lower()]) >= F.lit(since).cast(dict(df.dtypes)[by_name[at.lower()]]))
    if ids is not None:
        key = by_name[id_column.lower()]
        df = df.join(ids.select(F.col(id_column).alias(key)).distinct(), key, "left_semi").select(df.columns)
    return df


def read_table(spark: SparkSession, name: str, since: str | None = None, at: str = "updated_at", ids: DataFrame | None = None, id_column: str = "patient_id", schema: str = "source_id string") -> DataFrame:
    """A catalog table; rows changed since, and rows of the given ids, where it has the columns. Without such a table: no
    rows, with the schema asked for."""
    if not spark.catalog.tableExists(name):
        return spark.createDataFrame([], schema)
    df = spark.table(name)
    if since is not None and at in df.columns:
        df = df.where(F.col(at) >= F.lit(since).cast(dict(df.dtypes)[at]))
    if ids is not None and id_column in df.columns:
        df = df.join(ids.select(id_column).distinct(), id_column, "left_semi")
    return df


#: SQL of two common hospital systems' tables, as canonical fields.
MAPPINGS = {
    "a_patients": "select PAT_ID as source_id, PAT_MRN_ID as mrn, PAT_FIRST_NAME as first_name, PAT_LAST_NAME as last_name, BIRTH_DATE as date_of_birth, SEX_C as gender, ADD_LINE_1 as address_line1, CITY as city, STATE_C as state, ZIP as postal_code, HOME_PHONE as phone, EMAIL_ADDRESS as email, UPDATE_DATE as updated_at from PATIENT where UPDATE_DATE > :since",
    "a_encounters": "select PAT_ENC_CSN_ID as source_id, PAT_ID as patient_id, ENC_TYPE_C as encounter_type, HOSP_ADMSN_TIME as admission_date, HOSP_DISCH_TIME as discharge_date, DEPARTMENT_ID as location, VISIT_PROV_ID as attending_provider, UPDATE_DATE as updated_at from PAT_ENC where UPDATE_DATE > :since",
    "b_patients": "select person_id as source_id, alias as mrn, name_first as first_name, name_last as last_name, birth_dt_tm as date_of_birth, sex_cd as gender, street_addr as address_line1, city, state, zipcode as postal_code, phone_num as phone, p.updt_dt_tm as updated_at from PERSON p join PERSON_ALIAS using (person_id) join ADDRESS a on p.person_id = a.parent_entity_id where p.updt_dt_tm > :since and alias_pool_cd = (select code_value from CODE_VALUE where CDF_MEANING = 'MRN')",
}


def mapped_records(spark: SparkSession, name: str, since: str) -> DataFrame:
    """The records of a known system whose tables are in the catalog, changed after a time."""
    return spark.sql(MAPPINGS[name], args={"since": since})


def tables(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t.name, t.isTemporary) for t in spark.catalog.listTables()], "name string, temporary boolean")


def query(spark: SparkSession, text: str, **parameters: object) -> DataFrame:
    return spark.sql(text, args=parameters)


def columns(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([(c.name, c.dataType, c.nullable) for c in spark.catalog.listColumns(name)], "name string, type string, nullable boolean")
