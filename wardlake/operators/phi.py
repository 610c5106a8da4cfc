"""Protected health information: scans of values and field names, redaction, hashing and encryption of columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as st

from wardlake.functions import tables as T

REDACTED = "[REDACTED]"
#: What every text with information of a kind holds, as a pattern that is cheap to look for.
NEEDS = {
    "ssn": r"\d{4}", "phone": r"\d{4}", "email": "@", "date_of_birth": r"\d[-/]|[:=]", "mrn": r"\d{6}|(?i)mrn|(?i)record", "credit_card": r"\d{4}", "ip_address": r"\d\.\d", "license_number": "(?i)license|(?i)dl|(?i)driver",
}


def has_kind(c: Column, kind: str) -> Column:
    """Whether the text holds information of that kind; alternatives are one pattern, in either case. No pattern fits a text
    without the sign that NEEDS names, so most texts are told apart by that alone."""
    return F.coalesce(c.rlike(NEEDS[kind]) & c.rlike("(?i)" + "|".join(f"(?:{p})" for p in T.PHI_PATTERNS[kind])), F.lit(False))


def preview(c: Column) -> Column:
    return F.concat(F.substring(c, 1, 4), F.repeat(F.lit("*"), F.greatest(F.length(c) - 4, F.lit(0))))


def of_field(name: str) -> Callable[[Column], Column]:
    return lambda x: x[name]


def text_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> dict[str, Column]:
    """Each text in the schema by its path: structs are walked, and arrays and the values of maps too, whose texts are
    joined line by line."""
    out: dict[str, Column] = {}

    def walk(kind: st.DataType, at: Column, path: str, depth: int = 0) -> None:
        """at: a value, or, inside arrays (depth > 0), an array of values."""
        if path in exclude:
            return
        if isinstance(kind, st.StringType):
            out[path] = F.array_join(at, "\n") if depth else at
        elif isinstance(kind, st.StructType):
            for f in kind.fields:
                walk(f.dataType, F.transform(at, of_field(f.name)) if depth else at[f.name], f"{path}.{f.name}", depth=depth)
        elif isinstance(kind, st.ArrayType):
            walk(kind.elementType, F.flatten(F.filter(at, lambda x: x.isNotNull())) if depth else at, path, depth=1)
        elif isinstance(kind, st.MapType):
            walk(st.ArrayType(kind.valueType), F.transform(at, lambda m: F.map_values(m)) if depth else F.map_values(at), path, depth=depth)

    for f in df.schema.fields:
        walk(f.dataType, F.col(f"`{f.name}`"), f.name)
    return out


def looks_like_name(c: Column) -> Column:
    """At least two capitalised words, no digit, 2 to 100 characters."""
    words = F.filter(F.split(F.trim(c), r"\s+"), lambda w: w.rlike(r"^\p{Lu}"))
    return F.coalesce((F.size(words) >= 2) & ~c.rlike(r"\d") & F.length(c).between(2, 100), F.lit(False))


def scan(df: DataFrame, key: str, exclude: tuple[str, ...] = (), high: bool = False) -> DataFrame:
    """key, field, kind, confidence, source: one row for each kind in each text of each record, found by value, by field
    name, or, with high sensitivity and nothing else found, by looking like a name."""
    finds = []
    for path, c in text_columns(df, (*exclude, key)).items():
        one = lambda kind, sure, how, when, path=path: F.when(when, F.struct(F.lit(path).alias("field"), F.lit(kind).alias("kind"), F.lit(sure).alias("confidence"), F.lit(how).alias("found_by")))
        by_value = [one(kind, 0.9, "value", has_kind(c, kind)) for kind in T.PHI_PATTERNS]
        there = F.coalesce(F.length(c) > 0, F.lit(False))
        by_name = [one(kind, 0.8 if high else 0.6, "name", there) for kind, names in T.PHI_NAMES.items() if any(n in path.lower() for n in names)]
        finds += by_value + by_name
        if high:
            finds.append(F.when(F.coalesce(*by_value, *by_name).isNull(), one("name", 0.5, "form", looks_like_name(c))))
    hits = F.filter(F.array(*finds), lambda x: x.isNotNull())
    return df.select(key, F.explode(hits).alias("h")).select(key, "h.*")


def scan_summary(df: DataFrame, key: str, exclude: tuple[str, ...] = ()) -> DataFrame:
    """kind, field, findings, records."""
    return scan(df, key, exclude).groupBy("kind", "field").agg(F.count("*").alias("findings"), F.countDistinct(key).alias("records"))


def batch_summary(df: DataFrame, key: str, exclude: tuple[str, ...] = (), sample: int | None = None, seed: int = 5) -> DataFrame:
    """One row: records scanned, those with findings, their share in percent, all findings, and how many there are by kind and
    by field (maps). sample: so many records at most are scanned, those with the least hash of their key; several of a key
    count as they come."""
    if sample is not None:
        df = df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(sample)
    scanned = df.agg(F.count("*").alias("n"))
    found = scan(df, key, exclude)
    counted = found.groupBy("kind", "field").agg(F.count("*").alias("n"))  # a row for each kind and text of the schema
    by = lambda c: counted.groupBy(c).agg(F.sum("n").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(c, "n")))).alias("m")).scalar()
    one = found.agg(F.countDistinct(key).alias("records_with_findings"), F.count("*").alias("findings"))
    out = one.select(scanned.scalar().alias("records_scanned"), "records_with_findings", "findings")
    return out.withColumn("rate_pct", F.round(F.col("records_with_findings") / F.nullif("records_scanned", F.lit(0)) * 100, 2)).withColumns({"by_kind": by("kind"), "by_field": by("field")})


#: Fields that are never logged.
SENSITIVE = ("ssn", "social_security", "mrn", "medical_record_number", "patient_id", "dob", "date_of_birth", "phone", "email", "address", "name", "patient_name", "first_name", "last_name")


def redacted_by_name(df: DataFrame, names: tuple[str, ...] = SENSITIVE) -> DataFrame:
    """df in which nothing stays under a name of the list, at any depth: structs are rebuilt, items of arrays take their array's
    name, values of maps their keys'. A text, number or date in such a field becomes REDACTED; below a struct or a map's key of
    such a name texts do, and all else becomes null, as a map's values have one type whatever their keys. Keys of maps are
    kept, and so are values of maps whose keys are no texts, unless they hold named fields themselves."""

    def gone(kind: st.DataType, at: Column) -> Column:
        if isinstance(kind, st.StructType):
            return F.when(at.isNotNull(), F.struct(*[(F.lit(REDACTED) if f.name.lower() in names and leaf(f.dataType) else gone(f.dataType, at[f.name])).alias(f.name) for f in kind.fields]))
        if isinstance(kind, st.ArrayType):
            return F.transform(at, lambda x: gone(kind.elementType, x))
        if isinstance(kind, st.MapType):
            return F.transform_values(at, lambda k, v: gone(kind.valueType, v))
        return F.lit(REDACTED) if isinstance(kind, st.StringType) else F.lit(None).cast(kind)

    def leaf(kind: st.DataType) -> bool:
        return not isinstance(kind, (st.StructType, st.ArrayType, st.MapType))

    def clean(kind: st.DataType, at: Column, name: str) -> Column:
        if isinstance(kind, st.ArrayType):
            return F.transform(at, lambda x: clean(kind.elementType, x, name))
        if name.lower() in names:
            return F.lit(REDACTED) if leaf(kind) else gone(kind, at)
        if isinstance(kind, st.StructType):
            return F.when(at.isNotNull(), F.struct(*[clean(f.dataType, at[f.name], f.name).alias(f.name) for f in kind.fields]))
        if isinstance(kind, st.MapType):
            inside = lambda v: clean(kind.valueType, v, "")
            if isinstance(kind.keyType, st.StringType):
                return F.transform_values(at, lambda k, v: F.when(F.lower(k).isin(*names), gone(kind.valueType, v)).otherwise(inside(v)))
            return F.transform_values(at, lambda k, v: inside(v))
        return at

    return df.select(*[clean(f.dataType, F.col(f"`{f.name}`"), f.name).alias(f.name) for f in df.schema.fields])


def redacted(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with every pattern's matches in the columns replaced."""
    pattern = "(?i)" + "|".join(f"(?:{p})" for ps in T.PHI_PATTERNS.values() for p in ps)
    return df.withColumns({c: F.regexp_replace(c, pattern, REDACTED) for c in columns})


def safe_to_log(df: DataFrame, columns: list[str]) -> Column:
    return ~F.greatest(*[has_kind(F.col(c), k) for c in columns for k in T.PHI_PATTERNS])


def matching_hash(c: Column, salt: str) -> Column:
    return F.when(c.isNotNull(), F.sha2(F.concat(F.lit(salt), F.lit(":"), c.cast("string")), 256))


def encrypted(df: DataFrame, columns: list[str], key: Column) -> DataFrame:
    return df.withColumns({c: F.base64(F.aes_encrypt(F.col(c), key)) for c in columns})


def decrypted(df: DataFrame, columns: list[str], key: Column) -> DataFrame:
    return df.withColumns({c: F.aes_decrypt(F.unbase64(c), key).cast("string") for c in columns})


def rotated(df: DataFrame, columns: list[str], old: Column, new: Column) -> DataFrame:
    return encrypted(decrypted(df, columns, old), columns, new)


def of_facility(df: DataFrame, facility: str) -> DataFrame:
    return df.where(F.col("facility") == facility)
