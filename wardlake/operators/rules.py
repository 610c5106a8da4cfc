"""Data quality: rules as predicates over columns, reports, and table-level checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.functions import tables as T
from wardlake.functions.dates import parse_date
from wardlake.functions.lookup import first_hit


@dataclass(frozen=True)
class Rule:
    """Holds for a row where `holds` is true or null."""

    name: str
    entity: str
    severity: str
    holds: Column


def standard_rules(entity: str, as_of: str) -> list[Rule]:
    """The rules for one kind of record. Rules of other kinds do not apply to it."""
    c, day = F.col, F.lit(as_of).cast("date")
    if entity == "patient":
        born = parse_date(c("date_of_birth"))
        return [
            Rule("valid_mrn_format", entity, "error", F.coalesce(F.length(F.trim("mrn")) > 0, F.lit(False))),
            Rule("valid_dob", entity, "error", c("date_of_birth").isNull() | F.coalesce(born <= day, F.lit(False))),
            Rule("reasonable_dob", entity, "warning", c("date_of_birth").isNull() | F.coalesce(born >= F.add_months(day, -1800), F.lit(False))),
            Rule("valid_gender", entity, "warning", F.lower("gender").isin("male", "female", "other", "unknown", "m", "f", "o", "u")),
        ]
    if entity == "encounter":
        stay = F.timestamp_diff("SECOND", c("admission_date"), c("discharge_date"))
        return [Rule("valid_encounter_dates", entity, "error", stay >= 0), Rule("reasonable_los", entity, "warning", stay <= 365 * 86400)]
    if entity == "diagnosis":
        return [Rule("valid_icd10_format", entity, "error", F.replace(F.upper(F.trim("code")), F.lit("."), F.lit("")).rlike(r"^[A-TV-Z]\d[A-Z\d]{0,5}$"))]
    if entity == "lab":
        value, name = c("value").try_cast("double"), F.upper("test_name")
        plausible = first_hit(name, [(k, value.between(float(a), float(b))) for k, (a, b) in T.PLAUSIBLE_LABS.items()])
        return [Rule("valid_lab_value", entity, "error", c("value").isNull() | value.isNotNull()), Rule("lab_value_in_range", entity, "warning", plausible)]
    s, d = c("systolic_bp"), c("diastolic_bp")
    return [
        Rule("valid_heart_rate", entity, "error", c("heart_rate").between(20, 300)),
        Rule("valid_blood_pressure", entity, "error", F.coalesce(s.between(40, 300), F.lit(True)) & F.coalesce(d.between(20, 200), F.lit(True)) & F.coalesce(d < s, F.lit(True))),
        Rule("valid_temperature", entity, "error", c("temperature").between(85, 115)),
        Rule("valid_oxygen_saturation", entity, "error", c("oxygen_saturation").between(0, 100)),
    ]


def user_rule(df: DataFrame, name: str, entity: str, severity: str, text: str) -> Rule:
    """A rule of the user's own, as SQL over the record's columns (`heart_rate * 2 < try_cast(note as int)`). A text that Spark
    cannot resolve on df is a rule that every record fails, as a check that cannot be made has not been passed."""
    try:
        holds = F.expr(text)
        df.select(holds.cast("boolean")).schema  # noqa: B018  resolves the text
    except PySparkException:
        holds = F.lit(False)
    return Rule(name, entity, severity, holds)


def with_rules(rules: list[Rule], add: list[Rule] = (), remove: tuple[str, ...] = (), only: tuple[str, ...] | None = None) -> list[Rule]:
    """rules less those of the names to remove, and with others, which replace rules of their names; only: the names to apply."""
    new = {r.name for r in add}
    out = [r for r in rules if r.name not in {*remove, *new}] + [r for r in add if r.name not in remove]
    return [r for r in out if only is None or r.name in only]


def failures_by_rule(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """rule, severity, failures and records, for every rule, also one that no record fails."""
    counts = df.agg(F.count("*").alias("records"), *[F.count_if(~F.coalesce(r.holds.cast("boolean"), F.lit(True))).alias(f"n{k}") for k, r in enumerate(rules)])
    each = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), F.col(f"n{k}").alias("failures")) for k, r in enumerate(rules)])
    return counts.select(F.explode(each).alias("r"), "records").select("r.*", "records")


def checked(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """df with `_violations`, an array of (rule, severity), in one pass for all rules."""
    failed = [F.when(~F.coalesce(r.holds, F.lit(True)), F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"))) for r in rules]
    return df.withColumn("_violations", F.filter(F.array(*failed), lambda x: x.isNotNull()))


def violations(df: DataFrame, rules: list[Rule], key: str) -> DataFrame:
    return checked(df, rules).select(key, F.explode("_violations").alias("v")).select(key, "v.rule", "v.severity")


def report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row: records, valid and invalid ones (with an error), errors, warnings and the rate of invalid records."""
    of = lambda kind: F.size(F.filter("_violations", lambda v: v.severity == kind))
    got = checked(df, rules).select(of("error").alias("e"), of("warning").alias("w"))
    one = got.agg(F.count("*").alias("total"), F.count_if(F.col("e") == 0).alias("valid"), F.coalesce(F.sum("e"), F.lit(0)).alias("errors"), F.coalesce(F.sum("w"), F.lit(0)).alias("warnings"))
    return one.select("total", "valid", (F.col("total") - F.col("valid")).alias("invalid"), "errors", "warnings", F.round((F.col("total") - F.col("valid")) / F.nullif("total", F.lit(0)) * 100, 2).alias("error_rate_pct"))


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return child.join(parent.select(key).distinct(), key, "left_anti").agg(F.count("*").alias("orphans"))


def missing_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns])


def duplicates(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("rows")).where("rows > 1")


def npi_valid(npi: Column) -> Column:
    """Ten digits whose Luhn sum, after the fixed prefix 80840, fits."""
    return F.coalesce(npi.rlike(r"^\d{10}$") & F.call_function("luhn_check", F.concat(F.lit("80840"), npi)), F.lit(False))


def dotted_icd10(code: Column) -> Column:
    """A letter, two digits and, after a dot, up to four letters or digits."""
    return F.coalesce(code.rlike(r"^[A-Z][0-9]{2}(\.[0-9A-Z]{0,4})?$"), F.lit(False))


def not_deprecated(code: Column, deprecated: list[str]) -> Column:
    return ~F.coalesce(code.isin(*deprecated), F.lit(False)) if deprecated else F.lit(True)


def future_admissions(encounters: DataFrame, as_of: str) -> DataFrame:
    """Admissions more than a day ahead."""
    return encounters.agg(F.count_if(F.col("admission_date") > F.lit(as_of).cast("timestamp_ntz") + F.make_interval(days=F.lit(1))).alias("future"))


def encounter_checks(encounters: DataFrame, as_of: str, created: str = "created_at") -> DataFrame:
    """Missing admissions, types and patients among the rows of the last day."""
    recent = encounters.where(F.col(created) >= F.date_sub(F.lit(as_of).cast("date"), 1))
    return missing_counts(recent, ["admission_date", "encounter_type", "patient_id"])


def issues(encounters: DataFrame, patients: DataFrame, diagnoses: DataFrame, as_of: str, created: str = "created_at") -> DataFrame:
    """check, count, severity: one row for each table check that finds something."""
    one = lambda name, severity, df, c: df.select(F.lit(name).alias("check"), F.col(c).cast("long").alias("count"), F.lit(severity).alias("severity"))
    missing = encounter_checks(encounters, as_of, created)
    found = [
        one("orphaned_encounters", "warning", orphans(encounters, patients, "patient_id"), "orphans"),
        one("required_fields_encounters", "error", missing.select(sum((F.col(c) for c in missing.columns), F.lit(0)).alias("n")), "n"),
        one("duplicate_mrns", "warning", duplicates(patients, "mrn").agg(F.count("*").alias("n")), "n"),
        one("future_dates", "warning", future_admissions(encounters, as_of), "future"),
        one("invalid_icd_codes", "warning", diagnoses.agg(F.count_if(F.col("code").isNotNull() & ~dotted_icd10(F.col("code"))).alias("n")), "n"),
    ]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.where("count > 0")
