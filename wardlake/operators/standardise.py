"""Standard forms of patients, encounters, diagnoses, procedures, labs, vitals and medications.

Each function adds columns to a DataFrame in the canonical schema and an `_errors` array; split() divides it into valid
and rejected rows. All columns are built-in expressions, so each runs inside the scan's stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.functions import tables as T
from wardlake.functions.dates import age, age_band, parse_date
from wardlake.functions.lookup import any_word, filled, first_hit, first_match, first_word, mapped, steps


def errors(*rules: tuple[str, Column]) -> Column:
    """Messages of the rules that hold."""
    return F.filter(F.array(*[F.when(c, F.lit(text)) for text, c in rules]), lambda x: x.isNotNull())


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with `_errors`)."""
    return df.where(F.size("_errors") == 0).drop("_errors"), df.where(F.size("_errors") > 0)


def held(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column, or nulls of that type where records do not have it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def present(df: DataFrame, **columns: Column) -> list[Column]:
    """Those of the named columns whose field the records have."""
    return [c.alias(name) for name, c in columns.items() if name in df.columns]


def title_name(c: Column) -> Column:
    """Trimmed; title case only where all letters are upper or all lower; every run of letters is capitalised."""
    t = F.trim(c)
    parts = F.regexp_extract_all(F.lower(t), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    title = F.array_join(F.transform(parts, lambda x: F.initcap(x)), "")
    return F.substring(F.when((F.upper(t) == t) | (F.lower(t) == t), title).otherwise(t), 1, 100)


def phone(c: Column) -> Column:
    d = F.regexp_replace(c, "[^0-9]", "")
    d = F.when((F.length(d) == 11) & d.startswith("1"), F.substring(d, 2, 10)).otherwise(d)
    return F.when(filled(c).isNull(), None).when(F.length(d) == 10, F.concat(F.lit("("), F.substring(d, 1, 3), F.lit(") "), F.substring(d, 4, 3), F.lit("-"), F.substring(d, 7, 4))).otherwise(F.substring(c, 1, 30))


def ssn_hash(c: Column, salt: str) -> Column:
    d = F.regexp_replace(c, "[^0-9]", "")
    return F.when(c.isNull(), None).when(F.length(d) == 9, F.sha2(F.concat(F.lit(salt), d), 256)).otherwise("")


def patients(df: DataFrame, as_of: str, salt: str = "wardlake") -> DataFrame:
    """Unmapped genders become unknown and empty ones null; postal codes are padded to five digits."""
    code = F.regexp_replace(F.trim("postal_code"), " ", "")
    state, mail, years = F.upper(filled(F.col("state"))), F.lower(filled(F.col("email"))), age(parse_date(F.col("date_of_birth")), F.lit(as_of).cast("date"))
    marital = F.upper(filled(F.col("marital_status")))
    return df.select(
        "patient_id",
        "mrn",
        title_name(F.col("first_name")).alias("first_name"),
        title_name(F.col("last_name")).alias("last_name"),
        mapped(F.lower(filled(F.col("gender"))), T.GENDER, F.lit("unknown")).alias("gender"),
        parse_date(F.col("date_of_birth")).alias("date_of_birth"),
        F.substring(F.when(code.rlike(r"^\d{1,4}$"), F.lpad(code, 5, "0")).otherwise(code), 1, 10).alias("postal_code"),
        F.when(F.length(state) == 2, state).otherwise(mapped(state, T.STATES, F.substring(state, 1, 2))).alias("state"),
        phone(F.col("phone")).alias("phone"),
        F.when(mail.contains("@"), F.substring(mail, 1, 100)).alias("email"),
        mapped(marital, T.MARITAL, F.lower(marital)).alias("marital_status"),
        ssn_hash(F.col("ssn"), salt).alias("ssn_hash"),
        years.alias("age"),
        age_band(years).alias("age_group"),
        *present(df, address_line1=F.col("address_line1") if "address_line1" in df.columns else F.lit(None), country=F.coalesce(filled(held(df, "country")), F.lit("USA"))),
        errors(("patient_id is missing", filled(F.col("patient_id")).isNull())).alias("_errors"),
    )


def encounters(df: DataFrame) -> DataFrame:
    """Statuses are mapped; reversed stays are turned round; stays in hours and days, flags, and arrival hour and weekday of emergencies."""
    kind = F.lower(filled(F.col("encounter_type")))
    kind = mapped(kind, T.ENCOUNTER_TYPE, kind)
    a, b = F.col("admission_date"), F.col("discharge_date")
    both = a.isNotNull() & b.isNotNull()
    start, end = F.when(both, F.least(a, b)).otherwise(a), F.when(both, F.greatest(a, b)).otherwise(b)
    hours = F.timestamp_diff("SECOND", start, end) / 3600.0
    er, status = kind == "emergency", F.lower(filled(held(df, "status")))
    return df.select(
        "encounter_id", "patient_id", kind.alias("encounter_type"), start.alias("admission_date"), end.alias("discharge_date"), "department", "discharge_disposition", "primary_diagnosis_code", "drg_code", "total_charges",
        F.round(hours, 2).alias("los_hours"), F.round(hours / 24, 2).alias("los_days"),
        F.coalesce(kind == "inpatient", F.lit(False)).alias("is_inpatient"), F.coalesce(er, F.lit(False)).alias("is_emergency"), end.isNotNull().alias("is_completed"),
        F.when(er, F.hour(start)).alias("arrival_hour"), F.when(er, F.date_format(start, "EEEE")).alias("arrival_day"),
        *present(df, status=mapped(status, T.ENCOUNTER_STATUS, status), **{c: held(df, c) for c in ("facility", "location", "attending_provider", "admit_source", "financial_class")}),
        errors(("encounter_id is missing", filled(F.col("encounter_id")).isNull()), ("patient_id is missing", filled(F.col("patient_id")).isNull())).alias("_errors"),
    )


def diagnosis_code(c: Column) -> Column:
    return F.nullif(F.replace(F.upper(F.trim(c)), F.lit("."), F.lit("")), F.lit(""))


def code_system(df: DataFrame, aliases: dict[str, str], found: Column) -> Column:
    """The system that a record names, by its usual name, else the one that its code's form tells."""
    named = F.upper(filled(held(df, "code_system")))
    return F.coalesce(mapped(named, aliases, named), found)


def diagnoses(df: DataFrame) -> DataFrame:
    """What several columns need is worked out first, in steps of its own."""
    df = df.withColumn("_code", diagnosis_code(F.col("code")))
    df = df.withColumn("_system", code_system(df, T.DIAGNOSIS_SYSTEM, first_match(F.col("_code"), T.DIAGNOSIS_CODES, "UNKNOWN")))
    code, system = F.col("_code"), F.col("_system")
    icd10, three = system == "ICD-10-CM", F.substring(code, 1, 3)
    kind, poa = F.lower(filled(F.col("diagnosis_type"))), F.upper(filled(F.col("present_on_admission")))
    flags = {"is_diabetes": three.isin("E10", "E11", "E13"), "is_hypertension": three.isin("I10", "I11", "I12", "I13"), "is_chf": three == "I50", "is_copd": three == "J44", "is_ckd": three == "N18", "is_cancer": code.startswith("C")}
    return df.select(
        "encounter_id", "patient_id", "rank", code.alias("code"), system.alias("code_system"), mapped(kind, T.DIAGNOSIS_TYPE, kind).alias("diagnosis_type"), mapped(poa, T.PRESENT_ON_ADMISSION, poa).alias("present_on_admission"),
        F.when(icd10, mapped(F.substring(code, 1, 1), T.CHAPTERS)).alias("chapter"), F.when(icd10 & (F.length(code) >= 3), three).alias("category"), F.when(icd10 & (F.length(code) >= 4), F.substring(code, 1, 4)).alias("subcategory"),
        *[F.coalesce(c, F.lit(False)).alias(name) for name, c in flags.items()],
        F.when(F.length(code) > 3, F.concat(three, F.lit("."), F.expr("substring(_code, 4)"))).otherwise(code).alias("display_code"),
        *present(df, onset_date=held(df, "onset_date", "date"), description=F.substring(held(df, "description"), 1, 500)),
        errors(("code is missing", code.isNull()), ("rank is below 1", F.col("rank") < 1)).alias("_errors"),
    )


def procedures(df: DataFrame) -> DataFrame:
    """What several columns need is worked out first, in steps of its own."""
    df = df.withColumn("_code", diagnosis_code(F.col("code")))
    df = df.withColumn("_system", code_system(df, T.PROCEDURE_SYSTEM, first_match(F.col("_code"), T.PROCEDURE_CODES, "UNKNOWN")))
    df = df.withColumn("_number", F.when(F.col("_system") == "CPT-4", F.col("_code").try_cast("int")))
    code, system, number = F.col("_code"), F.col("_system"), F.col("_number")
    status = F.lower(filled(held(df, "status")))
    cpt = system == "CPT-4"
    low, high, name = T.CPT_CATEGORIES[0]
    category = F.when(number.between(low, high), name)
    for low, high, name in T.CPT_CATEGORIES[1:]:
        category = category.when(number.between(low, high), name)
    return df.select(
        "encounter_id", "patient_id", code.alias("code"), system.alias("code_system"), category.alias("category"), F.coalesce(number.between(10000, 69999), F.lit(False)).alias("is_surgical"),
        F.coalesce(cpt & code.startswith("99"), F.lit(False)).alias("is_em"), "duration_minutes", "performed_date", F.date_format("performed_date", "EEEE").alias("procedure_day"), F.hour("performed_date").alias("procedure_hour"), "charges", *present(df, status=mapped(status, T.PROCEDURE_STATUS, status)),
        errors(("code is missing", code.isNull())).alias("_errors"),
    )


def lab_number(c: Column) -> Column:
    """The number in a result: leading < and > and a trailing % are dropped; other text gives null."""
    return F.regexp_replace(F.regexp_replace(F.trim(c), "^[<>]+", ""), "%$", "").try_cast("double")


def labs(df: DataFrame) -> DataFrame:
    """A record's own bounds stay; missing ones come from the table of usual ranges where there is a number. Flags are null
    where nothing is known."""
    df = df.withColumns({"_name": F.upper("test_name"), "_value": lab_number(F.col("value"))})
    name, value, n = F.col("_name"), F.col("_value"), F.lit(None).cast("double")
    struct = lambda r: F.struct(*[(n if x is None else F.lit(float(x))).alias(k) for k, x in zip(("low", "high", "critical_low", "critical_high"), r, strict=True)])
    df = df.withColumn("_usual", first_hit(name, [(k, struct(r)) for k, r in T.LAB_RANGES.items()]))
    usual = F.col("_usual")
    low, high = (F.coalesce(held(df, f"reference_range_{k}", "double"), F.when(value.isNotNull(), usual[k])) for k in ("low", "high"))
    status = F.lower(filled(held(df, "status")))
    abnormal = F.when(value.isNull(), None).when(value < low, True).when(value > high, True).when(low.isNotNull() | high.isNotNull(), False)
    critical = F.when(value.isNull() | usual.isNull(), None).when(value < usual["critical_low"], True).when(value > usual["critical_high"], True).otherwise(False)
    delta = F.when(value.isNull(), None).when(value < low, F.round(value - low, 2)).when(value > high, F.round(value - high, 2)).otherwise(0.0)
    flag = F.upper(filled(F.col("interpretation")))
    return df.select(
        "source_id", "patient_id", "test_name", value.alias("value"), F.when(value.isNull(), F.col("value")).alias("value_string"), low.alias("reference_low"), high.alias("reference_high"),
        mapped(flag, T.INTERPRETATION, F.lower(flag)).alias("interpretation"), abnormal.alias("is_abnormal"), critical.alias("is_critical"), delta.alias("delta"),
        F.coalesce(first_word(name, T.LAB_CATEGORIES), F.lit("other")).alias("category"), F.col("effective_date"),
        *present(df, value_unit=held(df, "value_unit"), status=mapped(status, T.LAB_STATUS, status)),
        errors(("source_id is missing", F.col("source_id").isNull())).alias("_errors"),
    )


def vital_status(name: str, v: Column) -> Column:
    low, high, critical_low, critical_high = T.VITAL_RANGES[name]
    return F.when(v.isNull(), None).when(v < critical_low, "critical_low").when(v > critical_high, "critical_high").when(v < low, "low").when(v > high, "high").otherwise("normal")


def news_score(v: dict[str, Column], oxygen: Column) -> Column:
    """Early warning points; null where none of the five measures is known. Oxygen adds two."""
    known = F.coalesce(*v.values()).isNotNull()
    return F.when(known, sum((F.coalesce(steps(v[k], t), F.lit(0)) for k, t in T.NEWS.items()), F.when(oxygen, 2).otherwise(0)))


def bp_class(s: Column, d: Column) -> Column:
    return F.when(s.isNull() | d.isNull(), None).when((s < 120) & (d < 80), "normal").when((s < 130) & (d < 80), "elevated").when((s < 140) | (d < 90), "stage_1").when((s < 180) & (d < 120), "stage_2").otherwise("crisis")


def vitals(df: DataFrame) -> DataFrame:
    """Temperatures below 50 are Celsius. A measured mean pressure and a given body mass index stay, others are worked out,
    in pounds and inches too. A value outside its limits rejects the record."""
    t = F.col("temperature")
    t = F.when(t < 50, F.round(t * 9 / 5 + 32, 1)).otherwise(t)
    s, d = F.col("systolic_bp"), F.col("diastolic_bp")
    own = lambda name: F.nullif(held(df, name, "double"), F.lit(0.0))  # noqa: E731  zero counts as missing
    unit = lambda name: F.lower(held(df, name))
    m = F.when(unit("height_unit").isin("in", "inches"), F.col("height") * 0.0254).otherwise(F.col("height") / 100)
    kilos = F.when(unit("weight_unit").isin("lb", "lbs", "pounds"), F.col("weight") * 0.453592).otherwise(F.col("weight"))
    v = {k: F.col(k) for k in ("heart_rate", "respiratory_rate", "systolic_bp", "diastolic_bp", "oxygen_saturation")} | {"temperature": t}
    news = news_score({k: v[k] for k in T.NEWS}, filled(F.col("oxygen_device")).isNotNull() | F.coalesce(held(df, "fio2", "double") > 0.21, F.lit(False)))
    if "pain_score" in df.columns:
        v["pain_score"] = F.col("pain_score")
    pressure = F.coalesce(own("mean_arterial_pressure"), F.round((F.nullif(s, F.lit(0.0)) + 2 * F.nullif(d, F.lit(0.0))) / 3, 1))
    bmi = F.coalesce(own("bmi"), F.when((m > 0) & (kilos > 0), F.round(kilos / (m * m), 1)))
    limited = v | {"mean_arterial_pressure": pressure, "bmi": bmi} | {k: held(df, k, "double") for k in T.VITAL_LIMITS if k not in v and k not in ("mean_arterial_pressure", "bmi")}
    return df.select(
        "source_id", "patient_id", "recorded_date", "heart_rate", "respiratory_rate", "systolic_bp", "diastolic_bp", t.alias("temperature"), "oxygen_saturation",
        pressure.alias("mean_arterial_pressure"), bmi.alias("bmi"),
        *[vital_status(k, c).alias(f"{k}_status") for k, c in v.items()], news.alias("news_score"),
        F.when(news <= 4, "low").when(news <= 6, "medium").when(news.isNotNull(), "high").alias("news_risk"), bp_class(s, d).alias("bp_class"),
        errors(*[(f"{k} is out of range", ~limited[k].between(*T.VITAL_LIMITS[k])) for k in T.VITAL_LIMITS]).alias("_errors"),
    )


def medications(df: DataFrame, compat: bool = False) -> DataFrame:
    """Status, the dose that the record gives or else its name, class, alerts and doses a day. With compat, dose patterns are tried in the table's order."""
    df = df.withColumns({"_name": F.lower("medication_name"), "_often": F.lower("frequency")})
    df = df.withColumn("_alert", first_word(F.col("_name"), T.HIGH_ALERT))
    name, route, often = F.col("_name"), F.lower(filled(F.col("route"))), F.col("_often")
    dose = r"(\d+\.?\d*)\s*(mg|g|mcg|ml|unit|units|meq)"
    patterns = list(T.DOSES_A_DAY.items()) if compat else sorted(T.DOSES_A_DAY.items(), key=lambda x: -len(x[0]))
    alert, drug_class = F.col("_alert"), first_word(name, T.DRUG_CLASSES)
    status, prn = F.lower(filled(held(df, "status"))), F.lower(F.coalesce(filled(held(df, "prn")), F.col("frequency")))
    part = lambda k: F.nullif(F.regexp_extract(name, dose, k), F.lit(""))
    given = F.nullif(F.regexp_extract(held(df, "dose_value"), r"(\d+\.?\d*)", 1).try_cast("double"), F.lit(0.0))
    return df.select(
        "encounter_id", "line", "medication_name", mapped(route, T.ROUTE, route).alias("route"),
        F.coalesce(given, part(1).cast("double")).alias("dose_value"), F.when(given.isNotNull(), held(df, "dose_unit")).otherwise(F.coalesce(part(2), held(df, "dose_unit"))).alias("dose_unit"),
        F.coalesce(prn.contains("prn") | prn.contains("as needed"), F.lit(False)).alias("is_prn"), drug_class.alias("drug_class"),
        alert.isNotNull().alias("is_high_alert"), alert.alias("high_alert_category"),
        any_word(name, T.OPIOIDS).alias("is_opioid"), any_word(name, T.CONTROLLED).alias("is_controlled"), any_word(name, T.ANTICOAGULANTS).alias("is_anticoagulant"),
        first_hit(often, [(k, F.lit(float(x))) for k, x in patterns]).alias("doses_per_day"), F.datediff("end_date", "start_date").alias("therapy_days"), *present(df, status=mapped(status, T.MEDICATION_STATUS, status)),
        errors(
            ("medication_name is missing", filled(F.col("medication_name")).isNull()), *[(f"{c} is below 0", held(df, c, "double") < 0) for c in ("quantity", "refills", "days_supply")],
            *[(f"{c} is too long", F.length(held(df, c)) > n) for c, n in T.MEDICATION_LENGTHS.items()],
        ).alias("_errors"),
    )
