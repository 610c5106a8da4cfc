"""Dates and calendars."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DATE_FORMATS = ("yyyy-M-d", "M/d/yyyy", "d/M/yyyy", "yyyyMMdd")
TIME_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "M/d/yyyy HH:mm:ss", "M/d/yyyy HH:mm", "M/d/yyyy", "yyyyMMddHHmmss", "yyyyMMddHHmm", "yyyyMMdd")
#: With times of day, years of two digits and names of months, as people write dates.
WRITTEN_FORMATS = ("yyyy-M-d", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "M/d/yyyy", "M/d/yy", "d/M/yyyy", "M-d-yyyy", "yyyyMMdd", "MMMM d, yyyy", "MMM d, yyyy")
#: The last of the hundred years that two digits stand for.
LAST_SHORT_YEAR = 2068


def shaped(text: Column, form: str) -> Column:
    """Whether a text looks like a format: a cheap question, where trying a format that does not fit is not."""
    shapes = {"MMMM": "[A-Za-z]+", "MMM": "[A-Za-z]{3}", "yyyy": r"\d{4}", "M": r"\d{1,2}", "d": r"\d{1,2}"}
    return text.rlike("^" + re.sub("MMMM|MMM|yyyy|yy|MM|dd|HH|mm|ss|M|d", lambda m: shapes.get(m[0], r"\d{2}"), form.replace("'T'", "T")) + "$")


def parse_date(c: Column, formats: tuple[str, ...] = DATE_FORMATS, default: Column | None = None) -> Column:
    """The first format that fits, else the default, or null. Years of two digits end at LAST_SHORT_YEAR."""
    text = F.trim(c.cast("string"))

    def tried(form: str) -> Column:
        d = F.try_to_date(text, form)
        short = "yy" in form and "yyyy" not in form
        return F.when(shaped(text, form), F.when(F.year(d) > LAST_SHORT_YEAR, F.add_months(d, -1200)).otherwise(d) if short else d)

    return F.coalesce(*[tried(f) for f in formats], *([] if default is None else [default.cast("date")]))


def parse_time(c: Column, formats: tuple[str, ...] = TIME_FORMATS, default: Column | None = None) -> Column:
    """As parse_date, with fractions, a final Z and offsets cut off."""
    text = F.regexp_replace(F.trim(c.cast("string")), r"(\.\d+)?(Z|[+-]\d{2}:?\d{2})?$", "")
    return F.coalesce(*[F.when(shaped(text, f), F.try_to_timestamp(text, F.lit(f))) for f in formats], *([] if default is None else [default.cast("timestamp")]))


def written_date(c: Column, default: Column | None = None) -> Column:
    """The day of a date as people write it; a time of day, its fractions, Z and offset are cut off."""
    text = F.regexp_replace(F.trim(c.cast("string")), r"(?<=:\d{2})(\.\d+)?(Z|[+-]\d{2}:?\d{2})?$", "")
    return parse_date(text, WRITTEN_FORMATS, default)


def date_key(d: Column) -> Column:
    return F.date_format(d, "yyyyMMdd").cast("int")


def from_date_key(k: Column) -> Column:
    return F.try_to_date(k.cast("string"), "yyyyMMdd")


def age(born: Column, as_of: Column) -> Column:
    """Completed years."""
    before = F.date_format(as_of, "MMdd") < F.date_format(born, "MMdd")
    return F.year(as_of) - F.year(born) - before.cast("int")


def banded(value: Column, bounds: list[tuple[int, str]], last: str) -> Column:
    out = F.when(value < bounds[0][0], bounds[0][1])
    for bound, name in bounds[1:]:
        out = out.when(value < bound, name)
    return F.when(value.isNotNull(), out.otherwise(last))


#: The two schemes of age bands.
LIFE_STAGES = ([(1, "infant"), (5, "toddler"), (13, "child"), (18, "adolescent"), (30, "young_adult"), (50, "adult"), (65, "middle_aged"), (80, "senior")], "elderly")
AGE_BANDS = ([(0, "unknown"), (1, "infant"), (5, "1-4"), (18, "5-17"), (30, "18-29"), (45, "30-44"), (65, "45-64"), (75, "65-74"), (85, "75-84")], "85+")


def age_band(years: Column, scheme: str = "life_stage") -> Column:
    return banded(years, *(LIFE_STAGES if scheme == "life_stage" else AGE_BANDS))


def fiscal_year(d: Column, start: int = 10) -> Column:
    return F.year(d) + (F.month(d) >= start).cast("int") if start > 1 else F.year(d)


def fiscal_quarter(d: Column, start: int = 10) -> Column:
    return (F.floor(F.pmod(F.month(d) - start, F.lit(12)) / 3) + 1).cast("int")


def federal_holiday(d: Column) -> Column:
    """Name of the US federal holiday on that day, else null: four fixed days and six that float."""
    m, day, weekday = F.month(d), F.dayofmonth(d), F.weekday(d)
    monday = weekday == 0
    return (
        F.when((m == 1) & (day == 1), "New Year's Day")
        .when((m == 7) & (day == 4), "Independence Day")
        .when((m == 11) & (day == 11), "Veterans Day")
        .when((m == 12) & (day == 25), "Christmas Day")
        .when((m == 1) & monday & day.between(15, 21), "Martin Luther King Jr. Day")
        .when((m == 2) & monday & day.between(15, 21), "Presidents Day")
        .when((m == 5) & monday & (day > 24), "Memorial Day")
        .when((m == 9) & monday & (day <= 7), "Labor Day")
        .when((m == 10) & monday & day.between(8, 14), "Columbus Day")
        .when((m == 11) & (weekday == 3) & day.between(22, 28), "Thanksgiving Day")
    )


def days(spark: SparkSession, first: str, last: str, name: str = "day") -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias(name))


def calendar(dates: DataFrame, day: str = "day", fiscal_start: int = 10) -> DataFrame:
    """A date dimension row for each date."""
    d = F.col(day)
    return dates.select(
        date_key(d).alias("date_key"), d.alias("full_date"), F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"), F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"), F.dayofmonth(d).alias("day_of_month"), (F.dayofweek(d) - 1).alias("day_of_week"), F.weekday(d).alias("weekday_mon0"), F.date_format(d, "EEEE").alias("day_name"),
        F.weekday(d).isin(5, 6).alias("is_weekend"), federal_holiday(d).isNotNull().alias("is_holiday"), federal_holiday(d).alias("holiday_name"),
        fiscal_year(d, fiscal_start).alias("fiscal_year"), fiscal_quarter(d, fiscal_start).alias("fiscal_quarter"),
    )
