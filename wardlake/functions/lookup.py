"""Column builders for code lookups and first-match tables: all stay expressions of the plan."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled(c: Column) -> Column:
    """Trimmed text; blank is null."""
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def mapped(key: Column, table: dict[str, str], other: Column | None = None) -> Column:
    """table[key], else other (null if left out); null stays null."""
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    found = entries[key] if other is None else F.coalesce(entries[key], other)
    return F.when(key.isNotNull(), found)


def first_hit(text: Column, table: Iterable[tuple[str, Column]]) -> Column:
    """The value of the first entry whose keyword the text contains, else null."""
    out = None
    for word, value in table:
        out = F.when(text.contains(word), value) if out is None else out.when(text.contains(word), value)
    return out


def first_word(text: Column, table: dict[str, list[str]]) -> Column:
    """The first group, in the table's order, of which the text contains a word."""
    out = None
    for group, words in table.items():
        out = F.when(any_word(text, words), group) if out is None else out.when(any_word(text, words), group)
    return out


def first_match(text: Column, table: Iterable[tuple[str, str]], other: str | None = None) -> Column:
    """The value of the first entry whose pattern the text matches."""
    out = None
    for pattern, value in table:
        out = F.when(text.rlike(pattern), F.lit(value)) if out is None else out.when(text.rlike(pattern), F.lit(value))
    return F.when(text.isNotNull(), out.otherwise(F.lit(other)))


def any_word(text: Column, words: Iterable[str]) -> Column:
    """Whether the text contains any of the words: looked for one by one, which takes less than one pattern of them all."""
    return F.coalesce(reduce(Column.__or__, [text.contains(w) for w in words]), F.lit(False))


def steps(value: Column, table: list[tuple[float | None, int]]) -> Column:
    """Points for the first upper bound that the value does not pass."""
    out = F.when(value <= table[0][0], table[0][1])
    for bound, points in table[1:-1]:
        out = out.when(value <= bound, points)
    return F.when(value.isNotNull(), out.otherwise(table[-1][1]))
