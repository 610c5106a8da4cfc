"""Pieces of DuckDB SQL made from the lookup tables."""

from __future__ import annotations


def text(x: str | None) -> str:
    return "null" if x is None else "'" + x.replace("'", "''") + "'"


def mapped(key: str, table: dict[str, str], other: str = "null") -> str:
    return f"case when {key} is null then null " + " ".join(f"when {key} = {text(k)} then {text(v)}" for k, v in table.items()) + f" else {other} end"


def hits(expr: str, table: list[tuple[str, str]], other: str = "null") -> str:
    return "case " + " ".join(f"when contains({expr}, {text(k)}) then {v}" for k, v in table) + f" else {other} end"


def matches(expr: str, table: list[tuple[str, str]], other: str) -> str:
    return f"case when {expr} is null then null " + " ".join(f"when regexp_matches({expr}, {text(p)}) then {text(v)}" for p, v in table) + f" else {text(other)} end"


def steps(expr: str, table: list[tuple[float | None, int]]) -> str:
    return f"case when {expr} is null then null " + " ".join(f"when {expr} <= {b} then {p}" for b, p in table[:-1]) + f" else {table[-1][1]} end"


def bands(expr: str, bounds: list[tuple[int, str]], last: str) -> str:
    return f"case when {expr} is null then null " + " ".join(f"when {expr} < {b} then {text(n)}" for b, n in bounds) + f" else {text(last)} end"


def blank(expr: str) -> str:
    return f"nullif(trim({expr}), '')"
