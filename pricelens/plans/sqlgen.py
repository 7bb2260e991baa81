"""Helpers that spell the library's expressions as DuckDB SQL for the oracle."""

from __future__ import annotations


def q(s) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def map_keep(c: str, mapping: dict) -> str:
    if not mapping:
        return c
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"COALESCE(CASE {c} {whens} END, {c})"


def map_null(c: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {c} {whens} END"


def cascade(c: str, rules, default, null_label=None) -> str:
    whens = " ".join(f"WHEN contains({c}, {q(t)}) THEN {q(lab)}" for t, lab in rules)
    pre = f"WHEN {c} IS NULL THEN {q(null_label)} " if null_label is not None else ""
    return f"CASE {pre}{whens} ELSE {q(default)} END"


def band_case(c: str, edges, labels) -> str:
    parts = []
    for i, lab in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        cond = f"{c} >= {lo!r}" if i == 0 else f"{c} > {lo!r}"
        if hi != float("inf"):
            cond += f" AND {c} <= {hi!r}"
        parts.append(f"WHEN {cond} THEN {q(lab)}")
    return "CASE " + " ".join(parts) + " END"


def r(expr: str, digits: int) -> str:
    """Half-even rounding as numpy: rint(x * 10^n) / 10^n."""
    p = float(10 ** digits)
    return f"(round_even(({expr}) * {p!r}, 0) / {p!r})"


def with_ctes(*ctes: str, body: str) -> str:
    # The "-- body" marker lets a wrapper nest the final SELECT.
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n-- body\n" + body
