"""Formulas that oracle statements need and DuckDB has no function for."""

from __future__ import annotations

from ..functions.expressions import QUANTILE_FAR, QUANTILE_MIDDLE, QUANTILE_TAIL


def _ratio(pair, x: str) -> str:
    powers = lambda c: " + ".join(f"{v!r} * pow({x}, {i})" for i, v in enumerate(c))
    return f"(({powers(pair[0])}) / ({powers(pair[1])}))"


def normal_quantile_sql(p: str) -> str:
    """Inverse of the standard normal distribution function of a column in (0, 1)."""
    root = f"sqrt(-ln(least({p}, 1 - {p})))"
    tail = f"CASE WHEN {root} <= 5 THEN {_ratio(QUANTILE_TAIL, f'({root} - 1.6)')} ELSE {_ratio(QUANTILE_FAR, f'({root} - 5)')} END"
    middle = f"({p} - 0.5) * {_ratio(QUANTILE_MIDDLE, f'(0.180625 - ({p} - 0.5) * ({p} - 0.5))')}"
    return f"CASE WHEN {p} > 0 AND {p} < 1 THEN CASE WHEN abs({p} - 0.5) <= 0.425 THEN {middle} ELSE sign({p} - 0.5) * {tail} END END"
