"""Column-expression helpers shared by Spark plans and oracle SQL.

Formulas that must be identical in both engines are written once as SQL
expression text (valid in Spark SQL and DuckDB) and used through ``F.expr``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of Acklam's rational approximation of the
# inverse standard normal CDF (public algorithm), with break points
# 0.02425 / 0.97575.
ACKLAM_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
            1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
ACKLAM_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
            6.680131188771972e+01, -1.328068155288572e+01)
ACKLAM_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
            -2.549671010229583e+00, 4.374664141464968e+00, 2.938163982698783e+00)
ACKLAM_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
            3.754408661907416e+00)
P_LOW = 0.02425


def d(v: float) -> str:
    """A DOUBLE literal in both Spark SQL and DuckDB (plain 0.5 would be DECIMAL)."""
    return f"{float(v):.17e}"


def _horner(coefs, x: str) -> str:
    expr = d(coefs[0])
    for c in coefs[1:]:
        expr = f"(({expr}) * {x} + {d(c)})"
    return expr


def norm_ppf_sql(p: str) -> str:
    """SQL text of Phi^-1(p) for 0 < p < 1."""
    one, two = d(1), d(2)
    ql = f"sqrt(-{two} * ln({p}))"
    qh = f"sqrt(-{two} * ln({one} - {p}))"
    q = f"({p} - {d(0.5)})"
    r = f"({q} * {q})"
    low = f"({_horner(ACKLAM_C, ql)}) / ({_horner(ACKLAM_D, ql)} * {ql} + {one})"
    high = f"-({_horner(ACKLAM_C, qh)}) / ({_horner(ACKLAM_D, qh)} * {qh} + {one})"
    mid = f"({_horner(ACKLAM_A, r)}) * {q} / ({_horner(ACKLAM_B, r)} * {r} + {one})"
    return (f"CASE WHEN {p} < {d(P_LOW)} THEN {low} WHEN {p} > {d(1 - P_LOW)} THEN {high} "
            f"ELSE {mid} END")


def norm_ppf(p: str) -> Column:
    return F.expr(norm_ppf_sql(p))


def filliben_sql(i: str, n: str) -> str:
    """Filliben's order-statistic medians (plotting positions) for rank i of n."""
    half = f"pow({d(0.5)}, {d(1)} / {n})"
    return (f"CASE WHEN {i} = {n} THEN {half} "
            f"WHEN {i} = 1 THEN {d(1)} - {half} "
            f"ELSE ({i} - {d(0.3175)}) / ({n} + {d(0.365)}) END")


def sanitize(c: Column) -> Column:
    """PF9: NaN, +inf, -inf (and null) -> 0."""
    bad = c.isNull() | F.isnan(c) | (c == float("inf")) | (c == float("-inf"))
    return F.when(bad, F.lit(0.0)).otherwise(c)


def softmax2(a: Column, b: Column) -> Column:
    """probability of the first of two classes from two scores."""
    m = F.greatest(a, b)
    ea, eb = F.exp(a - m), F.exp(b - m)
    return ea / (ea + eb)
