"""SQL fragments for the DuckDB oracle.

DuckDB has no t / chi-square / normal tail functions, so tails are written as
Simpson quadrature (4,000 panels) directly in SQL, and the inverse normal as
Newton steps on a power series: methods independent of the Spark side's.
"""

from __future__ import annotations

PANELS = 4000


def _simpson(expr_of_x: str, lo: str, width: str) -> str:
    """Simpson rule of expr(x) over [lo, lo + width]; ``x`` is the variable."""
    h = f"(({width}) / {PANELS}.0)"
    body = expr_of_x.replace("{x}", f"(({lo}) + i * {h})")
    w = f"(CASE WHEN i = 0 OR i = {PANELS} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)"
    return f"({h} / 3.0 * list_sum([{w} * {body} for i in range(0, {PANELS + 1})]))"


def t_two_sided_sql(t: str, df: str) -> str:
    """P(|T_df| >= |t|) = 2K * int_{atan(|t|/sqrt df)}^{pi/2} cos^(df-1)."""
    a = f"atan(abs({t}) / sqrt({df}))"
    width = f"least(pi() / 2 - {a}, 40.0 / sqrt({df}))"
    k = f"(2 * exp(lgamma(({df} + 1) / 2.0) - lgamma(({df}) / 2.0)) / sqrt(pi()))"
    integ = _simpson(f"pow(cos({{x}}), ({df}) - 1)", a, width)
    return f"least(1.0, {k} * {integ})"


def norm_sf_sql(z: str) -> str:
    return _simpson("exp(-0.5 * {x} * {x}) / sqrt(2 * pi())", z, "12.0")


def chi2_sf_sql(x: str, k: str) -> str:
    """Upper chi-square tail with x = u^2."""
    lo = f"sqrt({x})"
    norm = f"(pow(2.0, ({k}) / 2.0) * exp(lgamma(({k}) / 2.0)))"
    body = f"(2 * pow({{x}}, ({k}) - 1) * exp(-0.5 * {{x}} * {{x}}))"
    return f"least(1.0, {_simpson(body, lo, '14.0')} / {norm})"


def norm_ppf_sql(p: str) -> str:
    """Inverse normal CDF by Newton steps on the CDF's power series
    Phi(x) = 1/2 + phi(x) * sum x^(2k+1) / (2k+1)!!, from a rough start; it
    shares nothing with the rational approximations of the Spark side."""
    tail = f"least({p}, 1.0 - ({p}))"
    start = f"(4.91 * (pow(1.0 - {tail}, 0.14) - pow({tail}, 0.14)))"          # of 1 - tail, so at least 0
    phi = "(exp(-0.5 * nx * nx) / sqrt(2 * pi()))"
    series = ("list_sum([exp((2 * nk + 1) * ln(greatest(nx, 1e-300)) - (nk + 1) * ln(2.0) - lgamma(nk + 1.5) + 0.5 * ln(pi())) "
              "for nk in range(0, 90)])")
    step = f"nx - (0.5 + {phi} * {series} - (1.0 - {tail})) / {phi}"
    solved = f"list_reduce([{start}, 0.0, 0.0, 0.0, 0.0, 0.0], lambda nx, round_: {step})"
    return f"(sign(({p}) - 0.5) * {solved})"
