"""Scalar distribution functions for test p-values and intervals.

These run on a handful of sufficient statistics (never on data rows), on
the driver or inside a one-row pandas UDF.  Implemented from the standard
continued-fraction / series forms of the regularised incomplete beta and
gamma functions.
"""

from __future__ import annotations

import math
from statistics import NormalDist

_EPS = 3e-16
_TINY = 1e-300
#: Terms after which a series that has not converged is an error, never a result.
_MAX_TERMS = 5_000_000


def _nonzero(x: float) -> float:
    return x if abs(x) > _TINY else _TINY


def _betacf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 / _nonzero(1.0 - qab * x / qap)
    h = d
    for m in range(1, _MAX_TERMS):
        for aa in (m * (b - m) * x / ((qam + 2 * m) * (a + 2 * m)),
                   -(a + m) * (qab + m) * x / ((a + 2 * m) * (qap + 2 * m))):
            d = 1.0 / _nonzero(1.0 + aa * d)
            c = _nonzero(1.0 + aa / c)
            h *= d * c
        if abs(d * c - 1.0) < _EPS:
            return h
    raise ArithmeticError(f"incomplete beta({a}, {b}, {x}) did not converge")


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = (math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
           + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1 - x) / b


def gammainc_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        total = term = 1.0 / a
        for k in range(1, _MAX_TERMS):
            term *= x / (a + k)
            total += term
            if term < total * _EPS:
                return 1.0 - total * scale
    else:
        b, c, d = x + 1 - a, 1.0 / _TINY, 1.0 / _nonzero(x + 1 - a)
        h = d
        for i in range(1, _MAX_TERMS):
            an, b = -i * (i - a), b + 2
            d = 1.0 / _nonzero(an * d + b)
            c = _nonzero(b + an / c)
            h *= d * c
            if abs(d * c - 1.0) < _EPS:
                return scale * h
    raise ArithmeticError(f"incomplete gamma({a}, {x}) did not converge")


def t_sf2(t: float, df: float) -> float:
    """Two-sided p-value of Student's t."""
    if t is None or df is None or df <= 0 or math.isnan(t):
        return float("nan")
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def t_cdf(t: float, df: float) -> float:
    p = 0.5 * t_sf2(t, df)
    return 1 - p if t > 0 else p


def t_ppf(q: float, df: float) -> float:
    """Quantile of Student's t: the bracket is widened until it holds, then halved."""
    if not 0 < q < 1:
        raise ValueError("a quantile needs a probability between 0 and 1")
    if q < 0.5:
        return -t_ppf(1 - q, df)
    lo, hi = 0.0, 1.0
    while t_cdf(hi, df) < q:
        lo, hi = hi, hi * 2
    while hi - lo > 1e-14 * max(hi, 1.0):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if t_cdf(mid, df) < q else (lo, mid)
    return (lo + hi) / 2


def f_sf(f: float, d1: float, d2: float) -> float:
    """Upper tail of the F distribution."""
    if f is None or f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def chi2_sf(x: float, df: float) -> float:
    return gammainc_upper(df / 2.0, x / 2.0)


def norm_cdf(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def norm_ppf(p: float) -> float:
    return NormalDist().inv_cdf(p)


# Wichura's rational approximation (AS241) of the normal quantile, highest power first:
# near the middle in 0.180625 - q^2 times q, else in sqrt(-log(tail)) - 1.6, beyond 5 in sqrt(-log(tail)) - 5.
_AS241 = {
    "middle": (("2.5090809287301226727e+3", "3.3430575583588128105e+4", "6.7265770927008700853e+4", "4.5921953931549871457e+4",
                "1.3731693765509461125e+4", "1.9715909503065514427e+3", "1.3314166789178437745e+2", "3.3871328727963666080e+0"),
               ("5.2264952788528545610e+3", "2.8729085735721942674e+4", "3.9307895800092710610e+4", "2.1213794301586595867e+4",
                "5.3941960214247511077e+3", "6.8718700749205790830e+2", "4.2313330701600911252e+1", "1.0e+0")),
    "tail": (("7.74545014278341407640e-4", "2.27238449892691845833e-2", "2.41780725177450611770e-1", "1.27045825245236838258e+0",
              "3.64784832476320460504e+0", "5.76949722146069140550e+0", "4.63033784615654529590e+0", "1.42343711074968357734e+0"),
             ("1.05075007164441684324e-9", "5.47593808499534494600e-4", "1.51986665636164571966e-2", "1.48103976427480074590e-1",
              "6.89767334985100004550e-1", "1.67638483018380384940e+0", "2.05319162663775882187e+0", "1.0e+0")),
    "far": (("2.01033439929228813265e-7", "2.71155556874348757815e-5", "1.24266094738807843860e-3", "2.65321895265761230930e-2",
             "2.96560571828504891230e-1", "1.78482653991729133580e+0", "5.46378491116411436990e+0", "6.65790464350110377720e+0"),
            ("2.04426310338993978564e-15", "1.42151175831644588870e-7", "1.84631831751005468180e-5", "7.86869131145613259100e-4",
             "1.48753612908506148525e-2", "1.36929880922735805310e-1", "5.99832206555887937690e-1", "1.0e+0")),
}


def normal_quantile_sql(p: str) -> str:
    """SQL text of the standard normal quantile of a column expression (Spark and DuckDB alike)."""
    def ratio(part: str, r: str) -> str:
        sides = []
        for powers in _AS241[part]:
            text = powers[0]
            for c in powers[1:]:
                text = f"({text} * {r} + {c})"
            sides.append(text)
        return f"({sides[0]} / {sides[1]})"

    q, root = f"(({p}) - 5e-1)", f"sqrt(-ln(least(({p}), 1e0 - ({p}))))"
    return (f"CASE WHEN abs({q}) <= 4.25e-1 THEN {ratio('middle', f'(1.80625e-1 - {q} * {q})')} * {q} "
            f"WHEN {root} <= 5e0 THEN sign({q}) * {ratio('tail', f'({root} - 1.6e0)')} "
            f"ELSE sign({q}) * {ratio('far', f'({root} - 5e0)')} END")


def ptukey(q: float, k: int, df: float, n_s: int = 400, n_z: int = 400) -> float:
    """CDF of the studentized range for ``k`` means and ``df`` error df.

    Numerical integration over the scaled-chi density of the standard error
    and the normal density of the range origin.  The grid of the standard
    error follows its spread around 1, so it fits every ``df``.
    """
    import numpy as np
    if q <= 0:
        return 0.0
    z = np.linspace(-8, 8, n_z)
    dz = z[1] - z[0]
    phi = np.exp(-z * z / 2) / math.sqrt(2 * math.pi)
    erfc = np.vectorize(math.erfc)
    below = 0.5 * erfc(-z / math.sqrt(2))

    def range_cdf(w):
        inside = np.clip(below - 0.5 * erfc(-(z - w) / math.sqrt(2)), 0, 1)
        return k * float(np.sum(phi * inside ** (k - 1)) * dz)

    spread = 9 / math.sqrt(2 * df)
    s = np.linspace(max(1e-6, 1 - spread), 1 + spread, n_s)
    log_f = (math.log(2) + (df / 2) * math.log(df / 2) - math.lgamma(df / 2)
             + (df - 1) * np.log(s) - df * s * s / 2)
    dens = np.exp(log_f)
    dens /= np.sum(dens)
    return float(min(1.0, np.sum(dens * np.array([range_cdf(q * x) for x in s]))))


def qtukey(p: float, k: int, df: float) -> float:
    """Quantile of the studentized range: widened bracket, then halved."""
    lo, hi = 0.0, 4.0
    while ptukey(hi, k, df) < p:
        lo, hi = hi, hi * 2
    while hi - lo > 1e-7:
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if ptukey(mid, k, df) < p else (lo, mid)
    return (lo + hi) / 2
