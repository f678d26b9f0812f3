"""Tails of the normal and of Student's distribution as column expressions, by fractions of fixed depth.

They are meant for aggregated rows: each value is a fold over some hundred terms."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

DEPTH = 200
#: Degrees of freedom up to which the fraction's depth is enough.
MANY = 20_000
TINY = 1e-300
# fixed values: coefficients of the Lanczos approximation of the gamma function for g = 7
LANCZOS = [0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059, 12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7]


def bound(of, **values: Column) -> Column:
    """of(values), the values being fields of one struct: each is computed once, however often it is used."""
    row = F.struct(*[v.alias(k) for k, v in values.items()])
    return F.get(F.transform(F.array(row), lambda s: of(*[s[k] for k in values])), F.lit(0))


def log_gamma(z: Column) -> Column:
    """ln of the gamma function for z of 1/2 or more."""
    x = z - 1
    total = F.lit(LANCZOS[0])
    for k, c in enumerate(LANCZOS[1:], 1):
        total = total + F.lit(c) / (x + k)
    t = x + 7.5
    return 0.5 * math.log(2 * math.pi) + (x + 0.5) * F.ln(t) - t + F.ln(total)


def _away(x: Column) -> Column:
    return F.when(F.abs(x) < TINY, F.lit(TINY)).otherwise(x)


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function, one term in each step."""
    first = 1 / _away(1 - (a + b) * x / (a + 1))

    def step(s: Column, j: Column) -> Column:
        m = F.floor(j / 2).cast("double")
        even, odd = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        top = F.when(j % 2 == 0, even).otherwise(odd)
        d, c = 1 / _away(1 + top * s["d"]), _away(1 + top / s["c"])
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))
    return F.aggregate(F.sequence(F.lit(2), F.lit(2 * DEPTH + 1)), start, step, lambda s: s["h"])


def incomplete_beta(a: Column, b: Column, x: Column) -> Column:
    """The regularised incomplete beta function I_x(a, b) for a and b of 1/2 or more."""
    return bound(_incomplete_beta, a=a, b=b, x=F.greatest(F.least(x, F.lit(1.0)), F.lit(0.0)))


def _incomplete_beta(a: Column, b: Column, x: Column) -> Column:
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.ln(F.greatest(x, F.lit(TINY))) + b * F.ln(F.greatest(1 - x, F.lit(TINY))))
    low = x < (a + 1) / (a + b + 2)
    own, other = F.when(low, a).otherwise(b), F.when(low, b).otherwise(a)
    part = bound(lambda f, p, q, y: f * _fraction(p, q, y) / p, f=front, p=own, q=other, y=F.when(low, x).otherwise(1 - x))
    value = bound(lambda p, at: F.when(at, p).otherwise(1 - p), p=part, at=low)
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).otherwise(F.greatest(F.least(value, F.lit(1.0)), F.lit(0.0)))


def normal_two_sided(z: Column) -> Column:
    """P(|Z| >= |z|) of the standard normal distribution, by the series near 0 and by the fraction beyond."""
    return bound(_normal_two_sided, x=F.abs(z) / math.sqrt(2))


def _normal_two_sided(x: Column) -> Column:
    near = F.aggregate(F.sequence(F.lit(1), F.lit(80)), F.struct(x.alias("term"), x.alias("sum")), lambda s, k: F.struct((s["term"] * 2 * x * x / (2 * k + 1)).alias("term"), (s["sum"] + s["term"] * 2 * x * x / (2 * k + 1)).alias("sum")), lambda s: s["sum"])
    far = F.aggregate(F.sequence(F.lit(DEPTH), F.lit(1), F.lit(-1)), x, lambda t, k: x + k / 2 / t)
    return F.when(x < 2.5, 1 - 2 / math.sqrt(math.pi) * F.exp(-x * x) * near).otherwise(F.exp(-x * x) / math.sqrt(math.pi) / far)


def student_two_sided(t2: Column, df: Column) -> Column:
    """P(T^2 >= t2) of Student's T with df degrees of freedom; beyond MANY of them by the normal tail of Wallace's transform."""
    z = (8 * df + 1) / (8 * df + 3) * F.sqrt(df * F.log1p(t2 / df))
    return F.when(df > MANY, normal_two_sided(z)).otherwise(incomplete_beta(F.least(df, F.lit(float(MANY))) / 2, F.lit(0.5), df / (df + t2)))


def pearson_pvalue(r: Column, n: Column) -> Column:
    """Two-sided p of Pearson's r over n pairs (Student's t with n - 2 degrees); null for n < 3 or no r. For aggregated rows."""
    return bound(_pearson_pvalue, r=r, n=n)


def _pearson_pvalue(r: Column, n: Column) -> Column:
    known = r.isNotNull() & ~F.isnan(r) & (n > 2)
    df, r2 = F.when(known, n - 2).otherwise(1).cast("double"), F.when(known, F.least(r * r, F.lit(1.0))).otherwise(0.0)
    return F.when(known & (r2 >= 1), 0.0).when(known, student_two_sided(r2 * df / F.greatest(1 - r2, F.lit(TINY)), df))
