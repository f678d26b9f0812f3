"""Score, probability and label conversions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-5


def prob_to_llr2(p: Column, eps: float = EPS) -> Column:
    return F.log2((p + eps) / (1 - p + eps))


def prob_to_llre(p: Column, eps: float = EPS) -> Column:
    return F.ln((p + eps) / (1 - p + eps))


def llre_to_prob(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def llr2_to_prob(x: Column) -> Column:
    return 1 / (1 + F.pow(F.lit(2.0), -x))


def llre_to_llr2(x: Column) -> Column:
    return x / math.log(2)


def freq_to_label(freq: Column, cut: float = 1.0, eps: float = EPS) -> Column:
    """0 for unmethylated, 1 for methylated; anything between fails the query."""
    return F.when(freq <= eps, 0).when(freq >= cut - eps, 1).otherwise(F.raise_error(F.concat(F.lit("not a certain site: "), freq.cast("string"))).cast("int"))


def score_to_label(score: Column, cutoff: float = 0.0, inclusive: bool = False, eps: float = EPS) -> Column:
    return F.when(score >= cutoff if inclusive else score > cutoff + eps, 1).otherwise(0)


def finite(x: Column) -> Column:
    """NaN and infinities as null."""
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson's r over pairs without null; null for constant input (corr() fails there under ANSI mode)."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def duration_seconds(text: Column) -> Column:
    """`1h 52m 55s`, `39m 40s`, `311ms` as seconds; null if nothing matches."""
    part = lambda unit: F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(text, rf"([0-9.]+){unit}(?![a-z])", 1), F.lit("")), F.lit("999999.999")), F.lit(0)).cast("double")
    total = part("d") * 86400 + part("h") * 3600 + part("m") * 60 + part("s") + part("ms") / 1000
    return F.when(text.rlike(r"[0-9](d|h|m|s|ms)\b"), total)


def size_gb(text: Column, base: float = 1024.0) -> Column:
    """`12 KB`, `3.5 MB`, `1.2 GB` as GB."""
    n = F.regexp_extract(text, r"([0-9.]+)", 1).try_cast("double") if hasattr(text, "try_cast") else F.regexp_extract(text, r"([0-9.]+)", 1).cast("double")
    return F.when(text.contains("GB"), n).when(text.contains("MB"), n / base).when(text.contains("KB"), n / base**2).when(text == "0", 0.0)
