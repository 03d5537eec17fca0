"""Column-expression helpers (JVM-side, codegen friendly).

Everything here returns a ``Column``; no Python runs per row.
"""
from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-8


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c





def period_key(year, month) -> Column:
    """``year*100 + month``; a missing year counts as 0, a missing month as 1."""
    return (F.coalesce(col(year).cast("long"), F.lit(0)) * 100
            + F.coalesce(col(month).cast("long"), F.lit(1)))


def quarter(month) -> Column:
    """Quarter ``floor((m-1)/3)+1`` with floor semantics."""
    return (F.floor((col(month) - 1) / 3) + 1).cast("long")


def months_between_periods(period, start_period) -> Column:
    """Months from ``start_period`` to ``period`` for ``yyyymm`` keys.

    Uses 12*dYear + dMonth, which stays correct across year boundaries.
    """
    p, s = col(period), col(start_period)
    return ((F.floor(p / 100) - F.floor(s / 100)) * 12
            + (F.pmod(p, F.lit(100)) - F.pmod(s, F.lit(100)))).cast("long")


def normal_cdf(x) -> Column:
    """Standard normal CDF as a column expression.

    Spark has no ``erf``; this is the Zelen & Severo (Abramowitz-Stegun
    26.2.17) polynomial with absolute error below 7.5e-8.
    """
    x = col(x)
    # fixed values: coefficients of Abramowitz-Stegun 26.2.17
    p = 0.2316419
    b1, b2, b3, b4, b5 = 0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429
    z = F.abs(x)
    t = 1.0 / (1.0 + p * z)
    poly = t * (b1 + t * (b2 + t * (b3 + t * (b4 + t * b5))))
    upper = F.exp(-z * z / 2.0) / math.sqrt(2 * math.pi) * poly
    return F.when(x >= 0, 1.0 - upper).otherwise(upper)


def _horner(x: Column, coefs: list[float]) -> Column:
    """Polynomial with the constant term first."""
    out = F.lit(coefs[-1])
    for c in reversed(coefs[:-1]):
        out = out * x + F.lit(c)
    return out


# fixed values: Wichura's algorithm AS 241 (PPND16), numerator and denominator, constant term first
_CENTRE = ([3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125,
            45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727],
           [1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077,
            21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610])
_MIDDLE = ([1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
            1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 0.000774545014278341407640],
           [1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550,
            0.148103976427480074590, 0.0151986665636164571966, 0.000547593808499534494600, 1.05075007164441684324e-9])
_TAIL = ([6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230,
          0.0265321895265761230930, 0.00124266094738807843860, 0.0000271155556874348757815, 2.01033439929228813265e-7],
         [1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525,
          0.000786869131145613259100, 0.0000184631831751005468180, 1.42151175831644588870e-7, 2.04426310338993978564e-15])


def normal_quantile(p) -> Column:
    """Inverse of the standard normal CDF, relative error about 1e-16; NULL
    outside (0, 1)."""
    p = col(p)
    q = p - 0.5
    r = F.lit(0.180625) - q * q
    centre = q * _horner(r, _CENTRE[0]) / _horner(r, _CENTRE[1])
    t = F.sqrt(-F.log(F.least(p, 1.0 - p)))
    middle = _horner(t - 1.6, _MIDDLE[0]) / _horner(t - 1.6, _MIDDLE[1])
    tail = _horner(t - 5.0, _TAIL[0]) / _horner(t - 5.0, _TAIL[1])
    outer = F.signum(q) * F.when(t <= 5.0, middle).otherwise(tail)
    return F.when((p > 0.0) & (p < 1.0), F.when(F.abs(q) <= 0.425, centre).otherwise(outer))


def rnd(c, digits: int = 4) -> Column:
    """Round half away from zero (same rule as DuckDB's ``round``)."""
    return F.round(col(c), digits)


def is_numeric_type(dtype) -> bool:
    from pyspark.sql import types as T
    return isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                              T.FloatType, T.DoubleType, T.DecimalType))


def numeric_columns(df, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if is_numeric_type(f.dataType) and f.name not in exclude]


def string_columns(df, exclude=()) -> list[str]:
    from pyspark.sql import types as T
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]
