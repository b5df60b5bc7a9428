"""Coercions, guarded division and the normal distribution as column expressions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def coerce_double(c: Column, data_type: str = "string") -> Column:
    """Numeric value or NULL. Text with a type suffix (``1d``, ``1f``) is not a number here, and
    NaN is missing. Columns that are numeric already are only cast."""
    if data_type in NUMERIC_TYPES[:4]:
        return c.cast("double")
    if data_type not in NUMERIC_TYPES:
        suffixed = c.cast("string").rlike("[0-9.][dDfF] *$")
        c = F.when(~suffixed, c.cast("string")).try_cast("double")
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def coerce_flag(c: Column, data_type: str = "string") -> Column:
    """0/1 flag: missing or unreadable as 0."""
    value = c if data_type == "int" else coerce_double(c, data_type).try_cast("int")
    return F.coalesce(value, F.lit(0))


def coerce_label(c: Column, data_type: str = "string") -> Column:
    """The label if it is exactly 0 or 1, else NULL."""
    if data_type in NUMERIC_TYPES[:4]:
        return F.when(c.isin(0, 1), c.cast("int"))
    value = coerce_double(c, data_type)
    return F.when(value == 0, F.lit(0)).when(value == 1, F.lit(1))


def numeric_column(df: DataFrame, name: str, coerce=coerce_double) -> Column:
    """The named column coerced by its type; missing values throughout if there is no such column."""
    types = dict(df.dtypes)
    if name not in types:
        return coerce(F.lit(None).cast("int"), "int")
    return coerce(F.col(name), types[name])


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient; 0.0 where the denominator is 0 or missing."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


# Beyond this the error function equals 1 in double precision.
_ERF_LIMIT = 6.0
# Numerator and denominator of Cody's rational approximations (1969), highest power first: erf(x) / x in x^2 up to
# _ERF_NEAR; exp(x^2) * erfc(x) in x up to _ERF_FAR; beyond, what is missing from 1/sqrt(pi) at exp(x^2) * erfc(x) * x,
# times x^2, in x^2.
_ERF_NEAR, _ERF_FAR = 0.46875, 4.0
_NEAR = (
    (1.85777706184603153e-1, 3.16112374387056560e0, 1.13864154151050156e2, 3.77485237685302021e2, 3.20937758913846947e3),
    (1.0, 2.36012909523441209e1, 2.44024637934444173e2, 1.28261652607737228e3, 2.84423683343917062e3),
)
_MIDDLE = (
    (2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594e0, 6.61191906371416295e1, 2.98635138197400131e2,
     8.81952221241769090e2, 1.71204761263407058e3, 2.05107837782607147e3, 1.23033935479799725e3),
    (1.0, 1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2, 1.62138957456669019e3,
     3.29079923573345963e3, 4.36261909014324716e3, 3.43936767414372164e3, 1.23033935480374942e3),
)
_FAR = (
    (6.58749161529837803e-4, 1.60837851487422766e-2, 1.25781726111229246e-1, 3.60344899949804439e-1, 3.05326634961232344e-1,
     1.63153871373020978e-2),
    (2.33520497626869185e-3, 6.05183413124413191e-2, 5.27905102951428412e-1, 1.87295284992346725e0, 2.56852019228982242e0,
     1.0),
)


def _quotient(polynomials: tuple[tuple[float, ...], ...], x: Column) -> Column:
    above, below = (reduce(lambda value, c: value * x + c, rest, F.lit(first)) for first, *rest in polynomials)
    return above / below


def erf(x: Column) -> Column:
    """Error function in plain arithmetic, which is compiled: a rational approximation for each of three ranges, within
    a few units of the last place."""
    a = F.abs(x)
    near = a * _quotient(_NEAR, a * a)
    middle = F.lit(1.0) - F.exp(-a * a) * _quotient(_MIDDLE, a)
    far = F.lit(1.0) - F.exp(-a * a) * (F.lit(1.0) / F.sqrt(F.pi()) - _quotient(_FAR, a * a) / (a * a)) / a
    size = F.when(a <= _ERF_NEAR, near).when(a <= _ERF_FAR, middle).when(a < _ERF_LIMIT, far).otherwise(F.lit(1.0))
    return F.when(x.isNotNull(), F.signum(x) * size)


def normal_cdf(x: Column) -> Column:
    return F.lit(0.5) * (F.lit(1.0) + erf(x / F.sqrt(F.lit(2.0))))


def p_value_two_sided(z: Column) -> Column:
    return F.lit(2.0) * (F.lit(1.0) - normal_cdf(F.abs(z)))


@dataclass(frozen=True)
class ProportionTest:
    rate_a: Column
    rate_b: Column
    difference: Column
    z: Column
    p: Column


def two_proportion_z_test(
    success_a: Column, total_a: Column, success_b: Column, total_b: Column
) -> ProportionTest:
    """Pooled two-sided test of rate a against rate b.

    With an empty side everything is NULL; with no variance only z and p are.
    """
    usable = (total_a > 0) & (total_b > 0)
    rate_a = F.when(usable, F.try_divide(success_a.cast("double"), total_a.cast("double")))
    rate_b = F.when(usable, F.try_divide(success_b.cast("double"), total_b.cast("double")))
    pooled = F.try_divide((success_a + success_b).cast("double"), (total_a + total_b).cast("double"))
    inverse_totals = F.try_divide(F.lit(1.0), total_a.cast("double")) + F.try_divide(
        F.lit(1.0), total_b.cast("double")
    )
    variance = pooled * (1.0 - pooled) * inverse_totals
    z = F.when(usable & (variance > 0), F.try_divide(rate_a - rate_b, F.sqrt(variance)))
    return ProportionTest(rate_a, rate_b, rate_a - rate_b, z, p_value_two_sided(z))


def guarded_correlation(x: Column, y: Column) -> Column:
    """Pearson correlation aggregate over the rows where both sides are present; NULL for
    fewer than two of them or for a constant side."""
    both = x.isNotNull() & y.isNotNull()
    px, py = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_samp(px, py), F.stddev_samp(px) * F.stddev_samp(py))
