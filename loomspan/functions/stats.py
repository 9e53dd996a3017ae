"""Statistic reducers: every indicator becomes mean, std, min and max."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATS = ("mean", "std", "min", "max")


def num(value) -> Column:
    return (F.expr(value) if isinstance(value, str) else value).cast("double")


def finite(value) -> Column:
    """The value, null where it is NaN (which is above all numbers) or infinite."""
    v = num(value)
    return F.when(F.abs(v) < F.lit(float("inf")), v)


def tidy(value: Column) -> Column:
    """A result: null where not finite, and never minus zero."""
    return finite(value) + F.lit(0.0)


def finite_sql(value: str) -> str:
    return f"CASE WHEN abs(CAST({value} AS DOUBLE)) < double('Infinity') THEN CAST({value} AS DOUBLE) END"


def stats4(name: str, value, ddof: int) -> list[Column]:
    """Aggregates of a vector indicator, an SQL expression or a column. Nulls and non-finite values are skipped; a single value's std is null for ddof 1, 0 for ddof 0."""
    std = "stddev_samp" if ddof else "stddev_pop"
    if isinstance(value, str):  # one expression for each statistic: a wide row has hundreds
        v = finite_sql(value)
        return [F.expr(f"{finite_sql(f'{f}({v})')} + 0.0D AS {name}_{s}") for s, f in zip(STATS, ("avg", std, "min", "max"), strict=True)]
    v = finite(value)
    return [tidy(f(v)).alias(f"{name}_{s}") for s, f in zip(STATS, (F.avg, getattr(F, std), F.min, F.max), strict=True)]


def scalar4(name: str, value, ddof: int) -> list[Column]:
    """The same four for a window scalar (an aggregate or a column): std is null for ddof 1, else 0 where there is a value."""
    if isinstance(value, str):
        v = finite_sql(value) + " + 0.0D"
        std = "CAST(NULL AS DOUBLE)" if ddof else f"CASE WHEN {finite_sql(value)} IS NOT NULL THEN 0.0D END"
        return [F.expr(f"{x} AS {name}_{s}") for s, x in zip(STATS, (v, std, v, v), strict=True)]
    v = tidy(num(value))
    std = F.lit(None).cast("double") if ddof else F.when(v.isNotNull(), F.lit(0.0))
    return [v.alias(f"{name}_mean"), std.alias(f"{name}_std"), v.alias(f"{name}_min"), v.alias(f"{name}_max")]


def null4(name: str) -> list[Column]:
    return [F.lit(None).cast("double").alias(f"{name}_{s}") for s in STATS]


def circular4(name: str, value) -> list[Column]:
    """Circular mean and std of angles; min and max of the angles wrapped to [-pi, pi)."""
    v = finite(value)
    wrapped = F.pmod(v + math.pi, F.lit(2 * math.pi)) - math.pi
    c, s = F.avg(F.cos(v)), F.avg(F.sin(v))
    r = F.least(F.sqrt(c * c + s * s), F.lit(1.0))
    std = F.when(F.count(v) < 2, None).when(r <= 0, F.lit(math.pi / math.sqrt(3))).otherwise(F.sqrt(-2 * F.ln(r)))
    return [x.alias(f"{name}_{k}") for x, k in zip((tidy(F.atan2(s, c)), tidy(std), tidy(F.min(wrapped)), tidy(F.max(wrapped))), STATS, strict=True)]


def ratio(a, b) -> Column:
    """a / b, null where b is 0."""
    return F.try_divide(num(a), num(b))


def angular_diff(a: Column, b: Column) -> Column:
    return F.abs(F.pmod(a - b + math.pi, F.lit(2 * math.pi)) - math.pi)


def unwrapped(d: Column) -> Column:
    """A difference of angles taken the short way round; half a turn keeps its sign."""
    w = F.pmod(d + math.pi, F.lit(2 * math.pi)) - math.pi
    return F.when(F.abs(d) < math.pi, d).when((w == -math.pi) & (d > 0), F.lit(math.pi)).otherwise(w)


def rms(x, y, ddof: int) -> Column:
    """Root of the summed variances; one sample: 0 for ddof 1."""
    if ddof:
        return F.sqrt(F.coalesce(F.var_samp(num(x)), F.lit(0.0)) + F.coalesce(F.var_samp(num(y)), F.lit(0.0)))
    return F.sqrt(F.var_pop(num(x)) + F.var_pop(num(y)))


def spread(x, y) -> tuple[Column, Column]:
    return F.max(x) - F.min(x), F.max(y) - F.min(y)


def correlation(a, b) -> Column:
    """Pearson's r over rows with both; null for fewer than two rows or a constant side."""
    both = F.when(num(a).isNotNull() & num(b).isNotNull(), F.lit(1))
    x, y = F.when(both == 1, num(a)), F.when(both == 1, num(b))
    sd = F.stddev_pop(x) * F.stddev_pop(y)
    return F.when(F.count(both) >= 2, F.try_divide(F.covar_pop(x, y), F.when(sd > 1e-12 * F.greatest(F.lit(1e-300), F.avg(F.abs(x)) * F.avg(F.abs(y))), sd)))


def slope(y, x) -> Column:
    """Least-squares slope of y on x over rows with both; null without two distinct x."""
    return F.regr_slope(num(y), num(x))


def only(rows: str = ""):
    """A function that takes an SQL value of these rows alone: null elsewhere, so that aggregates of several grains can stand side by side."""
    return lambda value: f"CASE WHEN {rows} THEN {value} END" if rows else value


def quotient(a: str, b: str) -> str:
    """ratio() in SQL."""
    return f"try_divide(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"


def extent(x: str) -> str:
    return f"(max({x}) - min({x}))"


def guarded(df: DataFrame, at: int, families: dict[str, list[Column]]) -> DataFrame:
    """df, whose columns from number `at` on are those of the families in turn, with a family's columns null where its counter (a column, the key) is 0."""
    names = iter(df.columns[at:])
    mine = {next(names): k for k, part in families.items() for _ in part}
    return df.selectExpr(*(f"CASE WHEN {mine[c]} > 0 THEN {c} END AS {c}" if c in mine else c for c in df.columns))


def one_more(var: Column, mean: Column, n: Column, x: Column) -> Column:
    """Sample variance of n values, given by their population variance and mean, and one more."""
    d = x - mean
    return var + d * d / (n + 1)


def both_ways(first, last) -> Column:
    """Population variance of two columns' values put together."""
    n, m = F.count(first).cast("double"), F.count(last).cast("double")
    d = F.avg(first) - F.avg(last)
    own = F.coalesce(n * F.var_pop(first), F.lit(0.0)) + F.coalesce(m * F.var_pop(last), F.lit(0.0))
    return F.try_divide(own + F.coalesce(F.try_divide(n * m, n + m) * d * d, F.lit(0.0)), n + m)
