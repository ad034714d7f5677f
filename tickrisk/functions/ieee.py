"""IEEE-754 arithmetic as column expressions.

Spark's ANSI mode returns NULL for ``ln(x)`` with ``x <= 0`` and raises on a
division by zero; the modelled job follows IEEE (``-Infinity``/``NaN``).
These helpers reproduce IEEE results with ``when`` branches so that they stay
JVM-side and inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def _nan() -> Column:
    return F.lit(float("nan"))


def _inf(sign: int = 1) -> Column:
    return F.lit(float("inf") if sign > 0 else float("-inf"))


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ieee_ln(x) -> Column:
    """Natural log with IEEE results: ln(0) = -inf, ln(<0) = NaN, ln(NaN) = NaN."""
    x = _c(x)
    return (F.when(F.isnan(x), _nan())
            .when(x == 0, _inf(-1))
            .when(x < 0, _nan())
            .otherwise(F.ln(x)))


def ieee_div(num, den) -> Column:
    """``num / den`` with IEEE results for a zero or NaN denominator.

    Signed zeros are not distinguished (Spark compares -0.0 equal to 0.0).
    """
    num, den = _c(num), _c(den)
    return (F.when(F.isnan(num) | F.isnan(den), _nan())
            .when(den != 0, num / den)
            .when(num > 0, _inf(1))
            .when(num < 0, _inf(-1))
            .otherwise(_nan()))


def map_get_or_zero(m, key) -> Column:
    """``m.getOrDefault(key, 0.0)`` for a ``map<string,double>`` column."""
    return F.coalesce(F.try_element_at(_c(m), _c(key)), F.lit(0.0))


def sorted_sum(values) -> Column:
    """Sum of an array of doubles in ascending order.

    Summing in a canonical order makes the result a function of the multiset
    of terms: identical inputs give identical bits whatever the shuffle order,
    which exact change detection (emit on change) needs.
    """
    return F.aggregate(F.array_sort(_c(values)), F.lit(0.0), lambda acc, v: acc + v)


def round8(x) -> Column:
    """Round to 8 decimals (result comparisons across engines)."""
    return F.round(_c(x), 8)


def map_metrics(weights, means, cov, periods: int = 52, risk_free: float = 0.0018) -> Column:
    """A2/A3/P10 on wire maps: ``struct(expected_return, variance, risk, sharpe)``.

    ``weights``/``means``: ``map<string,double>``; ``cov``:
    ``map<string,map<string,double>>``; missing entries count as 0 (P5).
    Terms are summed in ascending order, as in the long-form operators.
    """
    import math

    w, m, c = _c(weights), _c(means), _c(cov)
    ents = F.map_entries(w)
    e = sorted_sum(F.transform(ents, lambda x: x["value"] * map_get_or_zero(m, x["key"])))

    def row_sum(x):
        row = F.coalesce(F.try_element_at(c, x["key"]), F.create_map().cast("map<string,double>"))
        return x["value"] * sorted_sum(F.transform(ents, lambda y: y["value"] * map_get_or_zero(row, y["key"])))

    var = sorted_sum(F.transform(ents, row_sum))
    risk = F.sqrt(var)
    sharpe = ieee_div(F.lit(math.sqrt(periods)) * (e - F.lit(risk_free)), risk)
    return F.struct(e.alias("expected_return"), var.alias("variance"), risk.alias("risk"),
                    sharpe.alias("sharpe"))
