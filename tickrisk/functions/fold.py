"""The statistics and metrics rules for one record at a time, on plain values.

Used where a record must be folded in order: by the stateful processors and by
``operators.exact`` for portfolios that the closed form does not cover. Shipped to
Python workers by value.
"""

from __future__ import annotations

import math
import struct
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def sorted_total(values) -> float:
    acc = 0.0
    for v in sorted(values, key=lambda x: (math.isnan(x), x)):
        acc += v
    return acc


def ieee_quotient(a: float, b: float) -> float:
    if math.isnan(a) or math.isnan(b):
        return float("nan")
    if b != 0:
        return a / b
    if a > 0:
        return float("inf")
    if a < 0:
        return float("-inf")
    return float("nan")


def java_equals(a: float, b: float) -> bool:
    if math.isnan(a) and math.isnan(b):
        return True
    return struct.pack(">d", a) == struct.pack(">d", b)


def portfolio_metrics(weights: dict, means: dict, cov: dict, periods: int = 52,
                      risk_free: float = 0.0018):
    """E, variance, risk, Sharpe of one weight map against one statistics state."""
    e = sorted_total([w * means.get(t, 0.0) for t, w in weights.items()])
    row_sums = []
    for i, wi in weights.items():
        row = cov.get(i, {})
        terms = [wj * row[j] for j, wj in weights.items() if j in row]
        if terms:
            row_sums.append(wi * sorted_total(terms))
    var = sorted_total(row_sums)
    risk = math.sqrt(var) if var >= 0 or math.isnan(var) else float("nan")
    return e, var, risk, ieee_quotient(math.sqrt(periods) * (e - risk_free), risk)


def apply_return(means: dict, cov: dict, s: str, r: float, n_div: int) -> set:
    """One return ``r`` of ticker ``s`` applied to a statistics record in place.

    * the mean of ``s`` moves by ``(r - m)/n_div`` only when it is non-zero
      (unknown tickers stay unknown, a zero mean stays zero);
    * the cells of row ``s`` whose column has a non-zero mean (read after the
      mean update) and a non-zero value move by ``(d_s*d_o - c)/n_div`` with
      ``d_s = r - m_old`` and ``d_o = r - m_s`` on the diagonal, ``m_o - m_o``
      (0, or NaN for a non-finite mean) elsewhere; each new value is written
      to ``[s][o]`` and ``[o][s]``.

    Every update reads only row ``s`` (as it was before this return), so the
    order over cells does not matter. Returns the written cells.
    """
    m_old = means.get(s, 0.0)
    if m_old != 0.0:
        means[s] = m_old + (r - m_old) / n_div
    row = dict(cov.get(s, {}))
    live = {o for o, m in means.items() if m != 0.0}
    written = set()
    for o in live & {o for o, c in row.items() if c != 0.0}:
        c = row[o]
        d_o = (r - means[s]) if o == s else (means[o] - means[o])
        v = c + ((r - m_old) * d_o - c) / n_div
        cov.setdefault(s, {})[o] = v
        cov.setdefault(o, {})[s] = v
        written |= {(s, o), (o, s)}
    return written
