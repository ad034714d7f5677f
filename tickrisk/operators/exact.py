"""Record-by-record statistics for portfolios outside the closed form.

An asymmetric seed, an infinite return or a mean that becomes exactly 0 makes cells
depend on the order of all returns of the portfolio. Such portfolios (and only these)
are folded with the step rule: their seed, returns and weight snapshots are dealt by
portfolio and sorted by the order key, and each partition is read once as a stream,
with the state of one portfolio (means, covariances, weights) held at a time. The
work of one such portfolio is sequential, as its rule is.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickrisk.functions.fold import apply_return, portfolio_metrics
from tickrisk.operators import stats as st
from tickrisk.params import RiskParams

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MEANS, COV = "map<string,double>", "map<string,map<string,double>>"
# what: "return" (after an applied return), "trigger" (a metrics candidate), "end"
EVENTS = (f"what string, portfolio_id string, o_ts timestamp, o_side int, o_seq long, o_tie string, n long, "
          f"return_value double, mean0 double, mean_prev double, mean double, var0 double, var double, "
          f"expected_return double, variance double, risk double, sharpe double, "
          f"meanReturns {MEANS}, covarianceMatrix {COV}, counts map<string,bigint>")
COLUMNS = [c.split(" ")[0] for c in EVENTS.split(", ")]


def fold_events(applied: DataFrame, seed: DataFrame, snapshots: DataFrame, params: RiskParams,
                records: bool = False) -> DataFrame:
    """Rows of ``EVENTS`` for every portfolio of ``seed``; with ``records`` each return
    also carries the whole statistics record. ``end`` rows hold the final state."""
    null = {"ticker": "string", "return_value": "double", "maps": MEANS, "cov": COV}

    def blank(*names):
        return [F.lit(None).cast(null[c]).alias(c) for c in names]

    w_seq, w_tie = st.order_columns(snapshots)
    rows = (seed.select("portfolio_id", F.lit(None).cast("timestamp").alias("o_ts"), F.lit(0).alias("o_side"),
                        F.lit(0).cast("bigint").alias("o_seq"), F.lit("").alias("o_tie"),
                        *blank("return_value"), F.col("meanReturns").cast(MEANS).alias("maps"),
                        F.col("covarianceMatrix").cast(COV).alias("cov"))
            .unionByName(applied.select(
                "portfolio_id", F.col("order_ts").alias("o_ts"), F.lit(1).alias("o_side"),
                F.lit(0).cast("bigint").alias("o_seq"), F.col("ticker").alias("o_tie"), "return_value",
                *blank("maps", "cov")))
            .unionByName(snapshots.join(seed.select("portfolio_id"), "portfolio_id", "left_semi").select(
                "portfolio_id", F.timestamp_millis("timestamp").alias("o_ts"), F.lit(2).alias("o_side"),
                w_seq.alias("o_seq"), w_tie.alias("o_tie"), *blank("return_value"),
                F.col("weights").cast(MEANS).alias("maps"), *blank("cov"))))
    n_div, periods, risk_free = params.n, params.periods, params.risk_free

    def row(what, portfolio, r=None, **values):
        order = (r.o_ts, int(r.o_side), int(r.o_seq), r.o_tie) if r is not None else (None, None, None, None)
        held = dict(zip(COLUMNS, (what, portfolio, *order))) | values
        return [held.get(c) for c in COLUMNS]

    def number(x):
        return None if x is None else float(x)

    def run(frames):
        portfolio, out = None, []
        means, cov, means0, var0, counts, weights, seen = {}, {}, {}, {}, {}, None, False

        def end():
            return row("end", portfolio, meanReturns=means, covarianceMatrix=cov, counts=counts)

        for frame in frames:
            for r in frame.itertuples(index=False):
                if r.portfolio_id != portfolio:
                    if portfolio is not None:
                        out.append(end())
                    portfolio, counts, weights, seen = r.portfolio_id, {}, None, False
                    means, cov = {}, {}
                if r.o_side == 0:                             # the seed sorts first (null time)
                    means = dict(r.maps or {})
                    cov = {i: dict(c or {}) for i, c in dict(r.cov or {}).items()}
                    means0, var0 = dict(means), {i: c[i] for i, c in cov.items() if i in c}
                    continue
                if r.o_side == 1:
                    s, before = r.o_tie, means.get(r.o_tie)
                    apply_return(means, cov, s, float(r.return_value), n_div)
                    counts[s] = counts.get(s, 0) + 1
                    seen = True
                    whole = ({"meanReturns": dict(means), "covarianceMatrix": {i: dict(c) for i, c in cov.items()}}
                             if records else {})
                    out.append(row("return", portfolio, r, n=counts[s], return_value=float(r.return_value),
                                   mean0=number(means0.get(s)), mean_prev=number(before),
                                   mean=number(means.get(s)), var0=number(var0.get(s)),
                                   var=number(cov.get(s, {}).get(s)), **whole))
                else:
                    weights = {t: w for t, w in dict(r.maps or {}).items() if w is not None}
                if seen and weights is not None:
                    e, variance, risk, sharpe = portfolio_metrics(weights, means, cov, periods, risk_free)
                    out.append(row("trigger", portfolio, r, expected_return=e, variance=variance,
                                   risk=risk, sharpe=sharpe))
                if len(out) >= (64 if records else 4096):
                    yield pd.DataFrame(out, columns=COLUMNS)
                    out = []
        if portfolio is not None:
            out.append(end())
            yield pd.DataFrame(out, columns=COLUMNS)

    folded = (rows.repartition("portfolio_id").sortWithinPartitions("portfolio_id", "o_ts", "o_side", "o_seq", "o_tie")
              .mapInPandas(run, EVENTS))

    # NaN becomes NULL on the way from pandas; these fields are never NULL where they exist
    def nan(c):
        return F.coalesce(F.col(c), F.lit(float("nan")))

    here = F.col("what") == "return"
    for c in ("expected_return", "variance", "risk", "sharpe"):
        folded = folded.withColumn(c, F.when(F.col("what") == "trigger", nan(c)))
    for c, origin in (("mean", "mean0"), ("mean_prev", "mean0"), ("var", "var0")):
        folded = folded.withColumn(c, F.when(here & F.col(origin).isNotNull(), nan(c)).otherwise(F.col(c)))
    return (folded
            .withColumn("meanReturns", F.transform_values("meanReturns", lambda k, v: F.coalesce(v, F.lit(float("nan")))))
            .withColumn("covarianceMatrix", F.transform_values("covarianceMatrix", lambda k, c: F.transform_values(
                c, lambda k2, v: F.coalesce(v, F.lit(float("nan")))))))


def series_of(events: DataFrame) -> DataFrame:
    """Rows of ``stats.ew_var_series`` (tickers of the seed's mean map)."""
    return (events.filter((F.col("what") == "return") & F.col("mean0").isNotNull())
            .select("portfolio_id", F.col("o_tie").alias("ticker"), F.col("o_ts").alias("order_ts"), "n",
                    "return_value", "mean0", "mean_prev", "mean", "var0", "var"))


def candidates_of(events: DataFrame) -> DataFrame:
    return events.filter(F.col("what") == "trigger").select(
        "portfolio_id", "o_ts", "o_side", "o_seq", "o_tie", "expected_return", "variance", "risk", "sharpe")


def records_of(events: DataFrame) -> DataFrame:
    """Rows of ``metrics.statistics_records``."""
    return events.filter(F.col("what") == "return").select(
        "portfolio_id", "o_ts", F.col("o_tie").alias("ticker"), "n",
        F.unix_millis("o_ts").alias("timestamp"), "meanReturns", "covarianceMatrix")


def offdiag_of(events: DataFrame) -> DataFrame:
    """Rows of ``stats.final_offdiag``."""
    cells = (events.filter(F.col("what") == "end")
             .select("portfolio_id", "counts", F.explode("covarianceMatrix").alias("i", "row"))
             .select("portfolio_id", "counts", "i", F.explode("row").alias("j", "cov")).filter("i <> j"))

    def n(c):
        return F.coalesce(F.try_element_at("counts", F.col(c)), F.lit(0)).cast("bigint").alias(f"n_{c}")
    return cells.select("portfolio_id", "i", "j", n("i"), n("j"), "cov")


def final_metrics(events: DataFrame, snapshots: DataFrame, params: RiskParams) -> DataFrame:
    """Metrics of every snapshot against the final state."""
    from tickrisk.functions.ieee import map_metrics
    end = events.filter(F.col("what") == "end").select("portfolio_id", "meanReturns", "covarianceMatrix")
    m = (snapshots.join(end, "portfolio_id")
         .select("portfolio_id", "seq", map_metrics("weights", "meanReturns", "covarianceMatrix",
                                                    params.periods, params.risk_free).alias("m")))
    return m.select("portfolio_id", "seq", "m.*")
