"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver's ``events`` table through the stand-in shaping
of ``plans.standin`` and runs the library's operators over the whole table.
The test data are one month of ticks, so the price window is one day
(FIXTURES.md: two seconds would leave one tick per window), and the scan
blocks are a week long so that the two-level scans carry state across
blocks on a month of data; the model's constants are unchanged. Doubles
are rounded to 8 decimals and timestamps are returned as TIMESTAMP_NTZ so
results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickrisk.functions.ieee import round8
from tickrisk.functions.parse import to_ntz
from tickrisk.operators import metrics as mt
from tickrisk.operators import points as pt
from tickrisk.operators import ticks as tk
from tickrisk.operators import weights as wt
from tickrisk.params import RiskParams
from tickrisk.plans import standin
from tickrisk.plans.batch import RiskJob
from tickrisk.session import configure, files_of
from tickrisk.sources.sinks import wire_record

TEST_WINDOW = "1 day"
TEST_PARAMS = RiskParams(window=TEST_WINDOW, block_seconds=7 * 86400,
                         series_block_seconds=7 * 86400)


def _ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return standin.events(spark, sf_dir)


def q_log_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _ev(spark, sf_dir)
    ticks = tk.typed_ticks(standin.price_ticks(ev))
    return q_log_return_select(tk.log_returns(ticks, window=TEST_WINDOW))


def q_log_return_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 + T1 event-time option: windows on the parsed last-traded time
    (ISO text with offset) instead of the arrival time."""
    ev = _ev(spark, sf_dir)
    ticks = tk.typed_ticks(standin.price_ticks(ev), event_time=True)
    return q_log_return_select(tk.log_returns(ticks, window=TEST_WINDOW))


def q_log_return_select(r: DataFrame) -> DataFrame:
    return r.select(
        "ticker",
        to_ntz("window_start").alias("window_start"),
        to_ntz("window_end").alias("window_end"),
        "n_ticks", "base_price", "last_price",
        round8("return_value").alias("return_value"),
        to_ntz("last_traded_ts").alias("last_traded_ts"))


_JOBS: dict = {}


def job(spark: SparkSession, sf_dir: str, params: RiskParams = TEST_PARAMS) -> RiskJob:
    """The batch job over the stand-in inputs of ``sf_dir``.

    One job per (session, present files, parameters): the registered queries are
    outputs of the same job and share its materialised stages, as the
    original job computes all its outputs in one topology. Changed files make a new job.
    """
    key = (id(spark), spark.sparkContext.applicationId, files_of(spark, f"{sf_dir.rstrip('/')}/events.parquet"), params)
    if key not in _JOBS:
        ev = _ev(spark, sf_dir)
        _JOBS[key] = RiskJob(ticks_raw=standin.price_ticks(ev),
                             stats_records=standin.stats_seeds(ev),
                             weight_snapshots=standin.weight_snapshots(ev),
                             holdings=standin.holdings(ev),
                             params=params)
    configure(spark)
    return _JOBS[key]


def q_stats_seed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + J3: returns fanned out to holding portfolios, kept from the seed on."""
    a = job(spark, sf_dir).applied
    return a.select("portfolio_id", "ticker", to_ntz("order_ts").alias("order_ts"),
                    round8("return_value").alias("return_value"), to_ntz("seed_ts").alias("seed_ts"))


def q_ew_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: mean of the ticker after each applied return."""
    s = job(spark, sf_dir).series
    return s.select("portfolio_id", "ticker", to_ntz("order_ts").alias("order_ts"), "n",
                    round8("mean").alias("mean"))


def q_ew_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: diagonal covariance of the ticker after each applied return."""
    s = job(spark, sf_dir).series.filter(F.col("var0").isNotNull())
    return s.select("portfolio_id", "ticker", to_ntz("order_ts").alias("order_ts"), "n",
                    round8("var").alias("var"))


def q_cov_decay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Off-diagonal covariance after all applied returns."""
    o = job(spark, sf_dir).offdiag
    return o.select("portfolio_id", "i", "j", "n_i", "n_j", round8("cov").alias("cov"))


def explode_records(rec: DataFrame) -> DataFrame:
    """Statistics records -> ``(portfolio_id, order_ts, ticker, kind, i, j, value)``."""
    means = rec.select("portfolio_id", "o_ts", "ticker", F.lit("mean").alias("kind"),
                       F.explode("meanReturns").alias("i", "value")).withColumn("j", F.lit(""))
    cov = (rec.select("portfolio_id", "o_ts", "ticker",
                      F.explode("covarianceMatrix").alias("i", "row"))
           .select("portfolio_id", "o_ts", "ticker", F.lit("cov").alias("kind"), "i",
                   F.explode("row").alias("j", "value")))
    return means.unionByName(cov).select(
        "portfolio_id", to_ntz("o_ts").alias("order_ts"), "ticker", "kind", "i", "j",
        round8("value").alias("value"))


def q_stats_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1/P13 batch twin: every cell of the statistics record emitted after
    each applied return (mean map and symmetric covariance map)."""
    return explode_records(job(spark, sf_dir).records)


def _vs_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job(spark, sf_dir).vs_final


def q_expected_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: expected return of every weight snapshot against the final statistics."""
    m = _vs_final(spark, sf_dir)
    return m.select("portfolio_id", "seq", round8("expected_return").alias("expected_return"))


def q_portfolio_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: variance and risk of every weight snapshot against the final statistics."""
    m = _vs_final(spark, sf_dir)
    return m.select("portfolio_id", "seq", round8("variance").alias("variance"),
                    round8("risk").alias("risk"))


def q_sharpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: Sharpe ratio of every weight snapshot against the final statistics."""
    m = _vs_final(spark, sf_dir)
    return m.select("portfolio_id", "seq", round8("expected_return").alias("expected_return"),
                    round8("risk").alias("risk"), round8("sharpe").alias("sharpe"))


def _metrics_out(df: DataFrame) -> DataFrame:
    return df.select("portfolio_id", to_ntz("o_ts").alias("o_ts"), "o_side", "o_seq", "o_tie",
                     round8("expected_return").alias("expected_return"),
                     round8("risk").alias("risk"), round8("sharpe").alias("sharpe"))


def q_metrics_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics candidate of every trigger (weights x updated statistics)."""
    return _metrics_out(job(spark, sf_dir).candidates)


def q_metrics_emit_on_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidates whose (E, risk) changed: the published metrics."""
    return _metrics_out(job(spark, sf_dir).emitted)


def q_weights_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight snapshots -> one point per non-null weight."""
    p = pt.weight_points(standin.weight_snapshots(_ev(spark, sf_dir)))
    return p.select(*[round8(c).alias(c) if c == "value" else c for c in pt.POINT_COLS])


def q_weight_time_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lenient weight-row time text -> epoch millis."""
    t = wt.typed_weight_rows(standin.weight_rows(_ev(spark, sf_dir)))
    return t.select("seq", "portfolio_id", "ticker", "time", "time_ms")


def q_weights_rows_to_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text weight rows -> weight map per (portfolio, time), exploded."""
    snaps = wt.rows_to_snapshots(wt.typed_weight_rows(standin.weight_rows(_ev(spark, sf_dir))))
    return (snaps.select("portfolio_id", F.col("timestamp").alias("time_ms"),
                         F.size("weights").cast("bigint").alias("n_tickers"),
                         F.explode("weights").alias("ticker", "weight"))
            .select("portfolio_id", "time_ms", "ticker", round8("weight").alias("weight"),
                    "n_tickers"))


def q_metric_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published metrics -> three points each."""
    rec = mt.to_metrics_record(job(spark, sf_dir).emitted)
    p = pt.metric_points(rec)
    return p.select(*[round8(c).alias(c) if c == "value" else c for c in pt.POINT_COLS])


def q_metrics_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: published metrics as wire records (event stamp)."""
    rec = wire_record(mt.to_metrics_record(job(spark, sf_dir).emitted), "portfolio_metrics")
    return rec.select("portfolioId", *[round8(c).alias(c) for c in ("risk", "expectedReturn", "sharpRatio")],
                      "timestamp")


def q_processing_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published metrics stamped by the wall clock; the stamp itself changes from run
    to run, so the query tells whether it is later than every event."""
    rec = mt.to_metrics_record(job(spark, sf_dir).emitted, stamp="processing")
    return rec.select("portfolioId", round8("risk").alias("risk"), round8("expectedReturn").alias("expectedReturn"),
                      (F.col("timestamp") > F.unix_millis(F.lit("2024-12-31 00:00:00").cast("timestamp")))
                      .alias("stamped_now"))


def q_constant_portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without holdings every return goes to the one constant portfolio."""
    ticks = tk.typed_ticks(standin.price_ticks(_ev(spark, sf_dir)))
    r = tk.assign_portfolios(tk.log_returns(ticks, window=TEST_WINDOW))
    return r.select("portfolio_id", "ticker", to_ntz("window_end").alias("window_end"),
                    round8("return_value").alias("return_value"))


def q_log_return_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of both signs and zero: a zero base gives no row, a zero last price
    -Infinity, prices of different sign no row, two negative prices a return."""
    ticks = tk.typed_ticks(standin.signed_price_ticks(_ev(spark, sf_dir)))
    return q_log_return_select(tk.log_returns(ticks, window=TEST_WINDOW))


def q_lenient_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 with ``strict=False``: ticks whose text does not parse are split off before the
    window; returns of the others, and the number of ticks kept apart per ticker and day."""
    typed = tk.typed_ticks(standin.dirty_price_ticks(_ev(spark, sf_dir)), strict=False)
    good, bad = tk.quarantine_split(typed)
    r = tk.log_returns(good, window=TEST_WINDOW).select(
        "ticker", F.col("window_start").alias("day"), "n_ticks", round8("return_value").alias("return_value"))
    b = bad.groupBy("ticker", F.date_trunc("day", "ts").alias("day")).agg(F.count("*").alias("n_bad"))
    out = r.join(b, ["ticker", "day"], "left")
    return out.select("ticker", to_ntz("day").alias("day"), "n_ticks", "return_value",
                      F.coalesce("n_bad", F.lit(0)).cast("bigint").alias("n_bad"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "log_return": q_log_return,
    "log_return_event_time": q_log_return_event_time,
    "stats_seed_join": q_stats_seed_join,
    "ew_mean": q_ew_mean,
    "ew_variance": q_ew_variance,
    "cov_decay": q_cov_decay,
    "stats_records": q_stats_records,
    "expected_return": q_expected_return,
    "portfolio_risk": q_portfolio_risk,
    "sharpe": q_sharpe,
    "metrics_asof": q_metrics_asof,
    "metrics_emit_on_change": q_metrics_emit_on_change,
    "weights_explode": q_weights_explode,
    "weight_time_parse": q_weight_time_parse,
    "weights_rows_to_map": q_weights_rows_to_map,
    "metric_points": q_metric_points,
    "metrics_record": q_metrics_record,
    "processing_stamp": q_processing_stamp,
    "constant_portfolio": q_constant_portfolio,
    "log_return_edge": q_log_return_edge,
    "lenient_ticks": q_lenient_ticks,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published metrics records of the whole job."""
    return mt.to_metrics_record(job(spark, sf_dir).emitted)
