"""Streaming topology: three restartable queries.

* Query A (``stats_stream``): ticks -> 2 s tumbling windows (watermark on
  prices only) -> log returns -> portfolios holding the ticker -> keyed
  statistics update (seeds from ``initialState`` and/or a seed stream) ->
  updated statistics records (K1).
* Query B (``metrics_stream``): K1 records U weight snapshots -> keyed
  metrics with emit on change -> metrics records (K2, K4, K6).
* Query C: weight snapshots -> point table (K5) via ``sinks.points_writer``.
* Factored mode: ``ticker_stats_stream`` (state per (portfolio, ticker))
  and ``metrics_stream_factored`` (covariances derived from the seed and
  the tick counts) replace Query A's and B's processors.

``streaming.job.StreamingJob`` wires the record-mode queries to their sinks.
Watermarks go on the price stream only: a quiet control stream would pin
the global watermark (minimum over sources) and no window would close.
The processors sort each micro-batch by the order key; a replay that
delivers a query's whole input in one micro-batch reproduces the batch
results exactly (tests and the registered stream queries do so).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickrisk.operators import stats as st
from tickrisk.operators import ticks as tk
from tickrisk.params import RiskParams
from tickrisk.streaming.processors import (METRICS_OUT, SNAPSHOTS_OUT, STATS_OUT, TICK_WINDOWS_OUT, TICKER_STATS_OUT,
                                           FactoredMetricsProcessor, MetricsProcessor,
                                           StatsUpdateProcessor, TickerStatsProcessor, TickWindowProcessor,
                                           WeightRowsProcessor)


def _nan_if_null(c):
    return F.coalesce(c, F.lit(float("nan")))


def restore_nan_stats(df: DataFrame) -> DataFrame:
    """NULL map values of processor output -> NaN (record values are non-null)."""
    return df.withColumn("meanReturns", F.transform_values(
        "meanReturns", lambda k, v: _nan_if_null(v))).withColumn(
        "covarianceMatrix", F.transform_values(
            "covarianceMatrix", lambda k, row: F.transform_values(row, lambda k2, v: _nan_if_null(v))))


def restore_nan_metrics(df: DataFrame) -> DataFrame:
    for c in ("expected_return", "variance", "risk", "sharpe"):
        df = df.withColumn(c, _nan_if_null(F.col(c)))
    return df


def restore_nan_ticker_stats(df: DataFrame) -> DataFrame:
    """NaN for present-but-NULL values; the presence flags stay (pandas
    cannot tell NULL from NaN in a float column)."""
    return (df.withColumn("mean", F.when(F.col("has_mean"), _nan_if_null(F.col("mean"))))
            .withColumn("var", F.when(F.col("has_var"), _nan_if_null(F.col("var")))))


def returns_stream(ticks_raw: DataFrame, params: RiskParams, strict: bool = True,
                   event_time: bool = False) -> DataFrame:
    """T1/T2 + A1: streaming log returns (append mode, closed windows only).

    Arrival-time windows use ``params.arrival_watermark``; ``event_time=True``
    windows on the last-traded time with ``params.watermark``. Both are 1 minute: a tick
    that arrives later than that is dropped and counted by Spark (``tick_windows_stream`` keeps it).
    """
    ticks = tk.typed_ticks(ticks_raw, strict=strict, event_time=event_time)
    if not strict:
        ticks = tk.quarantine_split(ticks)[0]
    wm = params.watermark if event_time else params.arrival_watermark
    return tk.log_returns(ticks, window=params.window, watermark=wm)


NO_TIME = -(1 << 62)                    # stands for an unknown last-traded time on its way through pandas


def tick_windows_stream(ticks_raw: DataFrame, params: RiskParams, strict: bool = True,
                        event_time: bool = False) -> DataFrame:
    """T1/T2 + A1 that lose no tick (``processors.TICK_WINDOWS_OUT``): the closed windows, and the ticks later
    than the watermark as rows of their own (``window_returns``, ``late_ticks`` tell them apart).

    State is kept per (ticker, window), so a hot ticker spreads over its windows. Ticks are not
    combined before the shuffle, unlike in ``returns_stream``. The key carries no event-time
    mark, else Spark would remove late rows before the processor sees them.
    """
    ticks = tk.typed_ticks(ticks_raw, strict=strict, event_time=event_time)
    if not strict:
        ticks = tk.quarantine_split(ticks)[0]
    o_seq, o_tie = st.order_columns(ticks)
    wm = params.watermark if event_time else params.arrival_watermark
    rows = ticks.withWatermark("ts", wm).withColumn("w", F.window("ts", params.window)).select(
        "ticker", F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"),
        o_seq.alias("o_seq"), o_tie.alias("o_tie"), "opening_price", "current_price",
        F.coalesce(F.unix_micros("event_ts"), F.lit(NO_TIME)).alias("event_us"))
    return rows.groupBy("ticker", "start_us", "end_us").transformWithStateInPandas(
        statefulProcessor=TickWindowProcessor(), outputStructType=TICK_WINDOWS_OUT, outputMode="Append",
        timeMode="EventTime")


def _typed_windows(windows: DataFrame) -> DataFrame:
    return windows.select(
        "ticker", F.timestamp_micros("start_us").alias("window_start"), F.timestamp_micros("end_us").alias("window_end"),
        "n_ticks", _nan_if_null(F.col("first_open")).alias("first_open"),
        _nan_if_null(F.col("last_current")).alias("last_current"),
        F.timestamp_micros(F.nullif("last_us", F.lit(NO_TIME))).alias("last_traded_ts"), "o_seq", "o_tie", "late")


def window_returns(windows: DataFrame) -> DataFrame:
    """Log returns of the closed windows of ``tick_windows_stream``."""
    return tk.returns_of_windows(_typed_windows(windows).filter(~F.col("late")))


def late_ticks(windows: DataFrame) -> DataFrame:
    """The late ticks of ``tick_windows_stream``, one row each, with the window they missed."""
    return _typed_windows(windows).filter("late").select(
        "ticker", "window_start", "window_end", "o_seq", "o_tie", F.col("first_open").alias("opening_price"),
        F.col("last_current").alias("current_price"), "last_traded_ts")


def _control_watermark(df: DataFrame, delay: str | None) -> DataFrame:
    """Optional watermark on a control stream (statistics, weights).

    Off by default: the global watermark is the minimum over the sources, so
    a quiet control stream with a watermark would hold back every window.
    """
    if not delay:
        return df
    return (df.withColumn("_ctl_ts", F.timestamp_millis("timestamp"))
            .withWatermark("_ctl_ts", delay).drop("_ctl_ts"))


def stats_stream(ticks_raw: DataFrame, params: RiskParams, holdings: DataFrame | None = None,
                 seeds: DataFrame | None = None, seed_stream: DataFrame | None = None,
                 portfolio_id: str = "portf1", stamp: str = "event",
                 control_watermark: str | None = None, strict: bool = True,
                 seed_time: bool = False, returns: DataFrame | None = None) -> DataFrame:
    """Query A body: updated statistics records, one per applied return.

    ``seeds`` (static statistics records) become the processor's initial
    state, there before any return (``seed_time``: at their own time, for replays);
    ``seed_stream`` (streaming statistics records) is unioned in as
    ``kind='seed'`` rows. ``returns``: a stream of log returns to use instead of windows
    over ``ticks_raw``. Output columns: ``processors.STATS_OUT``.
    """
    r = returns_stream(ticks_raw, params, strict=strict) if returns is None else returns
    r = r.select("ticker", F.col("window_end").alias("o_ts"), "return_value")
    r = tk.assign_portfolios(r, holdings, portfolio_id)
    rows = r.select("portfolio_id", F.lit("ret").alias("kind"), "o_ts",
                    F.lit(1).alias("o_side"), F.lit(0).cast("bigint").alias("o_seq"),
                    F.col("ticker").alias("o_tie"), "ticker", "return_value",
                    F.lit(None).cast("bigint").alias("timestamp"),
                    F.lit(None).cast("map<string,double>").alias("meanReturns"),
                    F.lit(None).cast("map<string,map<string,double>>").alias("covarianceMatrix"))
    if seed_stream is not None:
        seed_stream = _control_watermark(seed_stream, control_watermark)
        o_seq, o_tie = st.order_columns(seed_stream)
        s = seed_stream.select(
            "portfolio_id", F.lit("seed").alias("kind"),
            F.timestamp_millis("timestamp").alias("o_ts"), F.lit(0).alias("o_side"),
            o_seq.alias("o_seq"), o_tie.alias("o_tie"),
            F.lit(None).cast("string").alias("ticker"),
            F.lit(None).cast("double").alias("return_value"),
            "timestamp", "meanReturns", "covarianceMatrix")
        rows = rows.unionByName(s)
    init = None
    if seeds is not None:
        init = st.first_seed(seeds).groupBy("portfolio_id")
    return restore_nan_stats(rows.groupBy("portfolio_id").transformWithStateInPandas(
        statefulProcessor=StatsUpdateProcessor(params.count, stamp, seed_time),
        outputStructType=STATS_OUT, outputMode="Append", timeMode="None",
        initialState=init))


def ticker_stats_stream(ticks_raw: DataFrame, params: RiskParams, seeds: DataFrame,
                        holdings: DataFrame | None = None,
                        portfolio_id: str = "portf1", strict: bool = True,
                        seed_time: bool = False, returns: DataFrame | None = None) -> DataFrame:
    """Query A, factored mode: per (portfolio, ticker) series rows
    (``processors.TICKER_STATS_OUT``), state keyed by (portfolio, ticker).

    ``seeds``: static statistics records; their first record per portfolio
    is exploded to one initial state per (portfolio, ticker) of its maps, there before
    any return unless ``seed_time``. ``returns``: as in ``stats_stream``.
    """
    r = returns_stream(ticks_raw, params, strict=strict) if returns is None else returns
    r = r.select("ticker", F.col("window_end").alias("o_ts"), "return_value")
    r = tk.assign_portfolios(r, holdings, portfolio_id)
    seed = st.first_seed(seeds)
    r = r.join(seed.select("portfolio_id", F.col("timestamp").alias("seed_ms")), "portfolio_id")
    keys = (st.seed_means(seed).select(*st.PT)
            .unionByName(st.seed_cov_rows(seed).select(*st.PT)).distinct())
    init = (keys.join(st.seed_means(seed), st.PT, "left")
            .join(st.seed_diag(seed), st.PT, "left"))
    return restore_nan_ticker_stats(
        r.select("portfolio_id", "ticker", "o_ts", "return_value", "seed_ms").groupBy(
            "portfolio_id", "ticker").transformWithStateInPandas(
            statefulProcessor=TickerStatsProcessor(params.count, seed_time),
            outputStructType=TICKER_STATS_OUT, outputMode="Append", timeMode="None",
            initialState=init.groupBy("portfolio_id", "ticker")))


def weight_snapshot_stream(typed_rows: DataFrame, wait_ms: int | None = 2000) -> DataFrame:
    """Streaming long-form weight rows (``weights.typed_weight_rows``) -> weight snapshots
    (``processors.SNAPSHOTS_OUT``), for ``metrics_stream`` like those of a topic. ``wait_ms``: how long
    the newest snapshot of a quiet portfolio waits for more rows; None: until a later time comes."""
    rows = typed_rows.filter(F.col("time_ms").isNotNull()).select(
        "portfolio_id", "time_ms", "ticker", "weight", F.col("seq").cast("bigint").alias("seq"))
    return rows.groupBy("portfolio_id").transformWithStateInPandas(
        statefulProcessor=WeightRowsProcessor(wait_ms), outputStructType=SNAPSHOTS_OUT, outputMode="Append",
        timeMode="None" if wait_ms is None else "ProcessingTime")


def metrics_stream(stats_records: DataFrame, weight_snapshots: DataFrame,
                   params: RiskParams, control_watermark: str | None = None) -> DataFrame:
    """Query B body: emitted metrics (``processors.METRICS_OUT``).

    ``stats_records``: Query A output (``o_ts`` = the return's order time);
    ``weight_snapshots``: ``seq, timestamp, portfolio_id, weights``.
    """
    weight_snapshots = _control_watermark(weight_snapshots, control_watermark)
    w_seq, w_tie = st.order_columns(weight_snapshots)
    s = stats_records.select(
        "portfolio_id", F.lit("stats").alias("kind"), F.col("o_ts").cast("timestamp").alias("o_ts"),
        F.lit(1).alias("o_side"), F.lit(0).cast("bigint").alias("o_seq"),
        F.col("ticker").alias("o_tie"), "meanReturns", "covarianceMatrix",
        F.lit(None).cast("map<string,double>").alias("weights"))
    w = weight_snapshots.select(
        "portfolio_id", F.lit("weights").alias("kind"), F.timestamp_millis("timestamp").alias("o_ts"),
        F.lit(2).alias("o_side"), w_seq.alias("o_seq"), w_tie.alias("o_tie"),
        F.lit(None).cast("map<string,double>").alias("meanReturns"),
        F.lit(None).cast("map<string,map<string,double>>").alias("covarianceMatrix"),
        "weights")
    return restore_nan_metrics(s.unionByName(w).groupBy("portfolio_id").transformWithStateInPandas(
        statefulProcessor=MetricsProcessor(params.periods, params.risk_free),
        outputStructType=METRICS_OUT, outputMode="Append", timeMode="None"))


SEED_PLACE = "1700-01-01 00:00:00"        # before any trigger; pandas has no time before 1677


def metrics_stream_factored(series: DataFrame, weight_snapshots: DataFrame, seeds: DataFrame,
                            params: RiskParams) -> DataFrame:
    """Query B, factored mode: ``series`` is ``ticker_stats_stream`` output
    (per (portfolio, ticker) rows after each applied return). Output: METRICS_OUT.

    The seed reaches the processor as a row, in the micro-batch in which its portfolio comes up for the
    first time, ordered before all others. It is no ``initialState``, since PySpark then
    holds all rows of a key in the worker until its initial rows are read."""
    seed = st.first_seed(seeds).select(F.col("portfolio_id").alias("_p"), "meanReturns", "covarianceMatrix")
    w_seq, w_tie = st.order_columns(weight_snapshots)
    s = series.select(
        "portfolio_id", F.lit("series").alias("kind"), F.col("o_ts").cast("timestamp").alias("o_ts"),
        F.lit(1).alias("o_side"), F.lit(0).cast("bigint").alias("o_seq"),
        F.col("ticker").alias("o_tie"), "ticker", "n", "has_mean", "mean", "has_var", "var",
        F.lit(None).cast("map<string,double>").alias("weights"))
    w = weight_snapshots.select(
        "portfolio_id", F.lit("weights").alias("kind"), F.timestamp_millis("timestamp").alias("o_ts"),
        F.lit(2).alias("o_side"), w_seq.alias("o_seq"), w_tie.alias("o_tie"), F.lit(None).cast("string").alias("ticker"),
        F.lit(None).cast("bigint").alias("n"), F.lit(None).cast("boolean").alias("has_mean"),
        F.lit(None).cast("double").alias("mean"), F.lit(None).cast("boolean").alias("has_var"),
        F.lit(None).cast("double").alias("var"), "weights")
    new = s.select("portfolio_id").unionByName(w.select("portfolio_id")).dropDuplicates(["portfolio_id"])
    first = (new.join(seed, new["portfolio_id"].eqNullSafe(seed["_p"]))
             .select("portfolio_id", F.lit("seed").alias("kind"), F.lit(SEED_PLACE).cast("timestamp").alias("o_ts"),
                     F.lit(0).alias("o_side"), "meanReturns", "covarianceMatrix"))
    rows = s.unionByName(w).unionByName(first, allowMissingColumns=True)
    return restore_nan_metrics(rows.groupBy("portfolio_id").transformWithStateInPandas(
        statefulProcessor=FactoredMetricsProcessor(params.count, params.periods, params.risk_free),
        outputStructType=METRICS_OUT, outputMode="Append", timeMode="None"))


def finish(q, timeout_s: int | None = None) -> None:
    """Wait until an available-now query has read everything (``timeout_s``: give up then)."""
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"streaming query did not finish within {timeout_s}s")
    if q.exception() is not None:
        raise q.exception()


def run_available_now(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                      timeout_s: int | None = None) -> None:
    """Run a streaming DataFrame over everything available, into files."""
    finish(df.writeStream.format(fmt).option("path", path)
           .option("checkpointLocation", checkpoint).outputMode("append")
           .trigger(availableNow=True).start(), timeout_s)
