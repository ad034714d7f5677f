"""Registered streaming queries: replay the stand-in inputs through the
streaming topology (``availableNow``) and return what the sinks received.

Sinks and checkpoints live under the shared checkpoint folder. The price
stream is the events file read as a file stream, plus one data-derived
sentinel tick (two days after the last event, on a ticker nobody holds)
whose only effect is to move the watermark past the last real window so
that it closes; the sentinel's own window stays open and emits nothing.
Outputs have the columns of the batch twins, so the same oracle applies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickrisk.functions.ieee import round8
from tickrisk.functions.parse import to_ntz
from tickrisk.plans import standin
from tickrisk.plans.queries import TEST_PARAMS, _metrics_out, q_log_return_select
from tickrisk.session import configure, files_of, scratch_path
from tickrisk.sources.streams import file_source, single_file_glob
from tickrisk.streaming import topology as tp
from tickrisk.streaming.processors import STATS_OUT

SENTINEL_TICKER = "__sentinel__"


def _events(spark: SparkSession, sf_dir: str):
    configure(spark)
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    static = spark.read.parquet(path)
    stream = file_source(spark, single_file_glob(path), static.schema, stream=True)
    return static, stream


def _sentinel(static: DataFrame) -> DataFrame:
    return (static.agg(F.max("ts").cast("timestamp").alias("mx"))
            .select(F.lit(-1).cast("bigint").alias("seq"),
                    (F.col("mx") + F.expr("INTERVAL 2 DAYS")).alias("arrival_ts"),
                    F.lit(SENTINEL_TICKER).alias("ticker"),
                    F.lit("1").alias("field_opening_price"),
                    F.lit("1").alias("field_cours_courant"),
                    F.date_format(F.col("mx") + F.expr("INTERVAL 2 DAYS"),
                                  "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("field_last_traded_time")))


def _tick_stream(spark: SparkSession, static: DataFrame, stream: DataFrame, root: str) -> DataFrame:
    ticks = standin.price_ticks(stream)
    sent = _sentinel(static)
    sent.write.mode("overwrite").parquet(f"{root}/sentinel")
    sent_stream = file_source(spark, f"{root}/sentinel", sent.schema, stream=True)
    return ticks.unionByName(sent_stream)


def _run(df: DataFrame, root: str, name: str) -> DataFrame:
    tp.run_available_now(df, f"{root}/{name}", f"{root}/{name}-ckpt")
    return df.sparkSession.read.parquet(f"{root}/{name}")


def q_stream_log_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1/T2/A1 streaming: windowed log returns via append-mode aggregation."""
    static, stream = _events(spark, sf_dir)
    root = scratch_path(spark, "stream-log-return")
    r = tp.returns_stream(_tick_stream(spark, static, stream, root), TEST_PARAMS)
    return q_log_return_select(_run(r, root, "returns"))


_RUNS: dict = {}


def _stats_records(spark: SparkSession, sf_dir: str) -> str:
    """Run Query A (record mode) once per session and directory; returns the
    folder holding its ``stats`` sink."""
    key = (id(spark), spark.sparkContext.applicationId, files_of(spark, f"{sf_dir.rstrip('/')}/events.parquet"))
    if key not in _RUNS:
        root = scratch_path(spark, "stream-stats")
        static, stream = _events(spark, sf_dir)
        s = tp.stats_stream(_tick_stream(spark, static, stream, root), TEST_PARAMS,
                            holdings=standin.holdings(static), seeds=standin.stats_seeds(static),
                            seed_time=True)
        _run(s, root, "stats")
        _RUNS[key] = root
    return _RUNS[key]


def q_stream_stats_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 streaming (record mode): every cell of every emitted statistics record."""
    from tickrisk.plans.queries import explode_records
    root = _stats_records(spark, sf_dir)
    return explode_records(spark.read.parquet(f"{root}/stats"))


def q_stream_ew_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4/T6/J1/A4 streaming (record mode): mean of the updated ticker in each
    emitted statistics record."""
    root = _stats_records(spark, sf_dir)
    rec = spark.read.parquet(f"{root}/stats")
    m = F.try_element_at("meanReturns", F.col("ticker"))
    return (rec.filter(m.isNotNull())
            .select("portfolio_id", "ticker", to_ntz("o_ts").alias("order_ts"), "n",
                    round8(m).alias("mean")))


def q_stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5/T6/J2/W1 streaming (record mode): Query A, then Query B over its
    records and the weight snapshots; the published metrics."""
    stats_root = _stats_records(spark, sf_dir)
    root = scratch_path(spark, "stream-metrics")
    static, stream = _events(spark, sf_dir)
    stats_in = file_source(spark, f"{stats_root}/stats", STATS_OUT, stream=True)
    m = tp.metrics_stream(stats_in, standin.weight_snapshots(stream), TEST_PARAMS)
    return _metrics_out(_run(m, root, "metrics"))


_FACTORED: dict = {}


def _factored_series(spark: SparkSession, sf_dir: str) -> str:
    """Run the factored Query A once per session and directory."""
    key = (id(spark), spark.sparkContext.applicationId, files_of(spark, f"{sf_dir.rstrip('/')}/events.parquet"))
    if key not in _FACTORED:
        static, stream = _events(spark, sf_dir)
        root = scratch_path(spark, "stream-factored")
        s = tp.ticker_stats_stream(_tick_stream(spark, static, stream, root), TEST_PARAMS,
                                   seeds=standin.stats_seeds(static),
                                   holdings=standin.holdings(static), seed_time=True)
        _run(s, root, "series")
        _FACTORED[key] = root
    return _FACTORED[key]


def q_stream_metrics_factored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2/W1 streaming, factored mode: factored series (state per
    (portfolio, ticker)) U weight snapshots -> metrics derived from the seed
    and the tick counts; the published metrics."""
    from tickrisk.streaming.processors import TICKER_STATS_OUT
    series_root = _factored_series(spark, sf_dir)
    static, stream = _events(spark, sf_dir)
    root = scratch_path(spark, "stream-metrics-factored")
    ser = file_source(spark, f"{series_root}/series", TICKER_STATS_OUT, stream=True)
    m = tp.metrics_stream_factored(ser, standin.weight_snapshots(stream),
                                   standin.stats_seeds(static), TEST_PARAMS)
    return _metrics_out(_run(m, root, "metrics"))


def q_stream_ew_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4/A5 streaming, factored mode: state keyed by (portfolio, ticker);
    diagonal covariance after each applied return."""
    out = spark.read.parquet(f"{_factored_series(spark, sf_dir)}/series")
    return (out.filter(F.col("mean").isNotNull() & F.col("var").isNotNull())
            .select("portfolio_id", "ticker", to_ntz("o_ts").alias("order_ts"), "n",
                    round8("var").alias("var")))


def q_stream_control_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query B with a watermark on the weight stream; it removes nothing."""
    stats_root = _stats_records(spark, sf_dir)
    root = scratch_path(spark, "stream-control-watermark")
    static, stream = _events(spark, sf_dir)
    stats_in = file_source(spark, f"{stats_root}/stats", STATS_OUT, stream=True)
    m = tp.metrics_stream(stats_in, standin.weight_snapshots(stream), TEST_PARAMS, control_watermark="1 minute")
    return _metrics_out(_run(m, root, "metrics"))


def q_stream_weights_rows_to_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6/A7 streaming: text weight rows -> snapshots, gathered in state, exploded. A row of a far later
    time per portfolio (derived from the data) ends the last snapshot and stays pending itself."""
    from tickrisk.operators import weights as wt
    static, stream = _events(spark, sf_dir)
    root = scratch_path(spark, "stream-weight-rows")
    ends = (standin.weight_rows(static).groupBy("portfolio_id", "ticker").agg(F.max("seq").alias("seq"))
            .groupBy("portfolio_id").agg(F.max("seq").alias("seq"), F.min("ticker").alias("ticker"))
            .select("seq", F.lit("2999-01-01 00:00:00").alias("time"), "portfolio_id", "ticker", F.lit("0").alias("weight")))
    ends.write.mode("overwrite").parquet(f"{root}/ends")
    rows = standin.weight_rows(stream).unionByName(file_source(spark, f"{root}/ends", ends.schema, stream=True))
    snaps = _run(tp.weight_snapshot_stream(wt.typed_weight_rows(rows), wait_ms=None), root, "snapshots")
    return (snaps.select("portfolio_id", F.col("timestamp").alias("time_ms"),
                         F.size("weights").cast("bigint").alias("n_tickers"),
                         F.explode("weights").alias("ticker", "weight"))
            .select("portfolio_id", "time_ms", "ticker", round8("weight").alias("weight"), "n_tickers"))


def q_stream_late_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1/T2 streaming without a lost tick: the ticks of each day's last hour are delivered after all others, so the
    watermark has passed all windows but the last day's. Closed windows with their returns, and the late ticks."""
    static, _ = _events(spark, sf_dir)
    root = scratch_path(spark, "stream-late-ticks")
    last_hour = F.hour("ts") >= 23
    stream = file_source(spark, f"{root}/ticks/*", standin.price_ticks(static).schema, stream=True)
    for delivery in (1, 2):                 # the second run restarts from the checkpoint
        ticks = standin.price_ticks(static.filter(~last_hour if delivery == 1 else last_hour))
        if delivery == 2:
            ticks = ticks.unionByName(_sentinel(static))
        ticks.write.parquet(f"{root}/ticks/delivery={delivery}")
        found = _run(tp.tick_windows_stream(stream, TEST_PARAMS), root, "windows")
    closed = q_log_return_select(tp.window_returns(found)).withColumn("late", F.lit(False)).withColumn(
        "seq", F.lit(-1).cast("bigint"))
    late = tp.late_ticks(found).select(
        "ticker", to_ntz("window_start").alias("window_start"), to_ntz("window_end").alias("window_end"),
        F.lit(1).cast("bigint").alias("n_ticks"), F.col("opening_price").alias("base_price"),
        F.col("current_price").alias("last_price"), F.lit(None).cast("double").alias("return_value"),
        to_ntz("last_traded_ts").alias("last_traded_ts"), F.lit(True).alias("late"), F.col("o_seq").alias("seq"))
    return closed.unionByName(late)


STREAM_QUERIES = {
    "stream_late_ticks": q_stream_late_ticks,
    "stream_weights_rows_to_map": q_stream_weights_rows_to_map,
    "stream_log_return": q_stream_log_return,
    "stream_ew_mean": q_stream_ew_mean,
    "stream_metrics": q_stream_metrics,
    "stream_ew_variance": q_stream_ew_variance,
    "stream_stats_records": q_stream_stats_records,
    "stream_metrics_factored": q_stream_metrics_factored,
    "stream_control_watermark": q_stream_control_watermark,
}
