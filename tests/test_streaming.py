"""Streaming topology: stream = batch on the small data set, and a restart
from the checkpoint continues to the same result."""

import datetime as dt
import math
import tempfile

import pytest
from pyspark.sql import functions as F

from tickrisk.plans import standin
from tickrisk.plans import queries as Q
from tickrisk.plans import stream_queries as SQ
from tickrisk.sources.streams import file_source
from tickrisk.streaming import topology as tp
from tickrisk.functions.fold import portfolio_metrics

SF = "/root/testdata/sf0.001"


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


@pytest.mark.parametrize("stream_q,batch_q,cols", [
    ("stream_log_return", "log_return", ["ticker", "window_end", "return_value", "n_ticks"]),
    ("stream_ew_mean", "ew_mean", ["portfolio_id", "ticker", "order_ts", "n", "mean"]),
    ("stream_metrics", "metrics_emit_on_change",
     ["portfolio_id", "o_ts", "o_side", "o_seq", "expected_return", "risk"]),
    ("stream_ew_variance", "ew_variance", ["portfolio_id", "ticker", "order_ts", "n", "var"]),
    ("stream_stats_records", "stats_records",
     ["portfolio_id", "order_ts", "ticker", "kind", "i", "j", "value"]),
    ("stream_metrics_factored", "metrics_emit_on_change",
     ["portfolio_id", "o_ts", "o_side", "o_seq", "expected_return", "risk"]),
])
def test_stream_equals_batch(spark, stream_q, batch_q, cols):
    s = SQ.STREAM_QUERIES[stream_q](spark, SF)
    b = Q.QUERIES[batch_q](spark, SF)
    got, exp = _rows(s, cols), _rows(b, cols)
    assert len(exp) > 0 and got == exp


def test_restart_from_checkpoint(spark):
    """Half of the ticks, stop, the rest plus the sentinel, restart: the
    statistics records equal those of one uninterrupted run."""
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ticks = standin.price_ticks(ev)
    cut = dt.datetime(2024, 1, 15)
    root = tempfile.mkdtemp(prefix="restart-")
    src = f"{root}/ticks"
    ticks.filter(F.col("arrival_ts") < F.lit(cut)).write.parquet(f"{src}/part=1")
    schema = ticks.schema
    holdings, seeds = standin.holdings(ev), standin.stats_seeds(ev)

    def run(out):
        stream = file_source(spark, f"{src}/*", schema, stream=True)
        s = tp.stats_stream(stream, Q.TEST_PARAMS, holdings=holdings, seeds=seeds, seed_time=True)
        tp.run_available_now(s, out, f"{out}-ckpt")

    run(f"{root}/out")
    first = spark.read.parquet(f"{root}/out").count()
    rest = ticks.filter(F.col("arrival_ts") >= F.lit(cut))
    sent = (ev.agg(F.max("ts").cast("timestamp").alias("mx"))
            .select(F.lit(-1).cast("bigint").alias("seq"),
                    (F.col("mx") + F.expr("INTERVAL 2 DAYS")).alias("arrival_ts"),
                    F.lit("__sentinel__").alias("ticker"), F.lit("1").alias("field_opening_price"),
                    F.lit("1").alias("field_cours_courant"),
                    F.lit("2024-03-01T00:00:00.000000Z").alias("field_last_traded_time")))
    rest.unionByName(sent).write.parquet(f"{src}/part=2")
    run(f"{root}/out")                      # same checkpoint: continues
    got = spark.read.parquet(f"{root}/out")
    assert 0 < first < got.count()
    full = SQ.STREAM_QUERIES["stream_ew_mean"](spark, SF)
    m = F.try_element_at("meanReturns", F.col("ticker"))
    restarted = got.filter(m.isNotNull()).select(
        "portfolio_id", "ticker", F.col("o_ts").cast("timestamp_ntz").alias("order_ts"), "n",
        F.round(m, 8).alias("mean"))
    cols = ["portfolio_id", "ticker", "order_ts", "n", "mean"]
    assert _rows(restarted, cols) == _rows(full, cols)


def test_portfolio_metrics_rules():
    e, var, risk, sharpe = portfolio_metrics({"A": 0.6, "B": 0.4, "Z": 1.0},
                                             {"A": 0.01, "B": 0.02},
                                             {"A": {"A": 0.04, "B": 0.01},
                                              "B": {"A": 0.01, "B": 0.09}})
    assert e == pytest.approx(0.014) and var == pytest.approx(0.0336)
    assert sharpe == pytest.approx(52 ** 0.5 * 0.0122 / 0.1833030278)
    assert portfolio_metrics({"A": 1.0}, {"A": 0.1}, {"A": {"A": 0.0}})[3] == float("inf")


def _write(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).write.mode("append").parquet(path)


def test_seed_stream_first_wins_and_drops_early_returns(spark):
    """Seeds as a stream (kind='seed' rows): the first seed wins, a return
    ordered before it is dropped, a second seed is ignored."""
    from tickrisk.params import RiskParams
    from tickrisk.schemas import PORTFOLIO_STATS
    from pyspark.sql import types as T
    root = tempfile.mkdtemp(prefix="seedstream-")
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    tick_schema = ("seq long, arrival_ts timestamp, ticker string, field_opening_price string, "
                   "field_cours_courant string, field_last_traded_time string")
    ticks = []
    for k, (sec, o, c) in enumerate([(0.5, "10", "10"), (1.0, "10", "11"),      # window [0,2) -> before seed
                                     (4.5, "10", "10"), (5.0, "10", "12"),      # window [4,6)
                                     (600, "1", "1")]):                         # sentinel (closes windows)
        ts = t0 + dt.timedelta(seconds=sec)
        ticks.append((k, ts, "A" if sec < 600 else "S", o, c, ts.strftime("%Y-%m-%dT%H:%M:%S.%fZ")))
    _write(spark, ticks, tick_schema, f"{root}/ticks")
    seed_t = T.StructType([T.StructField("seq", T.LongType())] + PORTFOLIO_STATS.fields)
    ms = int((t0 - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
    _write(spark, [(1, ms + 3000, "portf1", {"A": 0.01}, {"A": {"A": 0.04}}),
                   (2, ms + 3500, "portf1", {"A": 5.0}, {"A": {"A": 5.0}})], seed_t, f"{root}/seeds")
    params = RiskParams(window="2 seconds", watermark="1 second")
    ts_stream = file_source(spark, f"{root}/ticks", tick_schema, stream=True)
    sd_stream = file_source(spark, f"{root}/seeds", seed_t, stream=True)
    s = tp.stats_stream(ts_stream, params, seed_stream=sd_stream, seed_time=True)
    tp.run_available_now(s, f"{root}/out", f"{root}/ckpt")
    out = spark.read.parquet(f"{root}/out").collect()
    assert len(out) == 1                                  # only the [4,6) window is applied
    r = out[0]
    ret = math.log(1.2)
    m1 = 0.01 + (ret - 0.01) / 1001
    assert r["meanReturns"]["A"] == pytest.approx(m1, rel=1e-12)
    assert r["covarianceMatrix"]["A"]["A"] == pytest.approx(
        0.04 + ((ret - 0.01) * (ret - m1) - 0.04) / 1001, rel=1e-12)


@pytest.mark.parametrize("mode", ["record", "factored"])
def test_initial_seed_is_there_before_any_return(spark, mode):
    """A static seed stamped 50 s after the first windows still applies to all of them; a
    ticker that the seed does not name triggers too (factored mode)."""
    from tickrisk.params import RiskParams
    from tickrisk.schemas import PORTFOLIO_STATS
    from pyspark.sql import types as T
    root = tempfile.mkdtemp(prefix="seed50-")
    t0 = dt.datetime(2024, 1, 1)
    sch = ("seq long, arrival_ts timestamp, ticker string, field_opening_price string, "
           "field_cours_courant string, field_last_traded_time string")
    ticks = []
    for k, (sec, tkr) in enumerate([(0.5, "A"), (4.5, "A"), (8.5, "Z"), (600, "S")]):
        ts = t0 + dt.timedelta(seconds=sec)
        ticks.append((k, ts, tkr, "10", "11", ts.strftime("%Y-%m-%dT%H:%M:%S.%fZ")))
    _write(spark, ticks, sch, f"{root}/ticks")
    seed_t = T.StructType([T.StructField("seq", T.LongType())] + PORTFOLIO_STATS.fields)
    ms = int((t0 - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
    seeds = spark.createDataFrame([(1, ms + 50_000, "portf1", {"A": 0.01}, {"A": {"A": 0.04}})], seed_t)
    params = RiskParams(window="2 seconds")
    stream = file_source(spark, f"{root}/ticks", sch, stream=True)
    s = (tp.stats_stream(stream, params, seeds=seeds) if mode == "record"
         else tp.ticker_stats_stream(stream, params, seeds=seeds))
    tp.run_available_now(s, f"{root}/out", f"{root}/ckpt")
    out = spark.read.parquet(f"{root}/out").collect()
    assert sorted((r["ticker"], r["n"]) for r in out) == [("A", 1), ("A", 2), ("Z", 1)]


def test_points_writer_foreach_batch(spark):
    from tickrisk.sources.sinks import points_writer
    root = tempfile.mkdtemp(prefix="points-stream-")
    _write(spark, [(1, 1000, "P", {"A": 0.5, "B": None})],
           "seq long, timestamp long, portfolio_id string, weights map<string,double>",
           f"{root}/w")
    snaps = file_source(spark, f"{root}/w",
                        "seq long, timestamp long, portfolio_id string, weights map<string,double>",
                        stream=True)
    q = (snaps.writeStream.foreachBatch(points_writer(f"{root}/pts", kind="weights"))
         .option("checkpointLocation", f"{root}/ck").trigger(availableNow=True).start())
    q.awaitTermination(300)
    points_writer(f"{root}/pts", kind="weights")(spark.read.parquet(f"{root}/w"), 0)   # the batch, retried
    pts = spark.read.parquet(f"{root}/pts").collect()
    assert [(p["bucket"], p["measurement"], p["value"]) for p in pts] == [("weights", "A", 0.5)]


def test_kafka_source_needs_package(spark):
    from tickrisk.sources.streams import kafka_source
    with pytest.raises(Exception):
        kafka_source(spark, "localhost:1", "intraday-stock-prices", "price_tick", stream=False).schema


def test_console_sink_and_control_watermark(spark, capsys):
    from tickrisk.sources.sinks import console_sink
    from tickrisk.params import RiskParams
    root = tempfile.mkdtemp(prefix="console-")
    _write(spark, [(1, 1000, "P", {"A": 0.5})],
           "seq long, timestamp long, portfolio_id string, weights map<string,double>", f"{root}/w")
    snaps = file_source(spark, f"{root}/w",
                        "seq long, timestamp long, portfolio_id string, weights map<string,double>",
                        stream=True)
    q = console_sink(snaps).trigger(availableNow=True).start()
    q.awaitTermination(300)
    assert q.exception() is None
    stats = file_source(spark, f"{root}/w", "portfolio_id string, o_ts timestamp, ticker string, "
                        "meanReturns map<string,double>, "
                        "covarianceMatrix map<string,map<string,double>>", stream=True)
    m = tp.metrics_stream(stats, snaps, RiskParams(), control_watermark="1 minute")
    assert "EventTimeWatermark" in m._jdf.queryExecution().logical().toString()


def test_processing_time_stamp(spark):
    from tickrisk.operators.metrics import to_metrics_record
    em = spark.createDataFrame([("P", dt.datetime(2024, 1, 1), 0.1, 0.2, 0.3)],
                               "portfolio_id string, o_ts timestamp, risk double, "
                               "expected_return double, sharpe double")
    ev = to_metrics_record(em).first()["timestamp"]
    now = to_metrics_record(em, stamp="processing").first()["timestamp"]
    assert ev == 1704067200000 and now > ev


def test_record_mode_infinite_return_matches_step_fold(spark):
    """A zero last price gives -Infinity; the per-record rule then yields NaN
    cells, which the record-mode processor reproduces."""
    import sys, os
    sys.path.insert(0, os.path.dirname(__file__))
    from step_oracle import fold
    from tickrisk.params import RiskParams
    from tickrisk.schemas import PORTFOLIO_STATS
    from pyspark.sql import types as T
    root = tempfile.mkdtemp(prefix="inf-")
    t0 = dt.datetime(2024, 1, 1)
    sch = ("seq long, arrival_ts timestamp, ticker string, field_opening_price string, "
           "field_cours_courant string, field_last_traded_time string")
    rows = []
    for k, (sec, tkr, o, c) in enumerate([(0.5, "A", "5", "1"), (1.0, "A", "1", "0"),
                                          (4.5, "A", "10", "1"), (5.0, "A", "1", "12"),
                                          (4.6, "B", "10", "11"), (600, "S", "1", "1")]):
        ts = t0 + dt.timedelta(seconds=sec)
        rows.append((k, ts, tkr, o, c, ts.strftime("%Y-%m-%dT%H:%M:%S.%fZ")))
    _write(spark, rows, sch, f"{root}/ticks")
    seed_t = T.StructType([T.StructField("seq", T.LongType())] + PORTFOLIO_STATS.fields)
    means = {"A": 0.01, "B": 0.02}
    cov = {"A": {"A": 0.04, "B": 0.01}, "B": {"A": 0.01, "B": 0.09}}
    seeds = spark.createDataFrame([(0, 0, "portf1", means, cov)], seed_t)
    params = RiskParams(window="2 seconds", watermark="1 second")
    s = tp.stats_stream(file_source(spark, f"{root}/ticks", sch, stream=True), params, seeds=seeds)
    tp.run_available_now(s, f"{root}/out", f"{root}/ckpt")
    got = sorted(spark.read.parquet(f"{root}/out").collect(), key=lambda r: (r["o_ts"], r["ticker"]))
    ev = [{"kind": "seed", "p": "portf1", "means": means, "cov": cov}]
    # B has a lone tick in its window: return 0.0
    for tkr, end, r in [("A", 2, float("-inf")), ("A", 6, math.log(1.2)), ("B", 6, 0.0)]:
        key = (t0 + dt.timedelta(seconds=end), 1, 0, tkr)
        ev.append({"kind": "ret", "p": "portf1", "ticker": tkr, "r": r, "key": key})
    exp = fold(ev)["stats"]
    assert len(got) == len(exp) == 3

    def same(a, b):
        return (math.isnan(a) and math.isnan(b)) or a == pytest.approx(b, rel=1e-12)
    for g, (_, tkr, _, (m, c)) in zip(got, exp):
        assert g["ticker"] == tkr
        assert all(same(g["meanReturns"][k], v) for k, v in m.items())
        assert all(same(g["covarianceMatrix"][i][j], v) for i, row in c.items() for j, v in row.items())
    assert math.isnan(got[-1]["meanReturns"]["A"]) and math.isnan(got[-1]["covarianceMatrix"]["A"]["B"])


def test_driver_like_session_from_other_directory():
    """A plain session (no library settings) in another working directory:
    the processors ship by value and the state store is switched to RocksDB."""
    import os
    import subprocess
    import sys as _sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]')"
        ".config('spark.sql.shuffle.partitions', '2').config('spark.ui.enabled', 'false')"
        ".getOrCreate()\n"
        "spark.sparkContext.setLogLevel('ERROR')\n"
        "import __spark_entry__ as E\n"
        "print('ROWS', E.queries()['stream_metrics'](spark, %r).count())\n" % (repo, SF))
    cwd = tempfile.mkdtemp(prefix="driver-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([_sys.executable, "-c", code], cwd=cwd, env=env, capture_output=True,
                         text=True, timeout=900)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
    assert int(out.stdout.split("ROWS")[1].split()[0]) > 0


@pytest.mark.parametrize("mode", ["record", "factored"])
def test_whole_streaming_job_equals_batch(spark, mode):
    """Query A -> K1, Query B -> K2 + K4, Query C -> K5 over a replay; the
    published metrics equal the batch job's (record and factored modes)."""
    from tickrisk.streaming.job import StreamingJob
    root = tempfile.mkdtemp(prefix="job-")
    static = spark.read.parquet(f"{SF}/events.parquet")
    from tickrisk.sources.streams import single_file_glob
    stream = file_source(spark, single_file_glob(f"{SF}/events.parquet"), static.schema, stream=True)
    ticks = SQ._tick_stream(spark, static, stream, root)
    job = StreamingJob(spark, ticks, standin.weight_snapshots(stream), out=f"{root}/out",
                       seeds=standin.stats_seeds(static), holdings=standin.holdings(static),
                       params=Q.TEST_PARAMS, mode=mode, seed_time=True)
    job.run_available_now()
    k2 = spark.read.parquet(f"{root}/out/metrics")
    batch = Q.flagship(spark, SF)
    cols = ["portfolioId", "timestamp"]
    rnd = [F.round(c, 8).alias(c) for c in ["risk", "expectedReturn"]]
    assert _rows(k2.select(*cols, *rnd), cols + ["risk", "expectedReturn"]) == \
        _rows(batch.select(*cols, *rnd), cols + ["risk", "expectedReturn"])
    pts = spark.read.parquet(f"{root}/out/metric_points")
    assert pts.count() == 3 * k2.count()
    wp = spark.read.parquet(f"{root}/out/weight_points")
    assert wp.count() == standin.weight_snapshots(static).count() * 10


def test_job_command_line_replay(spark):
    """The command-line entry over wire-schema files (replay mode)."""
    from tickrisk.streaming.job import main
    root = tempfile.mkdtemp(prefix="cli-")
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ticks = standin.price_ticks(ev)
    sent = spark.createDataFrame(
        [(-1, dt.datetime(2024, 3, 1), "__sentinel__", "1", "1", "2024-03-01T00:00:00.000000Z")],
        ticks.schema)
    ticks.unionByName(sent).write.parquet(f"{root}/ticks")
    standin.weight_snapshots(ev).write.parquet(f"{root}/weights")
    standin.stats_seeds(ev).write.parquet(f"{root}/seeds")
    standin.holdings(ev).write.parquet(f"{root}/holdings")
    main(["--ticks", f"{root}/ticks", "--weights", f"{root}/weights", "--seeds", f"{root}/seeds",
          "--holdings", f"{root}/holdings", "--out", f"{root}/out", "--window", "1 day",
          "--available-now", "--seed-time"])
    k2 = spark.read.parquet(f"{root}/out/metrics")
    assert k2.count() == Q.flagship(spark, SF).count() > 0


def test_streaming_job_start_continuous(spark):
    """start(): three running queries; drained in order, the published
    metrics equal the replay's."""
    from tickrisk.streaming.job import StreamingJob
    from tickrisk.sources.streams import single_file_glob
    root = tempfile.mkdtemp(prefix="job-start-")
    static = spark.read.parquet(f"{SF}/events.parquet")
    stream = file_source(spark, single_file_glob(f"{SF}/events.parquet"), static.schema, stream=True)
    job = StreamingJob(spark, SQ._tick_stream(spark, static, stream, root),
                       standin.weight_snapshots(stream), out=f"{root}/out",
                       seeds=standin.stats_seeds(static), holdings=standin.holdings(static),
                       params=Q.TEST_PARAMS, seed_time=True)
    qs = job.start(processing_time="1 second")
    try:
        for name in ("stats", "metrics", "weight_points"):
            qs[name].processAllAvailable()
        qs["stats"].processAllAvailable()
        qs["metrics"].processAllAvailable()
    finally:
        for q in qs.values():
            q.stop()
    assert all(q.exception() is None for q in qs.values())
    k2 = spark.read.parquet(f"{root}/out/metrics")
    assert k2.count() > 0
    assert spark.read.parquet(f"{root}/out/weight_points").count() > 0


def test_record_and_factored_modes_agree(spark):
    """SURVEY 4: record mode (whole record per portfolio) and factored mode
    (state per (portfolio, ticker)) give the same means and variances."""
    rec = spark.read.parquet(f"{SQ._stats_records(spark, SF)}/stats").collect()
    fac = spark.read.parquet(f"{SQ._factored_series(spark, SF)}/series").collect()
    f = {(r["portfolio_id"], r["ticker"], r["o_ts"]): r for r in fac}
    n = 0
    for r in rec:
        t = r["ticker"]
        if t not in r["meanReturns"]:
            continue
        g = f[(r["portfolio_id"], t, r["o_ts"])]
        assert g["mean"] == pytest.approx(r["meanReturns"][t], rel=1e-9, abs=1e-15)
        if g["var"] is not None:
            assert g["var"] == pytest.approx(r["covarianceMatrix"][t][t], rel=1e-9, abs=1e-15)
        n += 1
    assert n > 20


def _factored_metrics(spark, tmp_path, cov, rows):
    """Query B, factored mode, over series rows (ticker, n, mean, var) of one portfolio."""
    from tickrisk.params import RiskParams
    from tickrisk.streaming.processors import TICKER_STATS_OUT
    seeds = spark.createDataFrame([(1, 0, "p", {"A": 0.01, "B": 0.02}, cov)],
                                  "seq long, timestamp long, portfolio_id string, meanReturns map<string,double>, "
                                  "covarianceMatrix map<string,map<string,double>>")
    series = spark.createDataFrame(
        [("p", t, dt.datetime(2024, 1, 1, 0, 0, k), n, 0.0, True, m, True, v) for k, (t, n, m, v) in enumerate(rows)],
        TICKER_STATS_OUT)
    series.write.parquet(str(tmp_path / "series"))
    weights = spark.createDataFrame([(1, 0, "p", {"A": 0.5, "B": 0.25, "Z": 1.0})],
                                    "seq long, timestamp long, portfolio_id string, weights map<string,double>")
    weights.write.parquet(str(tmp_path / "weights"))
    m = tp.metrics_stream_factored(
        spark.readStream.schema(series.schema).parquet(str(tmp_path / "series")),
        spark.readStream.schema(weights.schema).parquet(str(tmp_path / "weights")), seeds, RiskParams())
    tp.run_available_now(m, str(tmp_path / "out"), str(tmp_path / "ck"))
    return spark.read.parquet(str(tmp_path / "out")).orderBy("o_ts").collect()


def test_factored_metrics_of_each_trigger(spark, tmp_path):
    """The pair after each return; a return of a ticker without weight changes nothing."""
    cov = {"A": {"A": 0.04, "B": 0.01, "C": 0.3}, "B": {"A": 0.01, "B": 0.09}, "C": {"A": 0.3, "C": 0.5}}
    rows = [("A", 1, 0.011, 0.041), ("C", 1, 0.5, 0.4), ("B", 1, 0.021, 0.088), ("A", 2, 0.012, 0.042)]
    out = _factored_metrics(spark, tmp_path, cov, rows)
    q, exp = 1000 / 1001, []
    mean, var, n = {"A": 0.01, "B": 0.02}, {"A": 0.04, "B": 0.09}, {"A": 0, "B": 0}
    for t, k, m, v in rows:
        if t == "C":
            continue
        mean[t], var[t], n[t] = m, v, k
        exp.append((0.5 * mean["A"] + 0.25 * mean["B"], 0.25 * var["A"] + 0.0625 * var["B"]
                    + 2 * 0.125 * 0.01 * q ** (n["A"] + n["B"])))
    assert [(pytest.approx(r["expected_return"], rel=1e-12), pytest.approx(r["variance"], rel=1e-12)) for r in out] == exp


def test_factored_mode_refuses_what_it_cannot_derive(spark, tmp_path):
    for name, cov, rows in (("asymmetric", {"A": {"B": 0.01}, "B": {"A": 0.03}}, [("A", 1, 0.01, 0.01)]),
                            ("mean", {"A": {"B": 0.01}, "B": {"A": 0.01}}, [("A", 1, 0.0, 0.01)])):
        (tmp_path / name).mkdir()
        with pytest.raises(Exception, match="use mode='record'"):
            _factored_metrics(spark, tmp_path / name, cov, rows)


def test_default_mode_follows_the_rule_on_asymmetric_seeds(spark):
    """The default mode gives the rule's cells where the factored form cannot."""
    from tickrisk.streaming.job import StreamingJob
    assert StreamingJob.__dataclass_fields__["mode"].default == "record"
    from tickrisk.functions.fold import apply_return
    means, cov = {"A": 0.01, "B": 0.02}, {"A": {"A": 0.04, "B": 0.01}, "B": {"A": 0.03, "B": 0.09}}
    apply_return(means, cov, "A", 0.05, 1001)
    assert cov["A"]["B"] == cov["B"]["A"] == pytest.approx(0.01 * 1000 / 1001, rel=1e-12)


class _State(dict):
    """A MapState over a plain dictionary."""

    def iterator(self):
        return iter(list(self.items()))

    updateValue, removeKey, containsKey = dict.__setitem__, dict.__delitem__, dict.__contains__


class _Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


def test_weight_rows_are_gathered_by_time_timer_and_late(spark):
    """A time comes out once a later one is seen; the newest by the timer; rows of an emitted time
    as a late snapshot. Nothing is lost, and the last weight of a ticker counts."""
    import pandas as pd

    from tickrisk.streaming.processors import WeightRowsProcessor
    p, timers = WeightRowsProcessor(wait_ms=500), []
    p.pending, p.told, p.due = _State(), _Value(), _Value()
    p.handle = type("H", (), {"registerTimer": staticmethod(timers.append), "deleteTimer": staticmethod(timers.remove)})
    clock = type("T", (), {"getCurrentProcessingTimeInMs": staticmethod(lambda: 1000 + len(timers))})

    def feed(*rows):
        frame = pd.DataFrame(rows, columns=["time_ms", "ticker", "weight", "seq"])
        return [tuple(r) for part in p.handleInputRows(("p",), iter([frame]), clock) for r in part.itertuples(index=False)]

    assert feed((10, "A", .1, 1), (10, "B", .2, 2)) == []
    assert feed((10, "A", .3, 4), (10, "A", .9, 3)) == []
    assert feed((20, "A", .5, 5), (30, "C", .6, 6)) == [(4, 10, "p", {"A": .3, "B": .2}, False), (5, 20, "p", {"A": .5}, False)]
    assert len(timers) == 1 and set(p.pending) == {(30, "C")}
    assert feed((10, "D", .7, 7)) == [(7, 10, "p", {"D": .7}, True)]
    fired = [tuple(r) for part in p.handleExpiredTimer(("p",), clock, None) for r in part.itertuples(index=False)]
    assert fired == [(6, 30, "p", {"C": .6}, False)] and not p.pending and not p.due.exists()
    assert feed((30, "E", .8, 8)) == [(8, 30, "p", {"E": .8}, True)] and not p.pending


def test_windows_fold_batches_and_late_ticks_come_out_once():
    """First and last by arrival over pieces and batches in any order; the timer ends the window; a tick of a window
    that the watermark has passed is a row of its own."""
    import pandas as pd

    from tickrisk.streaming.processors import TickWindowProcessor
    p, timers = TickWindowProcessor(), []
    p.held, p.handle = _Value(), type("H", (), {"registerTimer": staticmethod(timers.append)})
    key, mark = ("A", 0, 2_000_500), [0]
    clock = type("T", (), {"getCurrentWatermarkInMs": staticmethod(lambda: mark[0])})

    def feed(*parts):
        frames = [pd.DataFrame(rows, columns=["o_seq", "o_tie", "opening_price", "current_price", "event_us"]) for rows in parts]
        return [r for f in p.handleInputRows(key, iter(frames), clock) for r in f.itertuples(index=False)]

    assert feed([(5, "", 50.0, 51.0, 5), (4, "", 40.0, 41.0, 4)], [], [(6, "", 60.0, 61.0, 6)]) == []
    mark[0] = 2001                                        # passed, but the window is still held
    assert feed([(3, "", 30.0, 31.0, 3)], [(9, "", 90.0, math.nan, 9), (7, "", 70.0, 71.0, 7)]) == []
    assert timers == [2001]
    row, = [r for f in p.handleExpiredTimer(key, clock, None) for r in f.itertuples(index=False)]
    assert tuple(row)[:5] == ("A", 0, 2_000_500, 6, 30.0) and math.isnan(row.last_current)
    assert (row.last_us, row.o_seq, row.late) == (9, 9, False) and not p.held.exists()
    late = feed([(1, "", 10.0, 11.0, 1)], [(2, "", 20.0, 21.0, 2)])
    assert [(r.o_seq, r.n_ticks, r.first_open, r.last_current, r.late) for r in late] == [
        (1, 1, 10.0, 11.0, True), (2, 1, 20.0, 21.0, True)]
    assert timers == [2001] and not p.held.exists()


@pytest.mark.parametrize("mode", ["record", "factored"])
def test_job_that_keeps_late_ticks(spark, mode):
    """Same metrics as the replay without it; ticks delivered after their windows are stored, every tick once."""
    from tickrisk.streaming.job import StreamingJob
    root = tempfile.mkdtemp(prefix="keep-late-")
    static = spark.read.parquet(f"{SF}/events.parquet")
    ticks = standin.price_ticks(static)
    ticks.unionByName(SQ._sentinel(static)).write.parquet(f"{root}/ticks/part=1")
    stream = file_source(spark, f"{root}/ticks/*", ticks.schema, stream=True)
    snaps = standin.weight_snapshots(static)
    snaps.write.parquet(f"{root}/weights")
    job = StreamingJob(spark, stream, file_source(spark, f"{root}/weights", snaps.schema, stream=True), out=f"{root}/out",
                       seeds=standin.stats_seeds(static), holdings=standin.holdings(static), params=Q.TEST_PARAMS,
                       seed_time=True, keep_late=True, mode=mode)
    job.run_available_now()
    assert spark.read.parquet(f"{root}/out/metrics").count() == Q.flagship(spark, SF).count() > 0
    assert job.late_ticks().count() == 0
    ticks.withColumn("seq", F.col("seq") + 1_000_000).write.parquet(f"{root}/ticks/part=2")     # all of them, too late
    job.run_available_now()
    late = job.late_ticks()
    assert late.count() == late.select("o_seq").distinct().count() == ticks.count()
    assert spark.read.parquet(f"{root}/out/metrics").count() == Q.flagship(spark, SF).count()
    with pytest.raises(ValueError):
        StreamingJob(spark, stream, stream, out=f"{root}/out").late_ticks()


def _peak_mb(emitted) -> tuple[int, float]:
    """Rows of the emitted frames, and the largest memory held while they came."""
    import tracemalloc
    tracemalloc.start()
    try:
        n = sum(len(part) for part in emitted)
        return n, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_weight_rows_of_one_batch_are_not_held(monkeypatch):
    """Rows of many times in one micro-batch, in any order: only a run of them is in memory, each comes out once."""
    import numpy as np
    import pandas as pd

    from tickrisk.streaming import processors as pr
    monkeypatch.setattr(pr, "RUN_BYTES", 1 << 16, raising=False)
    monkeypatch.setattr(pr, "ROWS_AT_ONCE", 500)
    p, size, parts = pr.WeightRowsProcessor(wait_ms=None), 2000, 20
    p.pending, p.told, p.due = _State(), _Value(), _Value()
    order = np.random.default_rng(3).permutation(size * parts)

    def rows():
        for k in range(parts):
            at = order[k * size:(k + 1) * size]
            yield pd.DataFrame({"time_ms": at // 2, "ticker": ["AB"[x % 2] for x in at], "weight": at / 8, "seq": at})

    found = []

    def emitted():
        for part in p.handleInputRows(("p",), rows(), None):
            found.extend(hash((t, s, tuple(sorted(w.items())))) for t, s, w in zip(part["timestamp"], part["seq"], part["weights"]))
            yield part

    n, peak = _peak_mb(emitted())
    last = size * parts // 2 - 1
    assert n == last and set(p.pending) == {(last, "A"), (last, "B")}
    assert found == [hash((t, 2 * t + 1, (("A", 2 * t / 8), ("B", (2 * t + 1) / 8)))) for t in range(last)]
    assert peak < 8


@pytest.mark.parametrize("factored", [True, False])
def test_metrics_of_one_batch_are_not_held(monkeypatch, factored):
    """Weight snapshots of one micro-batch, in any order: only a run of them is in memory, and the
    emitted metrics are those of a run that holds all of them."""
    import numpy as np
    import pandas as pd

    from tickrisk.streaming import processors as pr
    size, parts, names = 200, 20, [f"T{k}" for k in range(10)]
    order = np.random.default_rng(4).permutation(size * parts)
    cov = {i: {j: 0.01 if i == j else 0.001 for j in names} for i in names}
    first = {"o_ts": pd.Timestamp(0), "o_side": 0, "o_seq": 0, "o_tie": None, "kind": "seed" if factored else "stats",
             "meanReturns": {t: 0.01 for t in names}, "covarianceMatrix": cov, "weights": None, "ticker": None}
    series = first | {"o_ts": pd.Timestamp(1), "o_side": 1, "o_tie": "T0", "kind": "series", "ticker": "T0", "n": 1,
                      "has_mean": True, "mean": 0.011, "has_var": True, "var": 0.01, "meanReturns": None, "covarianceMatrix": None}

    def rows():
        for k in range(parts):
            at = order[k * size:(k + 1) * size]
            snaps = [first | {"o_ts": pd.Timestamp(1000 * int(x)), "o_side": 2, "o_seq": int(x), "o_tie": "", "kind": "weights",
                              "meanReturns": None, "covarianceMatrix": None, "ticker": None,
                              "weights": {f"T{j}": float(x + j + 1) for j in range(10)}} for x in at // 2 + 1]
            yield pd.DataFrame(snaps + ([first, series][:1 + factored] if k == parts - 1 else []), columns=list(series))

    def run(out):
        p = pr.FactoredMetricsProcessor() if factored else pr.MetricsProcessor()
        for name in ("seed", "flags", "last", "has_stats", "has_weights"):
            setattr(p, name, _Value())
        for name in ("tick", "weights", "s_mean", "s_cov"):
            setattr(p, name, _State())
        for part in p.handleInputRows(("p",), rows(), None):
            out.extend(part.itertuples(index=False, name=None))
            yield part

    monkeypatch.setattr(pr, "ROWS_AT_ONCE", 200)
    exp, got = [], []
    sum(len(part) for part in run(exp))
    monkeypatch.setattr(pr, "RUN_BYTES", 1 << 15, raising=False)
    n, peak = _peak_mb(run(got))
    assert got == exp and n == size * parts // 2
    assert peak < 4


def test_sorted_runs_keep_arrival_order_and_nulls(monkeypatch):
    """Equal keys in several runs come out as they arrived; null keys come last."""
    import pandas as pd

    from tickrisk.streaming import processors as pr
    parts = [pd.DataFrame({"o_seq": [2, 1, 2], "o_tie": ["b", None, "a"], "x": [3 * k, 3 * k + 1, 3 * k + 2]}) for k in range(40)]
    whole = [r.x for r in pr._in_order(iter(parts), ["o_seq", "o_tie"])]
    monkeypatch.setattr(pr, "RUN_BYTES", 200)
    assert [r.x for r in pr._in_order(iter(parts), ["o_seq", "o_tie"])] == whole
    assert whole == [*range(1, 120, 3), *range(2, 120, 3), *range(0, 120, 3)]
