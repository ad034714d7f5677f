"""The whole streaming job: Query A, B and C with their sinks.

* Query A: ticks (+ seeds) -> statistics -> K1 files; in record mode the records
  can also go to a topic;
* Query B: K1 U weight snapshots -> metrics; one ``foreachBatch``
  writes the metrics wire records (K2: files, and a topic if given), their three points
  each (K4) and, optionally, prints them (K6). Each micro-batch is written under its own
  ``batch=<id>`` folder in overwrite mode, so a retried batch replaces its
  own output (idempotent);
* Query C: weight snapshots -> one point per weight (K5).

Sources are streams of any format: files (``sources.streams.file_source``) or topics
(``kafka_source``); the command line offers both.

Each query has its own checkpoint under ``<out>/_checkpoints`` and restarts
alone. ``start`` runs them continuously; ``run_available_now`` runs A, then
B, then C over everything available (replays, tests).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickrisk.operators import metrics as mt
from tickrisk.operators import points as pt
from tickrisk.operators import ticks as tk
from tickrisk.params import RiskParams
from tickrisk.session import configure, ensure_folder
from tickrisk.sources import sinks
from tickrisk.sources.streams import file_source, kafka_source
from tickrisk.streaming import topology as tp
from tickrisk.streaming.processors import STATS_OUT, TICK_WINDOWS_OUT, TICKER_STATS_OUT


@dataclass
class StreamingJob:
    spark: SparkSession
    ticks: DataFrame                       # streaming wire ticks (seq, arrival_ts, ...)
    weights: DataFrame                     # streaming weight snapshots
    out: str                               # base folder of the file sinks
    seeds: DataFrame | None = None         # static statistics records (initial state)
    seed_stream: DataFrame | None = None   # or streaming statistics records
    holdings: DataFrame | None = None
    params: RiskParams = RiskParams()
    portfolio_id: str = "portf1"
    console: bool = False
    points_fmt: str = "parquet"
    stamp: str = "event"                   # "processing": wall-clock record times (P14)
    # "record": per-portfolio statistics records (K1 as the original), the step rules on any
    # input, seeds static or as a stream.
    # "factored": statistics per (portfolio, ticker), so one portfolio's returns
    # spread over its tickers; K1 written as series rows, covariances derived in the
    # metrics processor (needs static ``seeds``). Exact where the closed form is; other
    # input (asymmetric seed, infinite return, a mean that becomes 0) stops the query.
    mode: str = "record"
    seed_time: bool = False                # replays: static seeds count from their own time on
    strict: bool = True                    # malformed ticks raise; False: go to ``bad_ticks``
    keep_late: bool = False                # windows keep ticks later than the watermark, see ``late_ticks``
    kafka: str | None = None               # bootstrap servers for the topics below
    stats_topic: str | None = None         # K1 as Avro (record mode)
    metrics_topic: str | None = None       # K2 as Avro

    def _ck(self, name: str) -> str:
        return f"{self.out}/_checkpoints/{name}"

    def query_windows(self):
        """Windows whose late ticks are kept (``keep_late``); Query A reads them."""
        configure(self.spark)
        return sinks.file_sink(tp.tick_windows_stream(self.ticks, self.params, strict=self.strict),
                               f"{self.out}/tick_windows", self._ck("tick_windows"))

    def query_a(self):
        configure(self.spark)
        returns = None
        if self.keep_late:
            returns = tp.window_returns(file_source(self.spark, f"{self.out}/tick_windows", TICK_WINDOWS_OUT, stream=True))
        if self.mode == "factored":
            if self.seeds is None:
                raise ValueError("factored mode needs static seeds")
            s = tp.ticker_stats_stream(self.ticks, self.params, seeds=self.seeds, strict=self.strict, seed_time=self.seed_time,
                                       holdings=self.holdings, portfolio_id=self.portfolio_id, returns=returns)
            return sinks.file_sink(s, f"{self.out}/series", self._ck("series"))
        s = tp.stats_stream(self.ticks, self.params, holdings=self.holdings, seeds=self.seeds,
                            seed_stream=self.seed_stream, portfolio_id=self.portfolio_id,
                            stamp=self.stamp, strict=self.strict, seed_time=self.seed_time, returns=returns)
        return sinks.file_sink(s, f"{self.out}/stats", self._ck("stats"))

    def query_bad(self):
        """Ticks that do not parse, kept apart (``strict=False``)."""
        bad = tk.quarantine_split(tk.typed_ticks(self.ticks, strict=False))[1]
        return sinks.file_sink(bad, f"{self.out}/bad_ticks", self._ck("bad_ticks"))

    def query_k1(self):
        """K1 to a topic: the statistics records that Query A has written."""
        records = file_source(self.spark, f"{self.out}/stats", STATS_OUT, stream=True)
        return sinks.kafka_sink(records, self.kafka, self.stats_topic, "portfolio_stats", self._ck("stats_topic"))

    def queries(self) -> list:
        """(name, maker) of the job's queries, in the order of their data."""
        made = [("tick_windows", self.query_windows)] if self.keep_late else []
        made += [("stats", self.query_a), ("metrics", self.query_b), ("weight_points", self.query_c)]
        if not self.strict:
            made.append(("bad_ticks", self.query_bad))
        if self.stats_topic:
            if self.mode != "record":
                raise ValueError("statistics records go to a topic in record mode only")
            made.append(("stats_topic", self.query_k1))
        return made

    def late_ticks(self) -> DataFrame:
        """Every tick that came later than the watermark so far, with the window it missed (``keep_late``)."""
        if not self.keep_late:
            raise ValueError("late ticks are stored with keep_late=True only")
        return tp.late_ticks(self.spark.read.schema(TICK_WINDOWS_OUT).parquet(f"{self.out}/tick_windows"))

    @staticmethod
    def dropped_rows(query: StreamingQuery) -> int:
        """Without ``keep_late``: rows that Query A has dropped as later than the watermark, in the batches that Spark
        still tells of (the last 100 by default); several late ticks of one window and task count as one."""
        return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress
                   for op in p["stateOperators"])

    def _metrics_batch(self, batch: DataFrame, epoch_id: int) -> None:
        rec = mt.to_metrics_record(batch, stamp=self.stamp).persist()
        try:
            rec.write.mode("overwrite").parquet(f"{self.out}/metrics/batch={epoch_id}")
            pts = pt.metric_points(rec)
            pt.write_points(pts, f"{self.out}/metric_points/batch={epoch_id}", fmt=self.points_fmt, mode="overwrite")
            if self.metrics_topic:
                (sinks.avro_value(rec, "portfolio_metrics").write.format("kafka")
                 .option("kafka.bootstrap.servers", self.kafka).option("topic", self.metrics_topic).save())
            if self.console:
                rec.show(max(1, rec.count()), truncate=False)      # every row
        finally:
            rec.unpersist()

    def query_b(self):
        configure(self.spark)
        if self.mode == "factored":
            ser = file_source(self.spark, f"{self.out}/series", TICKER_STATS_OUT, stream=True)
            m = tp.metrics_stream_factored(ser, self.weights, self.seeds, self.params)
        else:
            stats_in = file_source(self.spark, f"{self.out}/stats", STATS_OUT, stream=True)
            m = tp.metrics_stream(stats_in, self.weights, self.params)
        return (m.writeStream.foreachBatch(self._metrics_batch)
                .option("checkpointLocation", self._ck("metrics")))

    def query_c(self):
        return (self.weights.writeStream
                .foreachBatch(sinks.points_writer(f"{self.out}/weight_points", kind="weights",
                                                  fmt=self.points_fmt))
                .option("checkpointLocation", self._ck("weight_points")))

    def start(self, processing_time: str | None = None) -> dict[str, StreamingQuery]:
        """Start the three queries (continuously, micro-batches)."""
        out = {}
        for name, make in self.queries():
            if name == "stats" and self.keep_late:
                ensure_folder(self.spark, f"{self.out}/tick_windows")
            if name == "metrics":                                 # B follows A's sink
                ensure_folder(self.spark, f"{self.out}/{'series' if self.mode == 'factored' else 'stats'}")
            w = make()
            if processing_time:
                w = w.trigger(processingTime=processing_time)
            out[name] = w.start()
        return out

    def run_available_now(self, timeout_s: int | None = None) -> None:
        """A, then B, then C (and the optional queries), each over everything available."""
        for _, make in self.queries():
            tp.finish(make().trigger(availableNow=True).start(), timeout_s)


def main(argv: list[str] | None = None) -> None:
    """Start the streaming job over files or topics of the wire schemas.

    ``spark-submit ... -m tickrisk.streaming.job --ticks DIR --weights DIR --seeds DIR
    --out DIR [--holdings FILE] [--format parquet|json] [--available-now]``.
    Tick files carry ``seq`` and ``arrival_ts`` next to the 28 wire fields
    (or at least the four used ones). With ``--bootstrap SERVERS``, ``--ticks`` and
    ``--weights`` (and ``--seeds`` with ``--seed-stream``) name topics of Avro records (``--starting-offsets``, ``--unkeyed`` for
    topics whose records of one ticker spread over partitions), and
    ``--stats-topic``/``--metrics-topic`` publish K1/K2. The master and its resources are
    spark-submit's unless ``--master`` is given.
    """
    import argparse

    from pyspark.sql import types as T

    from tickrisk.schemas import PORTFOLIO_STATS, PRICE_TICK, WEIGHT_SNAPSHOT
    from tickrisk.session import build_session

    ap = argparse.ArgumentParser(prog="tickrisk.streaming.job")
    ap.add_argument("--ticks", required=True)
    ap.add_argument("--weights", required=True)
    ap.add_argument("--seeds", required=True, help="statistics records (static)")
    ap.add_argument("--seed-stream", action="store_true", help="seeds arrive as a stream (a topic with --bootstrap)")
    ap.add_argument("--holdings", default=None, help="(portfolio_id, ticker) table")
    ap.add_argument("--portfolio-id", default="portf1")
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--window", default="2 seconds")
    ap.add_argument("--trigger", default="2 seconds")
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--master", default=None)
    ap.add_argument("--mode", default="record", choices=["record", "factored"])
    ap.add_argument("--seed-time", action="store_true", help="replay: seeds count from their own time on")
    ap.add_argument("--lenient", action="store_true", help="keep malformed ticks apart instead of failing")
    ap.add_argument("--keep-late", action="store_true", help="store ticks later than the watermark instead of dropping them")
    ap.add_argument("--bootstrap", default=None, help="Kafka servers; --ticks and --weights are topics then")
    ap.add_argument("--starting-offsets", default="latest", choices=["latest", "earliest"])
    ap.add_argument("--unkeyed", action="store_true")
    ap.add_argument("--stats-topic", default=None)
    ap.add_argument("--metrics-topic", default=None)
    ap.add_argument("--processing-time-stamps", action="store_true",
                    help="stamp records with the wall clock instead of event time")
    a = ap.parse_args(argv)

    spark = build_session(master=a.master)
    tick_t = T.StructType([T.StructField("seq", T.LongType()),
                           T.StructField("arrival_ts", T.TimestampType())] + PRICE_TICK.fields)
    snap_t = T.StructType([T.StructField("seq", T.LongType())] + WEIGHT_SNAPSHOT.fields)
    seed_t = T.StructType([T.StructField("seq", T.LongType())] + PORTFOLIO_STATS.fields)
    if a.bootstrap:
        order = "timestamp" if a.unkeyed else "offset"
        ticks, weights = (kafka_source(spark, a.bootstrap, topic, record, a.starting_offsets, order=order)
                          for topic, record in ((a.ticks, "price_tick"), (a.weights, "weight_snapshot")))
    else:
        ticks = file_source(spark, a.ticks, tick_t, fmt=a.format, stream=True)
        weights = file_source(spark, a.weights, snap_t, fmt=a.format, stream=True)
    seeds, seed_stream = None, None
    if a.seed_stream:
        seed_stream = (kafka_source(spark, a.bootstrap, a.seeds, "portfolio_stats", a.starting_offsets, order=order)
                       if a.bootstrap else file_source(spark, a.seeds, seed_t, fmt=a.format, stream=True))
    else:
        seeds = file_source(spark, a.seeds, seed_t, fmt=a.format)
    holdings = (spark.read.format(a.format).load(a.holdings) if a.holdings else None)
    job = StreamingJob(spark, ticks, weights, out=a.out, seeds=seeds, seed_stream=seed_stream, holdings=holdings,
                       params=RiskParams(window=a.window), portfolio_id=a.portfolio_id,
                       stamp="processing" if a.processing_time_stamps else "event",
                       mode=a.mode, strict=not a.lenient, keep_late=a.keep_late, seed_time=a.seed_time, kafka=a.bootstrap,
                       stats_topic=a.stats_topic, metrics_topic=a.metrics_topic)
    if a.available_now:
        job.run_available_now()
    else:
        for q in job.start(processing_time=a.trigger).values():
            q.awaitTermination()


if __name__ == "__main__":
    main()
