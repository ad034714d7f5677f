"""Stand-in inputs derived from the driver's ``events`` table.

These functions only shape rows into the wire schemas the job reads (price
ticks, weight snapshots, weight rows, statistics seeds, holdings); they do
none of the job's work. The mapping follows ``FIXTURES.md`` section 2:

* tick: ``seq = event_id``, arrival time ``ts``, ticker ``'T' || user_id % 10``,
  opening price ``value``, current price ``value + (event_id % 7) / 100``,
  last traded time = ISO text of ``ts``; prices travel as text.
* weight snapshot: one per ``signup`` event, portfolio ``'P' || user_id % 3``,
  weight of ticker ``Tk`` = ``((event_id + k) % 10 + 1) / 55``.
* statistics seed: one record per portfolio found in the weights, at
  2024-01-05 00:00:00 UTC; mean of ``Tk`` = ``(k + 1) / 1000`` except ``T8``
  (0.0) and ``T9`` (absent); covariance ``(1 + min(i, j)) / 10000`` plus
  ``1 / 1000`` on the diagonal, pair ``(T0, T7)`` absent.
* holdings: the (portfolio, ticker) pairs named by the weight snapshots.
* weight rows: the snapshots as text rows, the time alternating between
  ``yyyy-MM-dd HH:mm:ss`` and ``yyyy-MM-ddTHH:mm:ssZ``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the stand-in data (FIXTURES.md section 2).
N_TICKERS = 10
N_PORTFOLIOS = 3
SEED_TIME = "2024-01-05 00:00:00"
ZERO_MEAN_TICKER = 8
ABSENT_MEAN_TICKER = 9
ABSENT_COV_PAIR = (0, 7)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _ticker(i) -> str:
    return f"T{i}"


def price_ticks(ev: DataFrame, opening: str | None = None, current: str | None = None) -> DataFrame:
    """Tick rows: arrival order ``seq``, arrival time ``arrival_ts`` and the
    four wire fields the job reads, all as text (``opening``, ``current``: text columns
    to use instead of the mapping's prices)."""
    cur = F.col("value") + (F.col("event_id") % 7).cast("double") / F.lit(100.0)
    return ev.select(
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("arrival_ts"),
        F.concat(F.lit("T"), (F.col("user_id") % N_TICKERS).cast("string")).alias("ticker"),
        (F.col(opening) if opening else F.col("value").cast("string")).alias("field_opening_price"),
        (F.col(current) if current else cur.cast("string")).alias("field_cours_courant"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("field_last_traded_time"),
    )


def signed_price_ticks(ev: DataFrame) -> DataFrame:
    """``price_ticks`` with signs and zeros: the opening price is 0 on every 11th event and
    negative on every 5th, the current price 0 on every 7th and negative on every 3rd."""
    n = F.col("event_id")
    opening = F.when(n % 11 == 0, 0.0).when(n % 5 == 0, -F.col("value")).otherwise(F.col("value"))
    current = F.when(n % 7 == 0, 0.0).when(n % 3 == 0, -F.col("value")).otherwise(F.col("value"))
    return price_ticks(ev.withColumn("_o", opening.cast("string")).withColumn("_c", current.cast("string")),
                       opening="_o", current="_c")


def dirty_price_ticks(ev: DataFrame) -> DataFrame:
    """``price_ticks`` whose opening price is no number on every 13th event and whose
    current price has a decimal comma on every 17th."""
    n, value = F.col("event_id"), F.col("value").cast("string")
    return price_ticks(ev.withColumn("_o", F.when(n % 13 == 0, "n/a").otherwise(value))
                       .withColumn("_c", F.when(n % 17 == 0, F.translate(value, ".", ",")).otherwise(value)),
                       opening="_o", current="_c")


def weight_snapshots(ev: DataFrame) -> DataFrame:
    """Weight snapshot records ``(seq, timestamp ms, portfolio_id, weights)``."""
    entries = []
    for k in range(N_TICKERS):
        w = ((F.col("event_id") + k) % 10 + 1).cast("double") / F.lit(55.0)
        entries += [F.lit(_ticker(k)), w]
    return (ev.filter(F.col("event_type") == "signup")
            .select(F.col("event_id").alias("seq"),
                    F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
                    F.concat(F.lit("P"), (F.col("user_id") % N_PORTFOLIOS).cast("string")).alias("portfolio_id"),
                    F.create_map(*entries).alias("weights")))


def _seed_mean(k: int):
    if k == ABSENT_MEAN_TICKER:
        return None
    if k == ZERO_MEAN_TICKER:
        return 0.0
    return (k + 1) / 1000.0


def _seed_cov(i: int, j: int):
    if {i, j} == set(ABSENT_COV_PAIR):
        return None
    return (1 + min(i, j)) / 10000.0 + (1 / 1000.0 if i == j else 0.0)


def seed_means_map():
    entries = []
    for k in range(N_TICKERS):
        m = _seed_mean(k)
        if m is not None:
            entries += [F.lit(_ticker(k)), F.lit(m)]
    return F.create_map(*entries)


def seed_cov_map():
    rows = []
    for i in range(N_TICKERS):
        inner = []
        for j in range(N_TICKERS):
            c = _seed_cov(i, j)
            if c is not None:
                inner += [F.lit(_ticker(j)), F.lit(c)]
        rows += [F.lit(_ticker(i)), F.create_map(*inner)]
    return F.create_map(*rows)


def stats_seeds(ev: DataFrame) -> DataFrame:
    """One statistics record per portfolio named by the weight snapshots."""
    ports = weight_snapshots(ev).select("portfolio_id").distinct()
    ts_ms = F.unix_millis(F.lit(SEED_TIME).cast("timestamp"))
    return ports.select(
        F.lit(0).cast("bigint").alias("seq"),
        ts_ms.alias("timestamp"),
        "portfolio_id",
        seed_means_map().alias("meanReturns"),
        seed_cov_map().alias("covarianceMatrix"))


def holdings(ev: DataFrame) -> DataFrame:
    return (weight_snapshots(ev)
            .select("portfolio_id", F.explode(F.map_keys("weights")).alias("ticker"))
            .distinct())


def weight_rows(ev: DataFrame) -> DataFrame:
    """Long-form weight rows as text (``seq`` = arrival order)."""
    snap = weight_snapshots(ev)
    ts = F.timestamp_millis("timestamp")
    time_text = F.when(F.col("seq") % 2 == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")) \
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return snap.select("seq", time_text.alias("time"), "portfolio_id",
                       F.explode("weights").alias("ticker", "w")) \
        .select("seq", "time", "portfolio_id", "ticker", F.col("w").cast("string").alias("weight"))
