"""Weight records: long-form text rows -> typed rows -> snapshots.

A weight row is ``(time, portfolio_id, ticker, weight)``, all text. Its time
is parsed with the lenient rule P3 (space -> ``T``, ``Z`` appended when the
text lacks ``T`` or ``Z``); a snapshot is the weight map of one
``(portfolio_id, time)``. Duplicate tickers of a snapshot are resolved to the
last row by arrival before the map is built (maps reject duplicate keys).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickrisk.functions.parse import lenient_weight_time_to_millis, parse_price


def typed_weight_rows(rows: DataFrame, strict: bool = True, order_col: str = "seq") -> DataFrame:
    """``seq, portfolio_id, ticker, time, time_ms, ts, weight``.

    Text the lenient time rule cannot parse (an explicit ``+01:00`` offset
    gets an extra ``Z``) and a malformed weight raise with ``strict`` (fail
    fast, as the original); otherwise they become NULL; ``quarantine_rows``
    splits such rows off, so that they are kept apart and not lost.
    """
    ms = lenient_weight_time_to_millis("time", strict=strict)
    return rows.select(
        F.col(order_col).alias("seq"), "portfolio_id", "ticker", "time",
        ms.alias("time_ms"), F.timestamp_millis(ms).alias("ts"),
        parse_price("weight", strict).alias("weight"))


def quarantine_rows(typed: DataFrame):
    """(good, bad) split of ``typed_weight_rows(strict=False)`` output."""
    bad = F.col("time_ms").isNull() | F.col("weight").isNull()
    return typed.filter(~bad), typed.filter(bad)


def rows_to_snapshots(typed: DataFrame) -> DataFrame:
    """One weight snapshot per ``(portfolio_id, time_ms)``.

    Output: ``seq`` (last arrival), ``timestamp`` (ms), ``portfolio_id``,
    ``weights`` map. The map of one snapshot holds one entry per ticker of
    the portfolio, so the collected group is bounded by the portfolio size.
    """
    # one partitioning by (portfolio, time) serves both aggregates
    last = (typed.filter(F.col("time_ms").isNotNull()).repartition("portfolio_id", "time_ms")
            .groupBy("portfolio_id", "time_ms", "ticker")
            .agg(F.max_by("weight", "seq").alias("weight"), F.max("seq").alias("seq")))
    return (last.groupBy("portfolio_id", "time_ms")
            .agg(F.max("seq").alias("seq"),
                 F.map_from_entries(F.collect_list(F.struct("ticker", "weight"))).alias("weights"))
            .select("seq", F.col("time_ms").alias("timestamp"), "portfolio_id", "weights"))


def explode_weights(snapshots: DataFrame) -> DataFrame:
    """P11 + P8: ``(seq, timestamp, portfolio_id, ticker, weight)``, null weights skipped."""
    return (snapshots.select("seq", "timestamp", "portfolio_id",
                             F.explode("weights").alias("ticker", "weight"))
            .filter(F.col("weight").isNotNull()))
