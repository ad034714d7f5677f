"""Price ticks -> windowed log returns per ticker (flow 1, first half).

Rules (per (ticker, window), by arrival order ``seq``):

1. base price = opening price of the first tick;
2. last price = current price of the last tick, only ticks after the first
   count: a lone tick gives last = base, so a return of exactly 0.0 is emitted;
3. the return's time is the last tick's last-traded time;
4. base price 0 gives no row;
5. ``ln(last/base)`` with IEEE results; NaN gives no row (0 and -Infinity
   are kept).

First/last by arrival are ``min_by``/``max_by`` aggregates over fixed-width
values (prices, parsed last-traded time), so the window is a partial + final
*hash* aggregate (map-side combine), not a buffered group. The last tick's
time text is informational in the original (never read downstream);
``keep_text=True`` carries it too, at the cost of a sort-based aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickrisk.functions.ieee import ieee_ln
from tickrisk.functions.parse import iso_offset_to_ts, parse_price
from tickrisk.schemas import TICK_CURRENT, TICK_OPEN, TICK_TICKER, TICK_TIME


def typed_ticks(raw: DataFrame, strict: bool = True, order_col: str = "seq",
                time_col: str = "arrival_ts", event_time: bool = False) -> DataFrame:
    """Wire tick rows -> ``(seq, ts, ticker, opening_price, current_price,
    last_traded_time, event_ts)``.

    ``ts`` is the windowing time: arrival time by default (replayable
    processing time), or the parsed last-traded time with ``event_time``.
    Only the four used wire fields are read (column pruning reaches the scan).
    With ``strict`` both prices of every tick must parse, also those that no
    window uses: parsing before the aggregate keeps its buffers fixed-width, so
    it stays hash-based. ``strict=False`` with ``quarantine_split`` is the way
    to run over malformed ticks.
    """
    ev_ts = iso_offset_to_ts(F.col(TICK_TIME), strict=strict)
    return raw.select(
        F.col(order_col).alias("seq"),
        (ev_ts if event_time else F.col(time_col).cast("timestamp")).alias("ts"),
        F.col(TICK_TICKER).alias("ticker"),
        parse_price(TICK_OPEN, strict).alias("opening_price"),
        parse_price(TICK_CURRENT, strict).alias("current_price"),
        F.col(TICK_TIME).alias("last_traded_time"),
        ev_ts.alias("event_ts"),
    )


def quarantine_split(ticks: DataFrame):
    """(good, bad) split of ``typed_ticks(strict=False)`` output: a bad row has a price
    or a windowing time that did not parse."""
    bad = F.col("opening_price").isNull() | F.col("current_price").isNull() | F.col("ts").isNull()
    return ticks.filter(~bad), ticks.filter(bad)


def window_first_last(ticks: DataFrame, window: str, keep_text: bool = False) -> DataFrame:
    """A1: first/last tick of every (ticker, tumbling window) by arrival."""
    aggs = [F.count(F.lit(1)).alias("n_ticks"),
            F.min_by("opening_price", "seq").alias("first_open"),
            F.max_by("current_price", "seq").alias("last_current"),
            F.max_by("event_ts", "seq").alias("last_traded_ts")]
    if keep_text:
        aggs.append(F.max_by("last_traded_time", "seq").alias("last_traded_time"))
    return ticks.groupBy("ticker", F.window("ts", window).alias("w")).agg(*aggs)


def log_returns(ticks: DataFrame, window: str = "2 seconds", watermark: str | None = None,
                keep_text: bool = False) -> DataFrame:
    """Windowed log return per ticker.

    Output: ``ticker, window_start, window_end, n_ticks, base_price,
    last_price, return_value, last_traded_ts`` (+ ``last_traded_time`` text
    with ``keep_text``). With ``watermark`` set the aggregate runs in append
    mode on streams.
    """
    if watermark:
        ticks = ticks.withWatermark("ts", watermark)
    g = window_first_last(ticks, window, keep_text)
    return returns_of_windows(g.select("*", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end")),
                              keep_text)


def returns_of_windows(g: DataFrame, keep_text: bool = False) -> DataFrame:
    """Log returns (rules 2, 4 and 5) of windows given by ``ticker, window_start, window_end, n_ticks,
    first_open, last_current, last_traded_ts``."""
    base = F.col("first_open")
    last = F.when(F.col("n_ticks") > 1, F.col("last_current")).otherwise(base)
    ratio = F.when(base != 0, last / base)
    cols = [
        "ticker",
        "window_start",
        "window_end",
        "n_ticks",
        base.alias("base_price"),
        last.alias("last_price"),
        ieee_ln(ratio).alias("return_value"),
        "last_traded_ts",
    ] + (["last_traded_time"] if keep_text else [])
    out = g.select(*cols)
    return out.filter((F.col("base_price") != 0) & ~F.isnan("return_value"))


def assign_portfolios(returns: DataFrame, holdings: DataFrame | None = None,
                      portfolio_id: str = "portf1", salt_above_bytes: int = 64 << 20,
                      salt_buckets: int = 64) -> DataFrame:
    """Fan a per-ticker return out to the portfolios holding it.

    Without ``holdings`` every return goes to the one constant portfolio.
    Spark broadcasts the holdings if their bytes allow it. Holdings estimated
    above ``salt_above_bytes`` are joined with a salt: a ticker held by a third of
    all portfolios is spread over ``salt_buckets`` tasks (holdings salted by
    portfolio, returns replicated per salt). A stream of returns needs static
    holdings: two streams joined without a time bound would keep all rows.
    """
    if holdings is None:
        return returns.withColumn("portfolio_id", F.lit(portfolio_id))
    from tickrisk.operators.joins import plan_bytes, salted_join
    h = holdings.select("portfolio_id", "ticker").distinct()
    if h.isStreaming:
        raise ValueError("holdings must be a static table")
    if plan_bytes(holdings.select("portfolio_id", "ticker")) <= salt_above_bytes:
        return returns.join(h, on=["ticker"])
    return salted_join(returns, h, on=["ticker"], salt_of="portfolio_id", buckets=salt_buckets)
