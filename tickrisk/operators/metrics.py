"""Portfolio metrics (flow 2): expected return, risk and Sharpe ratio of the
latest weights against the latest statistics, emitted on change.

* ``E = sum_i w_i * mean_i`` (missing mean = 0);
* ``var = sum_i sum_j w_i * w_j * cov_ij`` (missing = 0), ``risk = sqrt(var)``
  (NaN for a negative variance);
* ``sharpe = sqrt(periods) * (E - risk_free) / risk`` with IEEE division.

Connect (J2): either input triggers; both sides are last-write-wins; nothing
until both exist. Statistics reach this flow only as *updated* records, one
per applied return (a seed alone emits nothing). Emit on change (W1): a
candidate is suppressed iff ``(E, risk)`` equals the previous candidate's,
which equals the last emitted pair.

Batch form. Triggers of a portfolio are ordered by ``(o_ts, o_side, o_seq,
o_tie)``: returns (side 1, tie = ticker) before weight snapshots (side 2) at
equal time. The as-of state of every trigger comes from two-level scans
(``operators.scan``), never from one window over a whole portfolio. The
state of a ticker at a trigger is looked up by its tick count ``n`` in the
statistics series; covariances are ``cov0 * q**e`` (``operators.stats``).

Equal states give bit-identical metrics (``operators.quadratic``), which exact change
detection relies on.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickrisk.functions.ieee import ieee_div
from tickrisk.operators import stats as st
from tickrisk.operators.joins import join_small
from tickrisk.operators.quadratic import trigger_metrics
from tickrisk.operators.scan import block_of, previous_row, running, running_sum
from tickrisk.params import RiskParams

ORDER = ["o_ts", "o_side", "o_seq", "o_tie"]
TKEY = ["portfolio_id"] + ORDER


def weights_long(snapshots: DataFrame) -> DataFrame:
    """Weight snapshots -> ``(portfolio_id, seq, timestamp, ticker, w)``. A snapshot
    without a weight (an empty or all-null map) keeps one row with an empty ticker (joins
    drop null keys) and a null weight, since it triggers and is current like any other."""
    w = F.map_filter("weights", lambda k, v: v.isNotNull())
    long = snapshots.select("portfolio_id", "seq", "timestamp", F.explode_outer(w).alias("ticker", "w"))
    return long.withColumn("ticker", F.coalesce("ticker", F.lit("")))


_ENTRY = "struct<j:string,tag:int,c:double,w:double,n:bigint,g:boolean>"


def _merge_rows(grid: DataFrame, seed: DataFrame, tkey: list[str]) -> DataFrame:
    """Adds ``_m`` to every grid row ``i``: its seed covariance cells
    ``(j, cov0)`` and the states ``(j, w, n, g)`` of its trigger's tickers
    (window over the trigger key), in one array sorted by ticker with a cell
    before the peer of the same ticker."""
    rows = st.seed_cov_rows(seed).select(
        "portfolio_id", "ticker",
        F.transform(F.map_entries("row"), lambda e: F.struct(
            e["key"].alias("j"), F.lit(0).alias("tag"), e["value"].alias("c"),
            F.lit(None).cast("double").alias("w"), F.lit(None).cast("bigint").alias("n"),
            F.lit(None).cast("boolean").alias("g"))).alias("cells"))
    d = join_small(grid, rows, on=["portfolio_id", "ticker"], how="left")
    w = F.col("w").cast("double") if "w" in grid.columns else F.lit(None).cast("double")
    peers = F.collect_list(F.struct(
        F.col("ticker").alias("j"), F.lit(1).alias("tag"), F.lit(None).cast("double").alias("c"),
        w.alias("w"), F.col("n").alias("n"), F.col("g").alias("g"))
    ).over(Window.partitionBy(*tkey))
    return d.withColumn("_m", F.array_sort(F.concat(
        F.coalesce("cells", F.array().cast(f"array<{_ENTRY}>")), peers))).drop("cells")


def _row_matches(f):
    """``f(cell, peer)`` for every ticker ``j != i`` present both as a seed
    cell of row ``i`` and as a peer: adjacent entries of the sorted ``_m``."""
    m, me = F.col("_m"), F.col("ticker")

    def step(k):
        a, b = F.element_at(m, k), F.element_at(m, k + 1)
        hit = (a["j"] == b["j"]) & (a["tag"] == 0) & (b["tag"] == 1) & (a["j"] != me)
        return F.when(hit, f(a, b))

    ks = F.when(F.size(m) >= 2, F.sequence(F.lit(1), F.size(m) - 1)).otherwise(
        F.array().cast("array<int>"))
    return F.filter(F.transform(ks, step), lambda x: x.isNotNull())


def _decayed(params: RiskParams, cell, peer):
    """``cov0 * q**e`` of the cell (row ``i`` = the current grid row)."""
    return cell["c"] * F.pow(F.lit(params.decay), st.decay_exponent(
        F.col("n"), peer["n"], F.col("g"), peer["g"]).cast("double"))


def metrics_from_grid(grid: DataFrame, seed: DataFrame, tkey: list[str],
                    params: RiskParams) -> DataFrame:
    """Metrics per trigger from its grid rows.

    ``grid``: ``*tkey, ticker, w, mean, var, n, g`` (one row per weighted
    ticker of the trigger; ``tkey`` includes ``portfolio_id``), ideally
    hash-partitioned by the trigger key (``partition_by_trigger``).

    Each trigger is one product of the portfolio's dense seed matrix with its weights
    (``operators.quadratic``): O(N^2) multiplications in numpy, O(N) rows and memory; no (i, j) pair rows.
    """
    return finish_metrics(trigger_metrics(grid, seed, tkey, params.decay), params)


def partition_by_trigger(grid: DataFrame, tkey: list[str] | None = None) -> DataFrame:
    """Hash-partition a grid by its trigger key once and keep it (memory and
    disk; recomputable from lineage) so that its readers reuse that
    partitioning. Unpersist after use."""
    return grid.repartition(*(tkey or TKEY)).persist(StorageLevel.MEMORY_AND_DISK)


def finish_metrics(df: DataFrame, params: RiskParams) -> DataFrame:
    """P10: risk and Sharpe ratio from ``expected_return`` and ``variance``."""
    risk = F.sqrt("variance")
    excess = F.lit(params.sharpe_scale) * (F.col("expected_return") - F.lit(params.risk_free))
    return df.withColumn("risk", risk).withColumn("sharpe", ieee_div(excess, F.col("risk")))


def metrics_vs_state(weights: DataFrame, state: DataFrame, seed: DataFrame,
                     params: RiskParams) -> DataFrame:
    """A2/A3/P10 of every weight snapshot against one statistics state.

    ``weights``: long form; ``state``: ``portfolio_id, ticker, n, mean, var``
    (e.g. ``stats.final_state``). Output per ``(portfolio_id, seq)``.
    """
    return metrics_from_grid(state_grid(weights, state, seed), seed, ["portfolio_id", "seq"], params)


def state_grid(weights: DataFrame, state: DataFrame, seed: DataFrame) -> DataFrame:
    """Grid of every weight snapshot's tickers against one statistics state."""
    g = st.live_flags(seed)
    return (weights.join(state.select(*st.PT, "n", "mean", "var"), st.PT, "left")
            .join(g, st.PT, "left")
            .withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint")))


def triggers(applied: DataFrame, snapshots: DataFrame, params: RiskParams) -> DataFrame:
    """Union of the two connect inputs with the as-of state of each trigger:
    ``wid`` (current weight snapshot, by its whole order key) and ``n_stats`` (updated statistics
    records so far)."""
    w_seq, w_tie = st.order_columns(snapshots)
    wid = F.struct(F.col("timestamp").alias("ms"), w_seq.alias("seq"), w_tie.alias("tie"))
    st_tr = applied.select(
        "portfolio_id", F.col("order_ts").alias("o_ts"), F.lit(1).alias("o_side"),
        F.lit(0).cast("bigint").alias("o_seq"), F.col("ticker").alias("o_tie"),
        F.lit(None).cast("struct<ms:bigint,seq:bigint,tie:string>").alias("wid0"), F.lit(1).alias("is_stats"))
    w_tr = snapshots.select(
        "portfolio_id", F.timestamp_millis("timestamp").alias("o_ts"), F.lit(2).alias("o_side"),
        w_seq.alias("o_seq"), w_tie.alias("o_tie"), wid.alias("wid0"), F.lit(0).alias("is_stats"))
    tr = st_tr.unionByName(w_tr).withColumn("_blk", block_of("o_ts", params.block_seconds))
    tr = running(tr, ["portfolio_id"], ORDER, "_blk",
                 sums={"n_stats": "is_stats"}, lasts={"wid": "wid0"})
    return tr.drop("_blk", "wid0")


def metrics_asof(applied: DataFrame, series: DataFrame, seed: DataFrame,
                 snapshots: DataFrame, params: RiskParams) -> DataFrame:
    """Metrics candidate of every trigger once both sides exist.

    Output: ``portfolio_id, o_ts, o_side, o_seq, o_tie, expected_return,
    variance, risk, sharpe``.
    """
    grid = trigger_grid(applied, series, seed, snapshots, params)
    return risk_from_grid(grid, seed, params)


def risk_from_grid(grid: DataFrame, seed: DataFrame, params: RiskParams) -> DataFrame:
    """Metrics per trigger from ``trigger_grid`` rows."""
    return metrics_from_grid(grid, seed, TKEY, params)


def trigger_grid(applied: DataFrame, series: DataFrame, seed: DataFrame,
                 snapshots: DataFrame, params: RiskParams) -> DataFrame:
    """One row per (candidate trigger, weighted ticker) with the ticker's
    as-of state: ``*TKEY, ticker, w, n, mean, var, g``."""
    cand = triggers(applied, snapshots, params).filter(
        F.col("wid").isNotNull() & (F.col("n_stats") > 0)).select(
        *TKEY, F.col("wid.ms").alias("wms"), F.col("wid.seq").alias("wseq"), F.col("wid.tie").alias("wtie"))
    w_seq, w_tie = st.order_columns(snapshots)
    wl = weights_long(snapshots).select("portfolio_id", F.col("timestamp").alias("wms"), w_seq.alias("wseq"),
                                        w_tie.alias("wtie"), "ticker", "w")
    grid = cand.join(wl, ["portfolio_id", "wms", "wseq", "wtie"]).drop("wms", "wseq", "wtie")
    return ticker_state_at(grid, applied, series, seed, params, extra=["w"])


def ticker_state_at(grid: DataFrame, applied: DataFrame, series: DataFrame, seed: DataFrame,
                    params: RiskParams, extra: list[str] | None = None) -> DataFrame:
    """As-of statistics of ``(trigger, ticker)`` rows: ``*TKEY, ticker,
    *extra, n, mean, var, g, mean0, var0``.

    ``n`` = applied returns of the (portfolio, ticker) ordered up to the
    trigger (a return sorts before a grid row with the same order key),
    counted by a two-level running sum; mean and variance are looked up in
    the statistics series by ``n`` (seed values when ``n = 0``).
    """
    extra = list(extra or [])
    rets = applied.select("portfolio_id", "ticker", F.col("order_ts").alias("o_ts"),
                          F.lit(1).alias("o_side"), F.lit(0).cast("bigint").alias("o_seq"),
                          F.col("ticker").alias("o_tie"), F.lit(0).alias("o_kind"),
                          F.lit(1).alias("is_ret"),
                          *[F.lit(None).cast(grid.schema[c].dataType).alias(c) for c in extra])
    u = (grid.select(*TKEY, "ticker", *extra).withColumn("o_kind", F.lit(1))
         .withColumn("is_ret", F.lit(0))
         .unionByName(rets)
         .withColumn("_blk", block_of("o_ts", params.block_seconds)))
    u = running_sum(u, st.PT, ORDER + ["o_kind"], "_blk", "is_ret", "n")
    grid = u.filter(F.col("is_ret") == 0).drop("o_kind", "is_ret", "_blk")
    ser = series.select(*st.PT, "n", F.col("mean").alias("_m"), F.col("var").alias("_v"))
    return (grid.join(ser, st.PT + ["n"], "left")
            .join(st.seed_means(seed), st.PT, "left")
            .join(st.seed_diag(seed), st.PT, "left")
            .select(*TKEY, "ticker", *extra, "n",
                    F.coalesce("_m", "mean0").alias("mean"),
                    F.coalesce("_v", "var0").alias("var"),
                    (F.col("mean0").isNotNull() & (F.col("mean0") != 0)).alias("g"),
                    "mean0", "var0"))


def record_grid(applied: DataFrame, series: DataFrame, seed: DataFrame,
                params: RiskParams) -> DataFrame:
    """K1 batch twin, step 1: every ticker of the seed at every applied return."""
    tr = applied.select("portfolio_id", F.col("order_ts").alias("o_ts"), F.lit(1).alias("o_side"),
                        F.lit(0).cast("bigint").alias("o_seq"), F.col("ticker").alias("o_tie"))
    sc = st.seed_cov(seed)
    tickers = (st.seed_means(seed).select(*st.PT)
               .unionByName(sc.select("portfolio_id", F.col("i").alias("ticker")))
               .unionByName(sc.select("portfolio_id", F.col("j").alias("ticker")))
               .distinct())
    grid = join_small(tr, tickers, on=["portfolio_id"])
    return ticker_state_at(grid, applied, series, seed, params)


def statistics_records(grid: DataFrame, seed: DataFrame, params: RiskParams) -> DataFrame:
    """K1 batch twin, step 2: the whole statistics record after each applied
    return (``processors.STATS_OUT`` columns): mean map of the seeded
    tickers and covariance map (diagonal from the series, off-diagonal
    ``cov0 * q**e``, the same value at ``[i][j]`` and ``[j][i]``, P13).

    ``grid`` from ``record_grid`` (every seed ticker at every applied
    return), ideally partitioned by the trigger key. Row ``i`` of a record
    is built inside grid row ``i`` by merging its seed row with the trigger's
    ticker states (sorted array, adjacent matches), so no pair rows are
    produced; the N^2 cells exist only as the record's own maps.
    """
    d = _merge_rows(grid, seed, TKEY)
    me = F.col("ticker")
    off = _row_matches(lambda a, b: F.struct(a["j"].alias("j"),
                                             _decayed(params, a, b).alias("c")))
    entries = F.when(F.col("var0").isNotNull(), F.concat(off, F.array(F.struct(
        me.alias("j"), F.col("var").alias("c"))))).otherwise(off)
    d = d.withColumn("_row", F.when(F.size(entries) > 0, F.map_from_entries(entries)))
    out = d.groupBy(*TKEY).agg(
        F.map_from_entries(F.collect_list(F.when(F.col("mean0").isNotNull(),
                                                 F.struct("ticker", "mean")))).alias("meanReturns"),
        F.map_from_entries(F.collect_list(F.when(F.col("_row").isNotNull(),
                                                 F.struct("ticker", "_row")))).alias("covarianceMatrix"),
        F.max(F.when(F.col("ticker") == F.col("o_tie"), F.col("n"))).alias("n"))
    return out.select("portfolio_id", "o_ts", F.col("o_tie").alias("ticker"), "n",
                      F.unix_millis(F.col("o_ts").cast("timestamp")).alias("timestamp"),
                      "meanReturns", "covarianceMatrix")


def emit_on_change(cand: DataFrame, params: RiskParams) -> DataFrame:
    """Keep a candidate iff ``(E, risk)`` differs from the previous one of
    its portfolio (NaN equals NaN; -0.0 equals 0.0 in Spark)."""
    c = cand.withColumn("_blk", block_of("o_ts", params.block_seconds))
    c = previous_row(c, ["portfolio_id"], ORDER, "_blk", ["expected_return", "risk"], "_prev")
    same = (F.col("expected_return").eqNullSafe(F.col("_prev.expected_return"))
            & F.col("risk").eqNullSafe(F.col("_prev.risk")))
    return c.filter(F.col("_prev").isNull() | ~same).drop("_prev", "_blk")


def to_metrics_record(emitted: DataFrame, stamp: str = "event") -> DataFrame:
    """Wire record ``portfolioId, risk, expectedReturn, sharpRatio, timestamp``.

    ``stamp="event"`` stamps the trigger time (replayable); ``"processing"``
    stamps the wall clock like the original (P14).
    """
    ts = (F.unix_millis(F.current_timestamp()) if stamp == "processing"
          else F.unix_millis(F.col("o_ts").cast("timestamp")))
    return emitted.select(F.col("portfolio_id").alias("portfolioId"), "risk",
                          F.col("expected_return").alias("expectedReturn"),
                          F.col("sharpe").alias("sharpRatio"), ts.alias("timestamp"))
