"""Portfolio statistics: seeding (J1) and the exponentially weighted
recurrences (A4-A6), batch form.

Update rule for a return ``r`` of ticker ``s`` (``N = count + 1``):

* no seed for the portfolio yet: the return is dropped (not buffered);
  the first seed record of a portfolio wins, later ones are ignored;
* mean ``m' = m + (r - m)/N``, stored only when the old mean is non-zero, so
  unknown tickers are never added and a zero mean is sticky;
* for every ticker ``o`` of the mean map with non-zero mean and non-zero
  ``cov[s][o]``: ``c' = c + ((r - m)(r_o - m_o) - c)/N`` with ``r_o = r`` on
  the diagonal (old and new mean of ``s``) and ``r_o = m_o`` otherwise, so
  off-diagonal cells only decay: ``c' = c * (N-1)/N``; written to both
  ``[s][o]`` and ``[o][s]``.

Factored state: mean and variance depend only on the returns of one
``(portfolio, ticker)``, computed by the two-level exponential scan; an
off-diagonal cell is ``cov0 * q**(n_i*[m_j != 0] + n_j*[m_i != 0])`` with the
tick counts ``n``. The state is O(tickers) per portfolio, never the N x N
record per return. Holds for a symmetric seed with variances of 0 or more, finite
returns and no mean that becomes exactly 0 mid-stream; portfolios without these
(``uncovered_portfolios``) are folded record by record in ``operators.exact``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickrisk.operators.joins import join_small
from tickrisk.operators.scan import block_of, ew_scan
from tickrisk.params import RiskParams

PT = ["portfolio_id", "ticker"]


def order_columns(df: DataFrame, col: str = "seq"):
    """``(o_seq long, o_tie string)`` of an arrival order column: a number, or the struct
    (timestamp, partition, offset) of an unkeyed topic, compared in that order."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.StructType):
        c = F.col(col)
        place = F.concat(F.lpad(c["partition"].cast("string"), 10, "0"), F.lit("/"),
                         F.lpad(c["offset"].cast("string"), 19, "0"))
        return F.unix_micros(c["timestamp"]), place
    return F.col(col).cast("bigint"), F.lit("")


def first_seed(stats: DataFrame, order=("seq",)) -> DataFrame:
    """b7: the first statistics record of each portfolio by arrival (first write wins)."""
    rec = F.struct(*stats.columns)
    return (stats.groupBy("portfolio_id")
            .agg(F.min_by(rec, F.struct(*order)).alias("r"))
            .select("r.*"))


def seed_means(seed: DataFrame) -> DataFrame:
    """Long form ``(portfolio_id, ticker, mean0)`` of the seeds' mean maps."""
    return seed.select("portfolio_id", F.explode("meanReturns").alias("ticker", "mean0"))


def seed_cov(seed: DataFrame) -> DataFrame:
    """Long form ``(portfolio_id, i, j, cov0)`` of the seeds' covariance maps."""
    return (seed.select("portfolio_id", F.explode("covarianceMatrix").alias("i", "row"))
            .select("portfolio_id", "i", F.explode("row").alias("j", "cov0")))


def seed_cov_rows(seed: DataFrame) -> DataFrame:
    """Covariance rows ``(portfolio_id, ticker, row map<j, cov0>)`` of the seeds."""
    return seed.select("portfolio_id", F.explode("covarianceMatrix").alias("ticker", "row"))


def seed_diag(seed: DataFrame) -> DataFrame:
    return (seed_cov(seed).filter(F.col("i") == F.col("j"))
            .select("portfolio_id", F.col("i").alias("ticker"), F.col("cov0").alias("var0")))


def apply_to_seed(port_returns: DataFrame, seed: DataFrame, seed_time: bool = True) -> DataFrame:
    """Returns of each portfolio that arrive at or after its seed.

    ``port_returns`` carries ``portfolio_id, ticker, order_ts, return_value``; a return of
    a portfolio without seed is dropped. A table has no arrival order between seeds and
    returns: with ``seed_time`` the seed arrives at its own time (a return ordered before
    it is dropped; at equal time the seed sorts first), without it before all returns.
    """
    s = seed.select("portfolio_id", F.timestamp_millis("timestamp").alias("seed_ts"))
    j = join_small(port_returns, s, on=["portfolio_id"])
    return j.filter(F.col("order_ts") >= F.col("seed_ts")) if seed_time else j


def ew_series(applied: DataFrame, seed: DataFrame, params: RiskParams) -> DataFrame:
    """A4/A5: mean and variance of a ticker after each applied return.

    Rows for tickers in the seed's mean map: ``portfolio_id, ticker,
    order_ts, n, return_value, mean0, mean_prev, mean, var0, var``.
    ``n`` counts the applied returns of the (portfolio, ticker). The batch
    job materialises ``ew_mean_series`` before ``ew_var_series`` so that the
    second scan reads a table, not the first scan's lineage.
    """
    return ew_var_series(ew_mean_series(applied, seed, params), seed, params)


def ew_mean_series(applied: DataFrame, seed: DataFrame, params: RiskParams) -> DataFrame:
    """A4: ``portfolio_id, ticker, order_ts, n, return_value, mean0, mean_prev,
    mean`` (the mean is stored only for a non-zero seed mean: sticky zero)."""
    q, a = params.decay, params.gain
    d = applied.select(*PT, "order_ts", "return_value").join(seed_means(seed), on=PT)
    d = d.withColumn("_blk", block_of("order_ts", params.series_block_seconds))
    d = ew_scan(d, PT, ["order_ts"], "_blk", "return_value", "mean0", q, a,
                out="_m", prev_out="_mp", idx_out="n")
    live = F.col("mean0") != 0
    return d.select(*PT, "order_ts", "n", "return_value", "mean0",
                    F.when(live, F.col("_mp")).otherwise(F.col("mean0")).alias("mean_prev"),
                    F.when(live, F.col("_m")).otherwise(F.col("mean0")).alias("mean"))


def ew_var_series(means: DataFrame, seed: DataFrame, params: RiskParams) -> DataFrame:
    """A5: adds ``var0, var``; the diagonal is updated only for a non-zero
    mean and a non-zero cell: ``c' = c + ((r - m)(r - m') - c)/N``."""
    q, a = params.decay, params.gain
    d = means.join(seed_diag(seed), on=PT, how="left")
    d = d.withColumn("_blk", block_of("order_ts", params.series_block_seconds))
    x = (F.col("return_value") - F.col("mean_prev")) * (F.col("return_value") - F.col("mean"))
    d = ew_scan(d, PT, ["order_ts"], "_blk", x, "var0", q, a, out="_v")
    upd = (F.col("mean0") != 0) & F.col("var0").isNotNull() & (F.col("var0") != 0)
    return d.select(*PT, "order_ts", "n", "return_value", "mean0", "mean_prev", "mean", "var0",
                    F.when(upd, F.col("_v")).otherwise(F.col("var0")).alias("var"))


def asymmetric_cells(seed: DataFrame) -> DataFrame:
    """Seed cells whose mirror cell differs or is missing (the factored form
    needs a symmetric seed)."""
    c = seed_cov(seed).filter(F.col("i") != F.col("j"))
    m = c.select("portfolio_id", F.col("i").alias("j"), F.col("j").alias("i"),
                 F.col("cov0").alias("mirror"))
    return (c.join(m, ["portfolio_id", "i", "j"], "full")
            .filter(~F.col("cov0").eqNullSafe(F.col("mirror"))))


def nonfinite_returns(applied: DataFrame) -> DataFrame:
    """Applied returns that are +-Infinity (NaN returns never get this far)."""
    r = F.col("return_value")
    return applied.filter(F.isnan(r) | (F.abs(r) == float("inf")))


def uncovered_portfolios(applied: DataFrame, seed: DataFrame, means: DataFrame) -> DataFrame:
    """``portfolio_id`` of portfolios that the closed form does not cover: an asymmetric
    seed or a negative seed variance, an infinite return, or a mean that comes within
    rounding of 0 (it may be exactly 0 under the step rule, and then stays 0)."""
    vanishes = (F.col("mean0") != 0) & (F.abs("mean") <= 1e-9 * F.abs("mean_prev"))
    return (asymmetric_cells(seed).select("portfolio_id")
            .unionByName(seed_diag(seed).filter("var0 < 0").select("portfolio_id"))
            .unionByName(nonfinite_returns(applied).select("portfolio_id"))
            .unionByName(means.filter(vanishes).select("portfolio_id")).distinct())


def tick_counts(applied: DataFrame) -> DataFrame:
    return applied.groupBy(*PT).agg(F.count(F.lit(1)).alias("n"))


def live_flags(seed: DataFrame) -> DataFrame:
    """``g = [mean0 != 0]`` per (portfolio, ticker) of the mean maps."""
    return seed_means(seed).select(*PT, (F.col("mean0") != 0).alias("g"))


def decay_exponent(n_i, n_j, g_i, g_j):
    """A6 exponent ``n_i*[m_j != 0] + n_j*[m_i != 0]`` (NULL flags = absent)."""
    gi = F.coalesce(g_i, F.lit(False)).cast("long")
    gj = F.coalesce(g_j, F.lit(False)).cast("long")
    return F.coalesce(n_i, F.lit(0)) * gj + F.coalesce(n_j, F.lit(0)) * gi


def final_offdiag(applied: DataFrame, seed: DataFrame, params: RiskParams) -> DataFrame:
    """Off-diagonal covariance after all applied returns.

    ``portfolio_id, i, j, n_i, n_j, cov``; pairs absent from the seed stay
    absent, zero pairs stay zero.
    """
    cnt = tick_counts(applied)
    g = live_flags(seed)
    c = seed_cov(seed).filter(F.col("i") != F.col("j"))
    ci = cnt.select("portfolio_id", F.col("ticker").alias("i"), F.col("n").alias("n_i"))
    cj = cnt.select("portfolio_id", F.col("ticker").alias("j"), F.col("n").alias("n_j"))
    gi = g.select("portfolio_id", F.col("ticker").alias("i"), F.col("g").alias("g_i"))
    gj = g.select("portfolio_id", F.col("ticker").alias("j"), F.col("g").alias("g_j"))
    c = (c.join(ci, ["portfolio_id", "i"], "left").join(cj, ["portfolio_id", "j"], "left")
         .join(gi, ["portfolio_id", "i"], "left").join(gj, ["portfolio_id", "j"], "left"))
    e = decay_exponent(F.col("n_i"), F.col("n_j"), F.col("g_i"), F.col("g_j"))
    return c.select("portfolio_id", "i", "j",
                    F.coalesce("n_i", F.lit(0)).cast("bigint").alias("n_i"),
                    F.coalesce("n_j", F.lit(0)).cast("bigint").alias("n_j"),
                    (F.col("cov0") * F.pow(F.lit(params.decay), e.cast("double"))).alias("cov"))


def final_state(applied: DataFrame, seed: DataFrame, series: DataFrame) -> DataFrame:
    """Per (portfolio, ticker) of the seed: ``n, mean, var`` after all returns."""
    cnt = tick_counts(applied)
    last = series.select(*PT, "n", "mean", "var")
    base = (seed_means(seed).join(seed_diag(seed), PT, "full"))
    s = base.join(cnt, PT, "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint"))
    s = s.join(last.withColumnRenamed("mean", "_m").withColumnRenamed("var", "_v"), PT + ["n"], "left")
    return s.select(*PT, "n", F.coalesce("_m", "mean0").alias("mean"),
                    F.coalesce("_v", "var0").alias("var"), "mean0", "var0")
