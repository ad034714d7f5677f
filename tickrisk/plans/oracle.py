"""DuckDB SQL equivalents of the registered queries.

Each statement derives the same stand-in tables from ``events`` and computes
the documented rules directly (arg_min/arg_max for first/last, running
``sum() over`` closed forms for the recurrences), independently of the Spark
operators. Doubles are rounded to 8 decimals on both sides.
"""

from __future__ import annotations

# Stand-in shaping, shared by the statements below (FIXTURES.md section 2).
TICKS = """
ticks AS (
  SELECT event_id AS seq, ts,
         'T' || CAST(user_id % 10 AS VARCHAR) AS ticker,
         value AS opening_price,
         value + CAST(event_id % 7 AS DOUBLE) / 100 AS current_price,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS last_traded_time
  FROM events)"""

SIGNED_TICKS = """ticks AS (
  SELECT event_id AS seq, ts, 'T' || CAST(user_id % 10 AS VARCHAR) AS ticker,
         CASE WHEN event_id % 11 = 0 THEN 0 WHEN event_id % 5 = 0 THEN -value ELSE value END AS opening_price,
         CASE WHEN event_id % 7 = 0 THEN 0 WHEN event_id % 3 = 0 THEN -value ELSE value END AS current_price,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS last_traded_time
  FROM events)"""

DIRTY_TICKS = """everything AS (
  SELECT event_id AS seq, ts, 'T' || CAST(user_id % 10 AS VARCHAR) AS ticker,
         TRY_CAST(CASE WHEN event_id % 13 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS opening_price,
         TRY_CAST(CASE WHEN event_id % 17 = 0 THEN replace(CAST(value AS VARCHAR), '.', ',')
                       ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS current_price,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS last_traded_time
  FROM events),
ticks AS (SELECT * FROM everything WHERE opening_price IS NOT NULL AND current_price IS NOT NULL)"""

RETURNS = TICKS + """,
win AS (
  SELECT ticker, date_trunc('day', ts) AS window_start, count(*) AS n_ticks,
         arg_min(opening_price, seq) AS base_price,
         arg_max(current_price, seq) AS last_current,
         CAST(arg_max(last_traded_time, seq) AS TIMESTAMP) AS last_traded_ts
  FROM ticks GROUP BY ticker, date_trunc('day', ts)),
rets AS (
  SELECT ticker, window_start, window_start + INTERVAL 1 DAY AS window_end, n_ticks,
         base_price,
         CASE WHEN n_ticks > 1 THEN last_current ELSE base_price END AS last_price,
         last_traded_ts
  FROM win),
returns AS (
  SELECT *, CASE WHEN last_price / base_price = 0 THEN CAST('-Infinity' AS DOUBLE)
                 WHEN last_price / base_price < 0 THEN CAST('NaN' AS DOUBLE)
                 ELSE ln(last_price / base_price) END AS return_value
  FROM rets WHERE base_price <> 0)"""

LOG_RETURN = "WITH " + RETURNS + """
SELECT ticker, window_start, window_end, n_ticks, base_price, last_price,
       round(return_value, 8) AS return_value, last_traded_ts
FROM returns WHERE NOT isnan(return_value)
"""

Q = "(CAST(1000 AS DOUBLE) / 1001)"
A = "(CAST(1 AS DOUBLE) / 1001)"
SEED_TS = "TIMESTAMP '2024-01-05 00:00:00'"

STATS = RETURNS + f""",
ports AS (
  SELECT DISTINCT 'P' || CAST(user_id % 3 AS VARCHAR) AS portfolio_id
  FROM events WHERE event_type = 'signup'),
holdings AS (
  SELECT DISTINCT 'P' || CAST(user_id % 3 AS VARCHAR) AS portfolio_id,
         'T' || CAST(k AS VARCHAR) AS ticker
  FROM events CROSS JOIN range(10) r(k) WHERE event_type = 'signup'),
seedmeans AS (
  SELECT portfolio_id, 'T' || CAST(k AS VARCHAR) AS ticker,
         CASE WHEN k = 8 THEN CAST(0 AS DOUBLE) ELSE CAST(k + 1 AS DOUBLE) / 1000 END AS mean0
  FROM ports CROSS JOIN range(9) r(k)),
seedcov AS (
  SELECT portfolio_id, 'T' || CAST(i AS VARCHAR) AS i, 'T' || CAST(j AS VARCHAR) AS j,
         CAST(1 + least(i, j) AS DOUBLE) / 10000
           + CASE WHEN i = j THEN CAST(1 AS DOUBLE) / 1000 ELSE 0 END AS cov0
  FROM ports CROSS JOIN range(10) a(i) CROSS JOIN range(10) b(j)
  WHERE NOT ((i = 0 AND j = 7) OR (i = 7 AND j = 0))),
applied AS (
  SELECT h.portfolio_id, r.ticker, r.window_end AS order_ts, r.return_value,
         {SEED_TS} AS seed_ts
  FROM returns r JOIN holdings h ON h.ticker = r.ticker
  WHERE NOT isnan(r.return_value) AND r.window_end >= {SEED_TS}),
s1 AS (
  SELECT a.portfolio_id, a.ticker, a.order_ts, a.return_value, m.mean0,
         row_number() OVER (PARTITION BY a.portfolio_id, a.ticker ORDER BY a.order_ts) AS n
  FROM applied a JOIN seedmeans m ON m.portfolio_id = a.portfolio_id AND m.ticker = a.ticker),
s2 AS (
  SELECT *, sum(return_value * pow({Q}, -n)) OVER (PARTITION BY portfolio_id, ticker
            ORDER BY order_ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS zm
  FROM s1),
s3 AS (
  SELECT *, CASE WHEN mean0 <> 0 THEN pow({Q}, n) * (mean0 + {A} * zm) ELSE mean0 END AS mean
  FROM s2),
s4 AS (
  SELECT *, coalesce(lag(mean) OVER (PARTITION BY portfolio_id, ticker ORDER BY order_ts),
                     mean0) AS mean_prev
  FROM s3),
s5 AS (
  SELECT s4.*, d.cov0 AS var0,
         (return_value - mean_prev) * (return_value - mean) AS x
  FROM s4 LEFT JOIN seedcov d
    ON d.portfolio_id = s4.portfolio_id AND d.i = s4.ticker AND d.j = s4.ticker),
s6 AS (
  SELECT *, sum(x * pow({Q}, -n)) OVER (PARTITION BY portfolio_id, ticker
            ORDER BY order_ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS zv
  FROM s5),
series AS (
  SELECT portfolio_id, ticker, order_ts, n, return_value, mean0, mean, var0,
         CASE WHEN mean0 <> 0 AND var0 IS NOT NULL AND var0 <> 0
              THEN pow({Q}, n) * (var0 + {A} * zv) ELSE var0 END AS var
  FROM s6),
cnt AS (
  SELECT portfolio_id, ticker, count(*) AS n FROM applied GROUP BY portfolio_id, ticker),
flags AS (
  SELECT portfolio_id, ticker, CASE WHEN mean0 <> 0 THEN 1 ELSE 0 END AS g FROM seedmeans),
snap AS (
  SELECT event_id AS seq, epoch_us(ts) // 1000 AS ts_ms,
         'P' || CAST(user_id % 3 AS VARCHAR) AS portfolio_id
  FROM events WHERE event_type = 'signup'),
wl AS (
  SELECT s.portfolio_id, s.seq, s.ts_ms, 'T' || CAST(k AS VARCHAR) AS ticker,
         CAST((s.seq + k) % 10 + 1 AS DOUBLE) / 55 AS w
  FROM snap s CROSS JOIN range(10) r(k))"""


def _risk(grid: str, tkey: list[str], p: str) -> str:
    """CTEs computing expected return, variance, risk and Sharpe per trigger
    key from a grid ``(*tkey, ticker, w, n, mean, var, g)``; names prefixed
    with ``p``."""
    k = ", ".join(tkey)
    gik = ", ".join(f"gi.{c}" for c in tkey)
    on = " AND ".join(f"gj.{c} = gi.{c}" for c in tkey)
    return f""",
{p}er AS (
  SELECT {k}, list_sum(list_sort(list(w * coalesce(mean, 0.0)))) AS expected_return
  FROM {grid} GROUP BY {k}),
{p}off AS (
  SELECT {gik}, gi.ticker AS i, gi.w AS w_i,
         gj.w * c.cov0 * pow({Q}, gi.n * gj.g + gj.n * gi.g) AS t
  FROM {grid} gi
  JOIN seedcov c ON c.portfolio_id = gi.portfolio_id AND c.i = gi.ticker AND c.i <> c.j
  JOIN {grid} gj ON {on} AND gj.ticker = c.j),
{p}diag AS (
  SELECT {k}, ticker AS i, w AS w_i, w * var AS t FROM {grid} WHERE var IS NOT NULL),
{p}rows AS (
  SELECT {k}, i, any_value(w_i) AS w_i, list_sum(list_sort(list(t))) AS rs
  FROM (SELECT * FROM {p}off UNION ALL SELECT * FROM {p}diag) GROUP BY {k}, i),
{p}var AS (
  SELECT {k}, list_sum(list_sort(list(w_i * rs))) AS variance FROM {p}rows GROUP BY {k}),
{p}m1 AS (
  SELECT e.*, coalesce(v.variance, 0.0) AS variance
  FROM {p}er e LEFT JOIN {p}var v USING ({k})),
{p}m2 AS (
  SELECT *, CASE WHEN variance < 0 THEN CAST('NaN' AS DOUBLE) ELSE sqrt(variance) END AS risk
  FROM {p}m1),
{p}met AS (
  SELECT *, CASE
      WHEN isnan(sqrt(CAST(52 AS DOUBLE)) * (expected_return - CAST('0.0018' AS DOUBLE)))
           OR isnan(risk) THEN CAST('NaN' AS DOUBLE)
      WHEN risk <> 0 THEN sqrt(CAST(52 AS DOUBLE)) * (expected_return - CAST('0.0018' AS DOUBLE)) / risk
      WHEN expected_return - CAST('0.0018' AS DOUBLE) > 0 THEN CAST('Infinity' AS DOUBLE)
      WHEN expected_return - CAST('0.0018' AS DOUBLE) < 0 THEN CAST('-Infinity' AS DOUBLE)
      ELSE CAST('NaN' AS DOUBLE) END AS sharpe
  FROM {p}m2)"""


FINAL = STATS + """,
fin AS (
  SELECT k.portfolio_id, k.ticker, coalesce(c.n, 0) AS n,
         coalesce(s.mean, m.mean0) AS mean, coalesce(s.var, d.cov0) AS var
  FROM (SELECT portfolio_id, ticker FROM seedmeans
        UNION SELECT portfolio_id, i FROM seedcov WHERE i = j) k
  LEFT JOIN cnt c ON c.portfolio_id = k.portfolio_id AND c.ticker = k.ticker
  LEFT JOIN series s ON s.portfolio_id = k.portfolio_id AND s.ticker = k.ticker
                    AND s.n = coalesce(c.n, 0)
  LEFT JOIN seedmeans m ON m.portfolio_id = k.portfolio_id AND m.ticker = k.ticker
  LEFT JOIN seedcov d ON d.portfolio_id = k.portfolio_id AND d.i = k.ticker AND d.j = k.ticker),
fgrid AS (
  SELECT w.portfolio_id, w.seq, w.ticker, w.w, coalesce(f.n, 0) AS n, f.mean, f.var,
         CASE WHEN m.mean0 IS NOT NULL AND m.mean0 <> 0 THEN 1 ELSE 0 END AS g
  FROM wl w
  LEFT JOIN fin f ON f.portfolio_id = w.portfolio_id AND f.ticker = w.ticker
  LEFT JOIN seedmeans m ON m.portfolio_id = w.portfolio_id AND m.ticker = w.ticker)""" \
    + _risk("fgrid", ["portfolio_id", "seq"], "f")

TKEY = ["portfolio_id", "o_ts", "o_side", "o_seq", "o_tie"]

RECORDS = STATS + f""",
trg AS (SELECT portfolio_id, order_ts AS o_ts, ticker AS o_tie FROM applied),
rtk AS (
  SELECT DISTINCT portfolio_id, ticker FROM (
    SELECT portfolio_id, ticker FROM seedmeans
    UNION ALL SELECT portfolio_id, i FROM seedcov
    UNION ALL SELECT portfolio_id, j FROM seedcov)),
rg AS (
  SELECT t.portfolio_id, t.o_ts, t.o_tie, k.ticker,
         (SELECT count(*) FROM applied a
          WHERE a.portfolio_id = t.portfolio_id AND a.ticker = k.ticker
            AND (a.order_ts < t.o_ts OR (a.order_ts = t.o_ts AND a.ticker <= t.o_tie))) AS n
  FROM trg t JOIN rtk k ON k.portfolio_id = t.portfolio_id),
rs AS (
  SELECT r.*, m.mean0, d.cov0 AS var0,
         coalesce(s.mean, m.mean0) AS mean, coalesce(s.var, d.cov0) AS var,
         CASE WHEN m.mean0 IS NOT NULL AND m.mean0 <> 0 THEN 1 ELSE 0 END AS g
  FROM rg r
  LEFT JOIN series s ON s.portfolio_id = r.portfolio_id AND s.ticker = r.ticker AND s.n = r.n
  LEFT JOIN seedmeans m ON m.portfolio_id = r.portfolio_id AND m.ticker = r.ticker
  LEFT JOIN seedcov d ON d.portfolio_id = r.portfolio_id AND d.i = r.ticker AND d.j = r.ticker)"""

ASOF = STATS + """,
tr AS (
  SELECT portfolio_id, order_ts AS o_ts, 1 AS o_side, CAST(0 AS BIGINT) AS o_seq,
         ticker AS o_tie, CAST(NULL AS BIGINT) AS wseq, 1 AS is_stats FROM applied
  UNION ALL
  SELECT portfolio_id, make_timestamp(ts_ms * 1000) AS o_ts, 2 AS o_side, seq AS o_seq,
         '' AS o_tie, seq AS wseq, 0 AS is_stats FROM snap),
tr2 AS (
  SELECT *, last_value(wseq IGNORE NULLS) OVER w AS wid, sum(is_stats) OVER w AS n_stats
  FROM tr
  WINDOW w AS (PARTITION BY portfolio_id ORDER BY o_ts, o_side, o_seq, o_tie
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
cand AS (
  SELECT portfolio_id, o_ts, o_side, o_seq, o_tie, wid FROM tr2
  WHERE wid IS NOT NULL AND n_stats > 0),
tg1 AS (
  SELECT c.portfolio_id, c.o_ts, c.o_side, c.o_seq, c.o_tie, w.ticker, w.w,
         (SELECT count(*) FROM applied a
          WHERE a.portfolio_id = c.portfolio_id AND a.ticker = w.ticker
            AND (a.order_ts < c.o_ts
                 OR (a.order_ts = c.o_ts AND (c.o_side > 1 OR a.ticker <= c.o_tie)))) AS n
  FROM cand c JOIN wl w ON w.portfolio_id = c.portfolio_id AND w.seq = c.wid),
tgrid AS (
  SELECT t.*, coalesce(s.mean, m.mean0) AS mean, coalesce(s.var, d.cov0) AS var,
         CASE WHEN m.mean0 IS NOT NULL AND m.mean0 <> 0 THEN 1 ELSE 0 END AS g
  FROM tg1 t
  LEFT JOIN series s ON s.portfolio_id = t.portfolio_id AND s.ticker = t.ticker AND s.n = t.n
  LEFT JOIN seedmeans m ON m.portfolio_id = t.portfolio_id AND m.ticker = t.ticker
  LEFT JOIN seedcov d ON d.portfolio_id = t.portfolio_id AND d.i = t.ticker AND d.j = t.ticker)""" \
    + _risk("tgrid", TKEY, "t") + """,
emit AS (
  SELECT *, lag(expected_return) OVER w AS pe, lag(risk) OVER w AS pr,
         row_number() OVER w AS rn
  FROM tmet
  WINDOW w AS (PARTITION BY portfolio_id ORDER BY o_ts, o_side, o_seq, o_tie))"""

WEIGHTS = """
snap AS (
  SELECT event_id AS seq, epoch_us(ts) // 1000 AS ts_ms,
         'P' || CAST(user_id % 3 AS VARCHAR) AS portfolio_id
  FROM events WHERE event_type = 'signup'),
wl AS (
  SELECT s.portfolio_id, s.seq, s.ts_ms, 'T' || CAST(k AS VARCHAR) AS ticker,
         CAST((s.seq + k) % 10 + 1 AS DOUBLE) / 55 AS w
  FROM snap s CROSS JOIN range(10) r(k)),
wrows AS (
  SELECT seq, portfolio_id, ticker, w,
         CASE WHEN seq % 2 = 0
              THEN strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M:%S')
              ELSE strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%dT%H:%M:%SZ') END AS time
  FROM wl),
wparsed AS (
  SELECT *, epoch_ms(CAST(CASE WHEN NOT (contains(time, 'T') AND contains(time, 'Z'))
                               THEN replace(time, ' ', 'T') || 'Z' ELSE time END
                          AS TIMESTAMP)) AS time_ms
  FROM wrows)"""

METRICS_COLS = """portfolio_id, o_ts, o_side, o_seq, o_tie,
       round(expected_return, 8) AS expected_return, round(risk, 8) AS risk,
       round(sharpe, 8) AS sharpe"""

# the last hour's ticks come after all others: late if their window's end is a minute below the greatest other time
LATE_TICKS = "WITH " + RETURNS.replace(TICKS, TICKS.replace("ticks AS (", "every_tick AS (") + """,
marked AS (
  SELECT *, hour(ts) >= 23 AND date_trunc('day', ts) + INTERVAL 1 DAY
            <= (SELECT max(ts) - INTERVAL 1 MINUTE FROM every_tick WHERE hour(ts) < 23) AS late
  FROM every_tick),
ticks AS (SELECT * FROM marked WHERE NOT late)""") + """
SELECT ticker, window_start, window_end, n_ticks, base_price, last_price, round(return_value, 8) AS return_value,
       last_traded_ts, false AS late, CAST(-1 AS BIGINT) AS seq
FROM returns WHERE NOT isnan(return_value)
UNION ALL
SELECT ticker, date_trunc('day', ts), date_trunc('day', ts) + INTERVAL 1 DAY, 1, opening_price, current_price,
       NULL, CAST(last_traded_time AS TIMESTAMP), true, seq
FROM marked WHERE late
"""

ORACLE: dict[str, str] = {
    "stream_late_ticks": LATE_TICKS,
    "log_return": LOG_RETURN,
    "log_return_event_time": LOG_RETURN.replace(
        "date_trunc('day', ts)", "date_trunc('day', CAST(last_traded_time AS TIMESTAMP))"),
    "stats_seed_join": "WITH " + STATS + """
SELECT portfolio_id, ticker, order_ts, round(return_value, 8) AS return_value, seed_ts
FROM applied""",
    "ew_mean": "WITH " + STATS + """
SELECT portfolio_id, ticker, order_ts, n, round(mean, 8) AS mean FROM series""",
    "ew_variance": "WITH " + STATS + """
SELECT portfolio_id, ticker, order_ts, n, round(var, 8) AS var FROM series
WHERE var0 IS NOT NULL""",
    "cov_decay": "WITH " + STATS + f"""
SELECT c.portfolio_id, c.i, c.j, coalesce(ci.n, 0) AS n_i, coalesce(cj.n, 0) AS n_j,
       round(c.cov0 * pow({Q}, coalesce(ci.n, 0) * coalesce(gj.g, 0)
                              + coalesce(cj.n, 0) * coalesce(gi.g, 0)), 8) AS cov
FROM seedcov c
LEFT JOIN cnt ci ON ci.portfolio_id = c.portfolio_id AND ci.ticker = c.i
LEFT JOIN cnt cj ON cj.portfolio_id = c.portfolio_id AND cj.ticker = c.j
LEFT JOIN flags gi ON gi.portfolio_id = c.portfolio_id AND gi.ticker = c.i
LEFT JOIN flags gj ON gj.portfolio_id = c.portfolio_id AND gj.ticker = c.j
WHERE c.i <> c.j""",
    "stats_records": "WITH " + RECORDS + f"""
SELECT portfolio_id, o_ts AS order_ts, o_tie AS ticker, 'mean' AS kind, ticker AS i, '' AS j,
       round(mean, 8) AS value
FROM rs WHERE mean0 IS NOT NULL
UNION ALL
SELECT portfolio_id, o_ts, o_tie, 'cov', ticker, ticker, round(var, 8) FROM rs
WHERE var0 IS NOT NULL
UNION ALL
SELECT a.portfolio_id, a.o_ts, a.o_tie, 'cov', a.ticker, b.ticker,
       round(c.cov0 * pow({Q}, a.n * b.g + b.n * a.g), 8)
FROM rs a
JOIN seedcov c ON c.portfolio_id = a.portfolio_id AND c.i = a.ticker AND c.i <> c.j
JOIN rs b ON b.portfolio_id = a.portfolio_id AND b.o_ts = a.o_ts AND b.o_tie = a.o_tie
         AND b.ticker = c.j""",
    "expected_return": "WITH " + FINAL + """
SELECT portfolio_id, seq, round(expected_return, 8) AS expected_return FROM fmet""",
    "portfolio_risk": "WITH " + FINAL + """
SELECT portfolio_id, seq, round(variance, 8) AS variance, round(risk, 8) AS risk FROM fmet""",
    "sharpe": "WITH " + FINAL + """
SELECT portfolio_id, seq, round(expected_return, 8) AS expected_return,
       round(risk, 8) AS risk, round(sharpe, 8) AS sharpe FROM fmet""",
    "metrics_asof": "WITH " + ASOF + f"""
SELECT {METRICS_COLS} FROM tmet""",
    "metrics_emit_on_change": "WITH " + ASOF + f"""
SELECT {METRICS_COLS} FROM emit
WHERE rn = 1 OR expected_return IS DISTINCT FROM pe OR risk IS DISTINCT FROM pr""",
    "weights_explode": "WITH " + WEIGHTS + """
SELECT 'weights' AS bucket, ticker AS measurement, 'Portfolio ID' AS tag_key, portfolio_id,
       'weight' AS field, round(w, 8) AS value, ts_ms AS time_ms
FROM wl""",
    "weight_time_parse": "WITH " + WEIGHTS + """
SELECT seq, portfolio_id, ticker, time, time_ms FROM wparsed""",
    "weights_rows_to_map": "WITH " + WEIGHTS + """,
dedup AS (
  SELECT portfolio_id, time_ms, ticker, arg_max(w, seq) AS weight
  FROM wparsed GROUP BY portfolio_id, time_ms, ticker)
SELECT portfolio_id, time_ms, ticker, round(weight, 8) AS weight,
       count(*) OVER (PARTITION BY portfolio_id, time_ms) AS n_tickers
FROM dedup""",
    "metric_points": "WITH " + ASOF + """,
emitted AS (
  SELECT * FROM emit
  WHERE rn = 1 OR expected_return IS DISTINCT FROM pe OR risk IS DISTINCT FROM pr)
SELECT 'my-bucket' AS bucket, 'Sharpe_Ratio' AS measurement, 'Portfolio ID' AS tag_key,
       portfolio_id, 'Sharpe Ratio' AS field, round(sharpe, 8) AS value,
       epoch_ms(o_ts) AS time_ms FROM emitted
UNION ALL
SELECT 'my-bucket', 'Risk', 'Portfolio ID', portfolio_id, 'Risk', round(risk, 8),
       epoch_ms(o_ts) FROM emitted
UNION ALL
SELECT 'my-bucket', 'Expected_Return', 'Portfolio ID', portfolio_id, 'Expected Return',
       round(expected_return, 8), epoch_ms(o_ts) FROM emitted""",
    "metrics_record": "WITH " + ASOF + """
SELECT portfolio_id AS portfolioId, round(risk, 8) AS risk, round(expected_return, 8) AS expectedReturn,
       round(sharpe, 8) AS sharpRatio, epoch_ms(o_ts) AS timestamp
FROM emit WHERE rn = 1 OR expected_return IS DISTINCT FROM pe OR risk IS DISTINCT FROM pr""",
    "processing_stamp": "WITH " + ASOF + """
SELECT portfolio_id AS portfolioId, round(risk, 8) AS risk, round(expected_return, 8) AS expectedReturn,
       true AS stamped_now
FROM emit WHERE rn = 1 OR expected_return IS DISTINCT FROM pe OR risk IS DISTINCT FROM pr""",
    "constant_portfolio": "WITH " + RETURNS + """
SELECT 'portf1' AS portfolio_id, ticker, window_end, round(return_value, 8) AS return_value
FROM returns WHERE NOT isnan(return_value)""",
    "log_return_edge": LOG_RETURN.replace(TICKS, SIGNED_TICKS),
    "lenient_ticks": "WITH " + RETURNS.replace(TICKS, DIRTY_TICKS) + """,
bad AS (
  SELECT ticker, date_trunc('day', ts) AS day, count(*) AS n_bad
  FROM everything WHERE opening_price IS NULL OR current_price IS NULL GROUP BY ALL)
SELECT r.ticker, r.window_start AS day, r.n_ticks, round(r.return_value, 8) AS return_value,
       coalesce(b.n_bad, 0) AS n_bad
FROM returns r LEFT JOIN bad b ON b.ticker = r.ticker AND b.day = r.window_start
WHERE NOT isnan(r.return_value)""",
}
