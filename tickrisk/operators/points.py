"""Time-series point tables (K4, K5, P12) and their line-protocol text.

A point is ``(bucket, measurement, tag_key, portfolio_id, field, value,
time_ms)``. Metrics give three points per record (P12 unpivot); weight
snapshots give one point per non-null weight with the ticker as the
measurement (K5). ``write_points`` writes them as parquet (or line-protocol
text) partitioned by bucket; a time-series database can load
either. No database client lives here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickrisk.operators.weights import explode_weights

# Fixed values of the point layout (measurement, field and tag names).
TAG_KEY = "Portfolio ID"
METRIC_POINTS = [
    ("Sharpe_Ratio", "Sharpe Ratio", "sharpRatio"),
    ("Risk", "Risk", "risk"),
    ("Expected_Return", "Expected Return", "expectedReturn"),
]
WEIGHT_FIELD = "weight"
DEFAULT_METRICS_BUCKET = "my-bucket"
DEFAULT_WEIGHTS_BUCKET = "weights"

POINT_COLS = ["bucket", "measurement", "tag_key", "portfolio_id", "field", "value", "time_ms"]


def metric_points(metrics: DataFrame, bucket: str = DEFAULT_METRICS_BUCKET) -> DataFrame:
    """Metrics wire records -> three points each (``stack``)."""
    args = ", ".join(f"'{m}', '{f}', `{c}`" for m, f, c in METRIC_POINTS)
    long = metrics.selectExpr(
        "portfolioId AS portfolio_id", "timestamp AS time_ms",
        f"stack({len(METRIC_POINTS)}, {args}) AS (measurement, field, value)")
    return long.select(F.lit(bucket).alias("bucket"), "measurement", F.lit(TAG_KEY).alias("tag_key"),
                       "portfolio_id", "field", F.col("value").cast("double").alias("value"),
                       "time_ms")


def weight_points(snapshots: DataFrame, bucket: str = DEFAULT_WEIGHTS_BUCKET) -> DataFrame:
    """K5: one point per non-null weight; measurement = ticker."""
    w = explode_weights(snapshots)
    return w.select(F.lit(bucket).alias("bucket"), F.col("ticker").alias("measurement"),
                    F.lit(TAG_KEY).alias("tag_key"), "portfolio_id",
                    F.lit(WEIGHT_FIELD).alias("field"), F.col("weight").alias("value"),
                    F.col("timestamp").alias("time_ms"))


def _escape(col, chars: str):
    for ch in chars:
        col = F.replace(col, F.lit(ch), F.lit("\\" + ch))
    return col


def line_protocol(points: DataFrame) -> DataFrame:
    """Points -> line-protocol text ``measurement,tag=v field=value ms``.

    Measurement escapes commas and spaces; tag keys, tag values and field
    keys escape commas, equals signs and spaces. Times are milliseconds. The
    format has no NaN or infinity: such points (a Sharpe ratio at risk 0) are only
    in the table form.
    """
    finite = ~F.isnan("value") & (F.abs("value") != float("inf"))
    points = points.filter(finite)
    meas = _escape(F.col("measurement"), ", ")
    tag = F.concat(_escape(F.col("tag_key"), ",= "), F.lit("="), _escape(F.col("portfolio_id"), ",= "))
    field = F.concat(_escape(F.col("field"), ",= "), F.lit("="), F.col("value").cast("string"))
    line = F.concat_ws(" ", F.concat(meas, F.lit(","), tag), field, F.col("time_ms").cast("string"))
    return points.select("bucket", "measurement", line.alias("line"))


def write_points(points: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    """Write points partitioned by bucket (``parquet`` or ``text``). The measurement stays a
    column: with tickers as measurements a folder each would make very many small files."""
    if fmt == "text":
        line_protocol(points).select("bucket", "line").write.mode(mode).partitionBy("bucket").text(path)
    else:
        points.write.mode(mode).partitionBy("bucket").parquet(path)
