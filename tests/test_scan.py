"""Two-level ordered scans against brute-force pandas, over several block sizes."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickrisk.operators.scan import (block_of, ew_scan, forward_fill, previous_row,
                                     running, running_sum)

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    rows = []
    for k in ["a", "b", "c"]:
        for i in range(rnd.randint(20, 60)):
            ts = T0 + dt.timedelta(seconds=rnd.randint(0, 5000))
            v = rnd.choice([None, float(rnd.randint(1, 9))])
            rows.append((k, ts, i, v, rnd.uniform(-1, 1), 1))
    pdf = pd.DataFrame(rows, columns=["k", "ts", "seq", "v", "x", "one"])
    pdf = pdf.sort_values(["k", "ts", "seq"]).reset_index(drop=True)
    df = spark.createDataFrame(
        pdf.astype(object).where(pdf.notna(), None),
        "k string, ts timestamp, seq long, v double, x double, one int")
    return pdf, df


@pytest.mark.parametrize("seconds", [60, 700, 100000])
def test_scans_match_bruteforce(data, seconds):
    pdf, df = data
    df = df.withColumn("blk", block_of("ts", seconds))
    order = ["ts", "seq"]
    out = running_sum(df, ["k"], order, "blk", "one", "cnt")
    out = forward_fill(out, ["k"], order, "blk", "v", "ff")
    out = previous_row(out, ["k"], order, "blk", ["x"], "prev")
    out = running(out, ["k"], order, "blk", sums={"cnt2": "one"}, lasts={"ff2": "v"})
    got = out.select("k", "ts", "seq", "cnt", "ff", "cnt2", "ff2", F.col("prev.x").alias("px")) \
        .toPandas().sort_values(["k", "ts", "seq"]).reset_index(drop=True)
    exp = pdf.copy()
    exp["cnt"] = exp.groupby("k").cumcount() + 1
    exp["ff"] = exp.groupby("k")["v"].ffill()
    exp["px"] = exp.groupby("k")["x"].shift(1)
    assert list(got["cnt"]) == list(exp["cnt"]) == list(got["cnt2"])
    pd.testing.assert_series_equal(got["ff2"], exp["ff"], check_names=False)
    pd.testing.assert_series_equal(got["ff"], exp["ff"], check_names=False)
    pd.testing.assert_series_equal(got["px"], exp["px"], check_names=False)


@pytest.mark.parametrize("seconds,seg_rows,epoch_rows", [
    (60, 100000, 300000), (700, 5, 300000), (100000, 3, 300000), (60, 2, 7), (100000, 3, 5)])
def test_ew_scan_matches_recurrence(data, seconds, seg_rows, epoch_rows):
    pdf, df = data
    df = df.withColumn("blk", block_of("ts", seconds)).withColumn(
        "init", F.when(F.col("k") == "a", 0.5).when(F.col("k") == "b", -2.0).otherwise(0.0))
    q, a = 1000 / 1001, 1 / 1001
    out = ew_scan(df, ["k"], ["ts", "seq"], "blk", "x", "init", q, a, "y",
                  prev_out="yp", idx_out="n", seg_rows=seg_rows, epoch_rows=epoch_rows)
    got = out.select("k", "ts", "seq", "y", "yp", "n").toPandas() \
        .sort_values(["k", "ts", "seq"]).reset_index(drop=True)
    inits = {"a": 0.5, "b": -2.0, "c": 0.0}
    ys, yps, ns = [], [], []
    for k, g in pdf.groupby("k", sort=True):
        y = inits[k]
        for i, x in enumerate(g["x"], start=1):
            yps.append(y)
            y = q * y + a * x
            ys.append(y)
            ns.append(i)
    assert list(got["n"]) == ns
    assert got["y"].tolist() == pytest.approx(ys, rel=1e-12, abs=1e-15)
    assert got["yp"].tolist() == pytest.approx(yps, rel=1e-12, abs=1e-15)


def test_fast_decay_stays_finite_and_exact(spark):
    """count = 100 over 120 000 rows of one key: no overflow, equal to the step fold."""
    n, q, g = 120_000, 100 / 101, 1 / 101
    df = (spark.range(n).selectExpr("'k' as k", "id as o", "cast(id % 7 as double) / 100 as x", "0.5D as y0",
                                    "id div 50000 as blk"))
    got = ew_scan(df, ["k"], ["o"], "blk", "x", "y0", q, g, out="y").select("o", "y").toPandas().sort_values("o")
    y, exp = 0.5, []
    for i in range(n):
        y = q * y + g * ((i % 7) / 100)
        exp.append(y)
    assert max(abs(a - b) for a, b in zip(got["y"], exp)) < 1e-12


def test_scan_lengths_follow_the_decay():
    from tickrisk.operators.scan import scan_lengths
    assert scan_lengths(1000 / 1001) == (100_000, 300_000)
    seg, epoch = scan_lengths(100 / 101)
    assert seg < epoch and (100 / 101) ** -(seg + epoch) < float("inf")
    with __import__("pytest").raises(ValueError):
        scan_lengths(1e-300)
