"""Log returns per (ticker, window): clauses a1-a6 and P1/P2/P3 parsing."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tickrisk.functions.ieee import ieee_div, ieee_ln
from tickrisk.functions.parse import (iso_offset_to_millis, lenient_weight_time,
                                      lenient_weight_time_to_millis)
from tickrisk.operators import ticks as tk

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)
SCHEMA = ("seq long, arrival_ts timestamp, ticker string, field_opening_price string, "
          "field_cours_courant string, field_last_traded_time string")


def _raw(spark, rows):
    out = []
    for seq, (ticker, open_, cur, sec) in enumerate(rows):
        ts = T0 + dt.timedelta(seconds=sec)
        out.append((seq, ts, ticker, open_, cur, ts.strftime("%Y-%m-%dT%H:%M:%S.%fZ")))
    return spark.createDataFrame(out, SCHEMA)


def _returns(spark, rows, **kw):
    df = tk.log_returns(tk.typed_ticks(_raw(spark, rows), **kw), window="2 seconds")
    return {r["ticker"]: r for r in df.collect()}


def test_window_rules(spark):
    rows = [
        ("lone", "10", "99", 0.1),
        ("two", "100", "1", 0.1), ("two", "7", "110", 0.2),
        ("zero_base", "0", "3", 0.1), ("zero_base", "1", "5", 0.2),
        ("zero_last", "5", "1", 0.1), ("zero_last", "1", "0", 0.2),
        ("flip", "5", "1", 0.1), ("flip", "1", "-1", 0.2),
        ("neg", "-5", "1", 0.1), ("neg", "1", "-10", 0.2),
        ("three", "100", "1", 0.1), ("three", "1", "50", 0.2), ("three", "1", "120", 0.3),
    ]
    r = _returns(spark, rows)
    assert r["lone"]["return_value"] == 0.0 and r["lone"]["n_ticks"] == 1
    assert r["two"]["return_value"] == pytest.approx(math.log(1.1), abs=1e-12)
    assert "zero_base" not in r
    assert r["zero_last"]["return_value"] == float("-inf")
    assert "flip" not in r
    assert r["neg"]["return_value"] == pytest.approx(math.log(2.0), abs=1e-12)
    # only the last tick's current price counts
    assert r["three"]["return_value"] == pytest.approx(math.log(1.2), abs=1e-12)
    assert r["three"]["last_traded_ts"] == T0 + dt.timedelta(seconds=0.3)
    # the exact text of the last tick's time on request
    txt = tk.log_returns(tk.typed_ticks(_raw(spark, rows)), window="2 seconds", keep_text=True)
    assert {x["ticker"]: x["last_traded_time"] for x in txt.collect()}["three"] == \
        "2024-01-01T10:00:00.300000Z"


def test_windows_split_by_time(spark):
    rows = [("A", "10", "11", 0.5), ("A", "20", "22", 2.5), ("A", "1", "30", 3.5)]
    df = tk.log_returns(tk.typed_ticks(_raw(spark, rows)), window="2 seconds")
    got = sorted((r["window_start"], r["return_value"]) for r in df.collect())
    assert len(got) == 2
    assert got[0][1] == 0.0
    assert got[1][1] == pytest.approx(math.log(30 / 20), abs=1e-12)


def test_arrival_order_not_time_order(spark):
    # first/last follow arrival order (seq), not the last-traded time
    raw = _raw(spark, [("A", "10", "1", 0.9), ("A", "1", "15", 0.1)])
    r = tk.log_returns(tk.typed_ticks(raw), window="2 seconds").collect()[0]
    assert r["base_price"] == 10 and r["last_price"] == 15


def test_malformed_price_raises_or_quarantines(spark):
    raw = _raw(spark, [("A", "12,5", "1", 0.1), ("B", "10", "11", 0.1)])
    with pytest.raises(Exception):
        tk.log_returns(tk.typed_ticks(raw), window="2 seconds").collect()
    good, bad = tk.quarantine_split(tk.typed_ticks(raw, strict=False))
    assert bad.count() == 1 and good.count() == 1


def test_unparseable_time_fails_fast_or_nulls(spark):
    raw = _raw(spark, [("A", "10", "11", 0.5)]).withColumn(
        "field_last_traded_time", F.lit("2024-01-01 10:00:00"))
    with pytest.raises(Exception):
        tk.typed_ticks(raw).collect()
    assert tk.typed_ticks(raw, strict=False).first()["event_ts"] is None


def test_event_time_option(spark):
    raw = _raw(spark, [("A", "10", "11", 0.5)])
    t = tk.typed_ticks(raw, event_time=True).collect()[0]
    assert t["ts"] == t["event_ts"]


def test_ieee_helpers(spark):
    df = spark.createDataFrame([(0.0, 0.0), (-1.0, 2.0), (4.0, 0.0), (-4.0, 0.0),
                                (float("nan"), 1.0), (math.e, -2.0)], "x double, y double")
    got = df.select(ieee_ln("x").alias("l"), ieee_div("x", "y").alias("d")).collect()
    assert got[0]["l"] == float("-inf") and math.isnan(got[0]["d"])
    assert math.isnan(got[1]["l"]) and got[1]["d"] == -0.5
    assert got[2]["d"] == float("inf") and got[3]["d"] == float("-inf")
    assert math.isnan(got[4]["l"]) and math.isnan(got[4]["d"])
    assert got[5]["l"] == pytest.approx(1.0)


def test_time_parsing(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("2024-01-01T10:00:00Z",),
                                ("2024-01-01T10:00:00+01:00",), ("2024-01-01T10:00:00",)],
                               "t string")
    got = df.select(lenient_weight_time("t").alias("n"),
                    lenient_weight_time_to_millis("t").alias("ms"),
                    iso_offset_to_millis("t").alias("iso")).collect()
    ms = 1704103200000
    assert [g["ms"] for g in got] == [ms, ms, None, ms]
    assert got[2]["n"] == "2024-01-01T10:00:00+01:00Z"
    # A price time needs an offset; +01:00 is honoured
    assert [g["iso"] for g in got] == [None, ms, ms - 3600_000, None]


def test_assign_portfolios(spark):
    r = spark.createDataFrame([("A", 0.1), ("B", 0.2)], "ticker string, return_value double")
    h = spark.createDataFrame([("P1", "A"), ("P2", "A"), ("P2", "B"), ("P2", "B")],
                              "portfolio_id string, ticker string")
    got = sorted(tuple(x) for x in tk.assign_portfolios(r, h)
                 .select("portfolio_id", "ticker").collect())
    assert got == [("P1", "A"), ("P2", "A"), ("P2", "B")]
    # beyond the broadcast limit: salted join, same rows
    salted = sorted(tuple(x) for x in tk.assign_portfolios(r, h, salt_above_bytes=-1, salt_buckets=4)
                    .select("portfolio_id", "ticker", "return_value").collect())
    assert [x[:2] for x in salted] == got and len(salted) == 3
    one = tk.assign_portfolios(r).select(F.collect_set("portfolio_id")).first()[0]
    assert one == ["portf1"]


def test_strict_parsing_independent_of_ansi(spark):
    from tickrisk.functions.parse import iso_offset_to_ts, parse_price
    prev = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        df = spark.createDataFrame([("12,5", "2024-01-01 10:00:00")], "p string, t string")
        with pytest.raises(Exception):
            df.select(parse_price("p")).collect()
        with pytest.raises(Exception):
            df.select(iso_offset_to_ts("t", strict=True)).collect()
        assert df.select(parse_price("p", strict=False)).first()[0] is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)


def test_offset_forms(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00-05:00",), ("2024-01-01T10:00:00.5Z",),
                                ("2024-01-01",), ("2024-01-01 10:00",)], "t string")
    got = [r[0] for r in df.select(iso_offset_to_millis("t")).collect()]
    assert got == [1704103200000 + 5 * 3600_000, 1704103200500, None, None]
