"""Property tests of the IEEE helpers and the ordered sum against Python."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from tickrisk.functions.ieee import ieee_div, ieee_ln, sorted_sum

FLOATS = st.floats(allow_nan=True, allow_infinity=True, width=64)


def py_ln(x):
    if math.isnan(x) or x < 0:
        return float("nan")
    if x == 0:
        return float("-inf")
    return math.log(x)


def py_div(a, b):
    if math.isnan(a) or math.isnan(b):
        return float("nan")
    if b != 0:
        return a / b
    return float("inf") if a > 0 else float("-inf") if a < 0 else float("nan")


def same(a, b):
    if a is None or b is None:
        return a is b
    if math.isnan(a) or math.isnan(b):
        return math.isnan(a) and math.isnan(b)
    return a == b or abs(a - b) <= 1e-15 * max(abs(a), abs(b))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(FLOATS, FLOATS), min_size=1, max_size=60))
def test_ieee_ln_div(spark, pairs):
    df = spark.createDataFrame(pairs, "a double, b double")
    got = df.select("a", "b", ieee_ln("a").alias("l"), ieee_div("a", "b").alias("d")).collect()
    for r in got:
        assert same(r["l"], py_ln(r["a"])), r
        assert same(r["d"], py_div(r["a"], r["b"])), r


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=0, max_size=40))
def test_sorted_sum_is_order_free(spark, xs):
    rows = [(xs,), (list(reversed(xs)),), (sorted(xs),)]
    got = [r[0] for r in spark.createDataFrame(rows, "x array<double>")
           .select(sorted_sum("x")).collect()]
    assert got[0] == got[1] == got[2]
    exp = 0.0
    for v in sorted(xs):
        exp += v
    assert got[0] == exp


def test_cluster_conf_keys_are_accepted(spark):
    from tickrisk.session import cluster_conf
    conf = cluster_conf(executors=1000, cores_per_executor=8)
    assert conf["spark.sql.shuffle.partitions"] == "24000"
    saved = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
            assert spark.conf.get(k) == v
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_small_helpers(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from tickrisk.functions.ieee import map_get_or_zero
    from tickrisk.operators.scan import block_of
    from tickrisk.sources.streams import single_file_glob
    assert single_file_glob("/d/events.parquet") == "/d/[e]vents.parquet"
    df = spark.createDataFrame([({"A": 1.5}, dt.datetime(1970, 1, 1, 2, 30))],
                               "m map<string,double>, ts timestamp")
    r = df.select(map_get_or_zero("m", F.lit("A")).alias("a"),
                  map_get_or_zero("m", F.lit("Z")).alias("z"),
                  block_of("ts", 3600).alias("b")).first()
    assert (r["a"], r["z"], r["b"]) == (1.5, 0.0, 2)


def test_offset_time_needs_date_and_t(spark):
    """A time alone would become today's, a space would pass for a T: both are refused."""
    import pytest
    from tickrisk.functions.parse import iso_offset_to_ts
    df = spark.createDataFrame([("T10:00:00Z",), ("2024-01-01 10:00:00Z",), ("2024-01-01T10:00:00Z",)], "t string")
    assert [r[0] is not None for r in df.select(iso_offset_to_ts("t")).collect()] == [False, False, True]
    for bad in ("T10:00:00Z", "2024-01-01 10:00:00Z"):
        with pytest.raises(Exception, match="unparseable"):
            df.where(df.t == bad).select(iso_offset_to_ts("t", strict=True)).collect()
