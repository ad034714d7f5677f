"""Weight rows -> snapshots (A7, S6, P3), point tables (K4, K5, P12), line protocol."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from tickrisk.operators import points as pt
from tickrisk.operators import weights as wt
from tickrisk.schemas import AVRO, PRICE_TICK_FIELDS, STRUCTS

ROWS = "seq long, time string, portfolio_id string, ticker string, weight string"


def test_rows_to_snapshots_dedupes_last_arrival(spark):
    rows = spark.createDataFrame([
        (1, "2024-01-01 10:00:00", "P", "A", "0.5"),
        (1, "2024-01-01 10:00:00", "P", "B", "0.5"),
        (2, "2024-01-01T10:00:00Z", "P", "A", "0.7"),    # same snapshot time, later arrival
        (3, "2024-01-01T10:00:00+01:00", "P", "A", "0.1"),  # lenient rule fails: dropped
        (4, "2024-01-02 00:00:00", "Q", "A", "1"),
    ], ROWS)
    import pytest
    with pytest.raises(Exception):
        wt.typed_weight_rows(rows).collect()          # strict: the +01:00 row fails
    typed = wt.typed_weight_rows(rows, strict=False)
    assert typed.filter(F.col("time_ms").isNull()).count() == 1
    snaps = {(r["portfolio_id"], r["timestamp"]): r for r in wt.rows_to_snapshots(typed).collect()}
    p = snaps[("P", 1704103200000)]
    assert p["weights"] == {"A": 0.7, "B": 0.5} and p["seq"] == 2
    assert snaps[("Q", 1704153600000)]["weights"] == {"A": 1.0}


def test_weight_points_skip_null(spark):
    snaps = spark.createDataFrame([(1, 1000, "P", {"A": 0.5, "B": None})],
                                  "seq long, timestamp long, portfolio_id string, "
                                  "weights map<string,double>")
    got = pt.weight_points(snaps).collect()
    assert len(got) == 1
    r = got[0]
    assert (r["bucket"], r["measurement"], r["tag_key"], r["field"], r["value"], r["time_ms"]) == \
        ("weights", "A", "Portfolio ID", "weight", 0.5, 1000)


def test_metric_points_and_line_protocol(spark):
    rec = spark.createDataFrame([("P 1", 0.2, 0.01, 1.5, 5000)],
                                "portfolioId string, risk double, expectedReturn double, "
                                "sharpRatio double, timestamp long")
    pts = pt.metric_points(rec)
    got = {r["measurement"]: r for r in pts.collect()}
    assert set(got) == {"Sharpe_Ratio", "Risk", "Expected_Return"}
    assert got["Sharpe_Ratio"]["field"] == "Sharpe Ratio" and got["Sharpe_Ratio"]["value"] == 1.5
    assert got["Expected_Return"]["value"] == 0.01 and got["Risk"]["time_ms"] == 5000
    lines = {r["measurement"]: r["line"] for r in pt.line_protocol(pts).collect()}
    assert lines["Sharpe_Ratio"] == "Sharpe_Ratio,Portfolio\\ ID=P\\ 1 Sharpe\\ Ratio=1.5 5000"
    out = tempfile.mkdtemp(prefix="points-")
    pt.write_points(pts, out + "/pq")
    assert [d for d in os.listdir(out + "/pq") if "=" in d] == ["bucket=my-bucket"]
    assert {r["measurement"] for r in spark.read.parquet(out + "/pq").collect()} == set(got)
    pt.write_points(pts, out + "/txt", fmt="text")
    assert spark.read.text(out + "/txt").count() == 3


def test_line_protocol_has_no_nan_or_infinity(spark):
    rec = spark.createDataFrame([("P", 0.0, 0.01, float("inf"), 1), ("P", float("nan"), 0.01, float("nan"), 2)],
                                "portfolioId string, risk double, expectedReturn double, "
                                "sharpRatio double, timestamp long")
    pts = pt.metric_points(rec)
    assert pts.count() == 6
    lines = [r["line"] for r in pt.line_protocol(pts).collect()]
    assert len(lines) == 3 and not any("Inf" in x or "NaN" in x for x in lines)


def test_malformed_weight_rows_are_kept_apart(spark):
    from tickrisk.operators import weights as wt
    rows = spark.createDataFrame([(1, "2024-01-01 00:00:00", "P", "A", "0.5"),
                                  (2, "2024-01-01T00:00:00+01:00", "P", "A", "0.5"),
                                  (3, "2024-01-01 00:00:00", "P", "B", "half")],
                                 "seq long, time string, portfolio_id string, ticker string, weight string")
    good, bad = wt.quarantine_rows(wt.typed_weight_rows(rows, strict=False))
    assert [r["seq"] for r in good.collect()] == [1] and sorted(r["seq"] for r in bad.collect()) == [2, 3]
    assert wt.rows_to_snapshots(good).first()["weights"] == {"A": 0.5}


def test_undecodable_topic_rows_are_kept_apart(spark):
    from tickrisk.sources.streams import avro_quarantine
    df = spark.createDataFrame([(1000, "P", {"A": 0.5}), (None, None, None)],
                               "timestamp long, portfolio_id string, weights map<string,double>")
    good, bad = avro_quarantine(df, "weight_snapshot")
    assert (good.count(), bad.count()) == (1, 1)


def test_avro_schemas_match_structs():
    for name, js in AVRO.items():
        sch = json.loads(js)
        assert [f["name"] for f in sch["fields"]] == [f.name for f in STRUCTS[name].fields]
    assert len(PRICE_TICK_FIELDS) == 28
    stats = json.loads(AVRO["portfolio_stats"])
    assert stats["fields"][3]["type"] == {"type": "map", "values": {"type": "map", "values": "double"}}
    assert [f["name"] for f in json.loads(AVRO["portfolio_metrics"])["fields"]] == \
        ["portfolioId", "risk", "expectedReturn", "sharpRatio", "timestamp"]


def test_map_metrics_matches_python_rule(spark):
    from tickrisk.functions.ieee import map_metrics
    from step_oracle import metrics as py_metrics
    w = {"A": 0.6, "B": 0.4, "Z": 0.5}
    means = {"A": 0.01, "B": 0.02}
    cov = {"A": {"A": 0.04, "B": 0.01}, "B": {"A": 0.01, "B": 0.09}}
    df = spark.createDataFrame([(w, means, cov)], "w map<string,double>, m map<string,double>, "
                                                  "c map<string,map<string,double>>")
    r = df.select(map_metrics("w", "m", "c").alias("x")).first()["x"]
    e, var, risk, sharpe = py_metrics(w, means, cov)
    assert (r["expected_return"], r["variance"], r["risk"], r["sharpe"]) == \
        __import__("pytest").approx((e, var, risk, sharpe))


def test_wire_record_projection(spark):
    """Sink payloads keep exactly the record's fields, order and types."""
    import datetime as dt
    from tickrisk.operators.metrics import to_metrics_record
    from tickrisk.sources.sinks import wire_record
    em = spark.createDataFrame([("P", dt.datetime(2024, 1, 1), 0.1, 0.2, 0.3, 1, 2, "x")],
                               "portfolio_id string, o_ts timestamp, risk double, "
                               "expected_return double, sharpe double, o_side int, "
                               "o_seq long, o_tie string")
    rec = wire_record(to_metrics_record(em), "portfolio_metrics")
    assert rec.schema.simpleString() == ("struct<portfolioId:string,risk:double,expectedReturn:"
                                         "double,sharpRatio:double,timestamp:bigint>")
    stats = spark.createDataFrame(
        [("P", dt.datetime(2024, 1, 1), "A", 1, 5, {"A": 0.1}, {"A": {"A": 0.2}})],
        "portfolio_id string, o_ts timestamp, ticker string, n long, timestamp long, "
        "meanReturns map<string,double>, covarianceMatrix map<string,map<string,double>>")
    assert wire_record(stats, "portfolio_stats").columns == \
        ["timestamp", "portfolio_id", "meanReturns", "covarianceMatrix"]


def test_json_file_twin_sources(spark):
    """S2/S3 file twins in JSON: records with (nested) maps read back with the
    fixed schemas, batch and stream."""
    from pyspark.sql import types as T
    from tickrisk.plans import standin
    from tickrisk.schemas import PORTFOLIO_STATS, WEIGHT_SNAPSHOT
    from tickrisk.sources.streams import file_source
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    root = tempfile.mkdtemp(prefix="json-")
    snaps = standin.weight_snapshots(ev)
    seeds = standin.stats_seeds(ev)
    snaps.write.json(f"{root}/w")
    seeds.write.json(f"{root}/s")
    snap_t = T.StructType([T.StructField("seq", T.LongType())] + WEIGHT_SNAPSHOT.fields)
    seed_t = T.StructType([T.StructField("seq", T.LongType())] + PORTFOLIO_STATS.fields)
    back = file_source(spark, f"{root}/w", snap_t, fmt="json")
    assert back.count() == snaps.count()
    assert sorted(map(tuple, back.select("seq", "portfolio_id").collect())) == \
        sorted(map(tuple, snaps.select("seq", "portfolio_id").collect()))
    s = file_source(spark, f"{root}/s", seed_t, fmt="json").first()
    assert s["covarianceMatrix"]["T1"]["T1"] == (1 + 1) / 10000.0 + 1 / 1000.0
    assert file_source(spark, f"{root}/w", snap_t, fmt="json", stream=True).isStreaming
