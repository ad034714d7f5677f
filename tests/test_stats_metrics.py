"""Statistics (J1, A4-A6) and metrics (A2, A3, P10, J2, W1) against the
plain-Python step fold of the original rules, plus hand-computed fixtures."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import types as T

from tickrisk.operators import metrics as mt
from tickrisk.operators import stats as st
from tickrisk.params import RiskParams
from tickrisk.schemas import PORTFOLIO_STATS, WEIGHT_SNAPSHOT

from step_oracle import fold, metrics as py_metrics

D0 = dt.datetime(2024, 1, 1)
STATS_T = T.StructType([T.StructField("seq", T.LongType())] + PORTFOLIO_STATS.fields)
SNAP_T = T.StructType([T.StructField("seq", T.LongType())] + WEIGHT_SNAPSHOT.fields)
RET_T = "portfolio_id string, ticker string, order_ts timestamp, return_value double"


def ms(t: dt.datetime) -> int:
    return int((t - dt.datetime(1970, 1, 1)).total_seconds() * 1000)


def build_case(seed_=3, days=12):
    rnd = random.Random(seed_)
    tick = ["A", "B", "C", "D", "E"]
    means = {"A": 0.01, "B": 0.02, "C": 0.0, "D": 0.005}          # C sticky zero, E absent
    cov = {}
    for i in tick:
        for j in tick:
            if {i, j} == {"A", "D"}:
                continue                                           # absent pair
            c = 0.0 if {i, j} == {"B", "C"} else round(rnd.uniform(0.001, 0.01), 6)
            if i <= j:
                cov.setdefault(i, {})[j] = c
                cov.setdefault(j, {})[i] = c
    for t in tick:
        cov[t][t] = round(rnd.uniform(0.02, 0.05), 6)
    seed_time = D0 + dt.timedelta(days=3)
    seeds = [(1, ms(seed_time), "P0", means, cov),
             (2, ms(seed_time), "P1", means, cov),
             (3, ms(seed_time + dt.timedelta(days=1)), "P0", {"A": 9.0}, {"A": {"A": 9.0}})]
    rets = []
    for d in range(1, days):
        for t in tick:
            if rnd.random() < 0.8:
                r = rnd.uniform(-0.05, 0.05)
                for p in ["P0", "P1", "P2"]:
                    rets.append((p, t, D0 + dt.timedelta(days=d), r))
    snaps, seq = [], 100
    pool = [{"A": 0.5, "B": 0.3, "E": 0.2}, {"A": 0.2, "C": 0.3, "D": 0.4, "Z": 0.1},
            {"B": 1.0}, {"A": 0.25, "B": 0.25, "C": 0.25, "D": 0.25}]
    for d in range(0, days):
        for _ in range(rnd.randint(1, 4)):
            p = rnd.choice(["P0", "P1", "P2"])
            t = D0 + dt.timedelta(days=d, seconds=rnd.randint(0, 86399))
            w = rnd.choice(pool)
            seq += 1
            snaps.append((seq, ms(t), p, w))
            if rnd.random() < 0.3:                       # immediate repeat (suppressed)
                seq += 1
                snaps.append((seq, ms(t) + 1, p, w))
    return seeds, rets, snaps


def events_for_fold(seeds, rets, snaps):
    ev = []
    for seq, tms, p, m, c in seeds:
        t = dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=tms)
        ev.append(((t, 0, seq, ""), {"kind": "seed", "p": p, "means": m, "cov": c}))
    for p, tk_, t, r in rets:
        key = (t, 1, 0, tk_)
        ev.append((key, {"kind": "ret", "p": p, "ticker": tk_, "r": r, "key": key}))
    for seq, tms, p, w in snaps:
        t = dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=tms)
        key = (t, 2, seq, "")
        ev.append((key, {"kind": "weights", "p": p, "weights": w, "key": key}))
    ev.sort(key=lambda e: (e[1]["p"], e[0]))
    return [e for _, e in ev]


@pytest.fixture(scope="module", params=[(3, 86400 * 2), (3, 86400 * 100), (11, 86400)])
def case(spark, request):
    rnd_seed, block = request.param
    seeds, rets, snaps = build_case(seed_=rnd_seed, days=12 if rnd_seed == 3 else 20)
    params = RiskParams(block_seconds=block, series_block_seconds=block)
    stats_df = spark.createDataFrame(seeds, STATS_T)
    rets_df = spark.createDataFrame(rets, RET_T)
    snaps_df = spark.createDataFrame(snaps, SNAP_T)
    seed = st.first_seed(stats_df)
    applied = st.apply_to_seed(rets_df, seed)
    series = st.ew_series(applied, seed, params)
    cand = mt.metrics_asof(applied, series, seed, snaps_df, params)
    return dict(params=params, seed=seed, applied=applied, series=series, cand=cand,
                snaps=snaps_df, expect=fold(events_for_fold(seeds, rets, snaps)))


def test_first_seed_wins_and_returns_before_seed_dropped(case):
    seeds = {r["portfolio_id"]: r for r in case["seed"].collect()}
    assert set(seeds) == {"P0", "P1"} and seeds["P0"]["seq"] == 1
    applied = case["applied"].collect()
    assert all(r["order_ts"] >= r["seed_ts"] for r in applied)
    assert {r["portfolio_id"] for r in applied} == {"P0", "P1"}
    assert len(applied) == len(case["expect"]["stats"])


def test_series_matches_step_fold(case):
    got = {(r["portfolio_id"], r["ticker"], r["order_ts"]): r for r in case["series"].collect()}
    n = 0
    for p, s, key, (means, cov) in case["expect"]["stats"]:
        if s not in means:                   # unknown ticker: no mean row
            assert (p, s, key[0]) not in got
            continue
        r = got[(p, s, key[0])]
        assert r["mean"] == pytest.approx(means[s], rel=1e-9, abs=1e-15)
        assert r["var"] == pytest.approx(cov[s][s], rel=1e-9, abs=1e-15)
        n += 1
    assert n > 20


def test_final_offdiag_matches_step_fold(case):
    off = st.final_offdiag(case["applied"], case["seed"], case["params"]).collect()
    for r in off:
        exp = case["expect"]["final"][r["portfolio_id"]][1][r["i"]][r["j"]]
        assert r["cov"] == pytest.approx(exp, rel=1e-9, abs=1e-15)
    assert not any({r["i"], r["j"]} == {"A", "D"} for r in off)


def _key(r):
    return (r["o_ts"], r["o_side"], r["o_seq"], r["o_tie"])


def test_candidates_match_step_fold(case):
    got = {(r["portfolio_id"],) + _key(r): r for r in case["cand"].collect()}
    exp = case["expect"]["candidates"]
    assert len(got) == len(exp)
    for p, key, e, var, risk, sharpe in exp:
        r = got[(p,) + key]
        assert r["expected_return"] == pytest.approx(e, rel=1e-9, abs=1e-15)
        assert r["variance"] == pytest.approx(var, rel=1e-9, abs=1e-15)
        assert r["risk"] == pytest.approx(risk, rel=1e-9, abs=1e-15)
        assert r["sharpe"] == pytest.approx(sharpe, rel=1e-9)


def test_emit_on_change_matches_step_fold(case):
    em = mt.emit_on_change(case["cand"], case["params"]).collect()
    got = sorted((r["portfolio_id"],) + _key(r) for r in em)
    exp = sorted((p,) + key for p, key, *_ in case["expect"]["emitted"])
    assert got == exp
    assert len(exp) < len(case["expect"]["candidates"])   # some repeats suppressed


def _state(spark, rows):
    return spark.createDataFrame(rows, "portfolio_id string, ticker string, n long, "
                                       "mean double, var double")


def _seed(spark, means, cov):
    return spark.createDataFrame([(1, 0, "P", means, cov)], STATS_T)


def _weights(spark, w, seq=1):
    return spark.createDataFrame([("P", seq, 0, t, x) for t, x in w.items()],
                                 "portfolio_id string, seq long, timestamp long, "
                                 "ticker string, w double")


def test_metrics_fixture(spark):
    means = {"A": 0.01, "B": 0.02}
    cov = {"A": {"A": 0.04, "B": 0.01}, "B": {"A": 0.01, "B": 0.09}}
    seed = _seed(spark, means, cov)
    state = _state(spark, [("P", "A", 0, 0.01, 0.04), ("P", "B", 0, 0.02, 0.09)])
    m = mt.metrics_vs_state(_weights(spark, {"A": 0.6, "B": 0.4, "Z": 0.5}), state, seed,
                            RiskParams()).collect()[0]
    assert m["expected_return"] == pytest.approx(0.014)
    assert m["variance"] == pytest.approx(0.0336)
    assert m["risk"] == pytest.approx(0.1833030278)
    assert m["sharpe"] == pytest.approx(math.sqrt(52) * 0.0122 / 0.1833030278)
    e, var, risk, sh = py_metrics({"A": 0.6, "B": 0.4, "Z": 0.5}, means, cov)
    assert (m["expected_return"], m["risk"]) == pytest.approx((e, risk))


def test_zero_risk_and_negative_variance(spark):
    seed = _seed(spark, {"A": 0.1}, {"A": {"A": 0.0}})
    state = _state(spark, [("P", "A", 0, 0.1, 0.0)])
    m = mt.metrics_vs_state(_weights(spark, {"A": 1.0}), state, seed, RiskParams()).collect()[0]
    assert m["risk"] == 0.0 and m["sharpe"] == float("inf")
    seed = _seed(spark, {"A": 0.1}, {"A": {"A": -1.0}})
    state = _state(spark, [("P", "A", 0, 0.1, -1.0)])
    m = mt.metrics_vs_state(_weights(spark, {"A": 1.0}), state, seed, RiskParams()).collect()[0]
    assert math.isnan(m["risk"]) and math.isnan(m["sharpe"])


def test_single_step_and_decay(spark):
    seed = spark.createDataFrame(
        [(1, 0, "P", {"A": 0.01, "B": 0.03}, {"A": {"A": 0.04, "B": 0.02}, "B": {"A": 0.02, "B": 0.05}})],
        STATS_T)
    rets = spark.createDataFrame([("P", "A", D0, 0.02)], RET_T)
    applied = st.apply_to_seed(rets, seed)
    s = st.ew_series(applied, seed, RiskParams()).collect()[0]
    m1 = 0.01 + 0.01 / 1001
    assert s["mean"] == pytest.approx(m1, rel=1e-12)
    assert s["var"] == pytest.approx(0.04 + (0.01 * (0.02 - m1) - 0.04) / 1001, rel=1e-12)
    off = {(r["i"], r["j"]): r["cov"] for r in st.final_offdiag(applied, seed, RiskParams()).collect()}
    assert off[("A", "B")] == pytest.approx(0.02 * 1000 / 1001, rel=1e-12)
    assert off[("B", "A")] == off[("A", "B")]


def test_sticky_zero_and_unknown_ticker(spark):
    seed = spark.createDataFrame(
        [(1, 0, "P", {"A": 0.0, "B": 0.03}, {"A": {"A": 0.04, "Z": 0.01}, "Z": {"A": 0.01, "B": 0.02},
                                              "B": {"Z": 0.02, "B": 0.05}})], STATS_T)
    rets = spark.createDataFrame([("P", "A", D0, 0.5), ("P", "Z", D0, 0.2)], RET_T)
    applied = st.apply_to_seed(rets, seed)
    s = {r["ticker"]: r for r in st.ew_series(applied, seed, RiskParams()).collect()}
    assert s["A"]["mean"] == 0.0 and s["A"]["var"] == 0.04     # sticky zero, diag skipped
    assert "Z" not in s                                       # unknown ticker: no mean
    off = {(r["i"], r["j"]): r["cov"] for r in st.final_offdiag(applied, seed, RiskParams()).collect()}
    # tick of Z decays (Z, B) since B's mean is non-zero; (A, Z) stays: A's mean is 0
    assert off[("Z", "B")] == pytest.approx(0.02 * 1000 / 1001, rel=1e-12)
    assert off[("A", "Z")] == 0.01


TICK_T = ("seq long, arrival_ts timestamp, ticker string, field_opening_price string, "
          "field_cours_courant string, field_last_traded_time string")


def _job(spark, ticks, seeds, snaps, **kw):
    """RiskJob over (second, ticker, opening, current) ticks of one portfolio, 2 s windows."""
    from tickrisk.plans.batch import RiskJob
    rows = [(k, D0 + dt.timedelta(seconds=s), t, o, c, (D0 + dt.timedelta(seconds=s)).strftime("%Y-%m-%dT%H:%M:%SZ"))
            for k, (s, t, o, c) in enumerate(ticks)]
    return RiskJob(spark.createDataFrame(rows, TICK_T), spark.createDataFrame(seeds, STATS_T),
                   spark.createDataFrame(snaps, SNAP_T), params=kw.pop("params", RiskParams(window="2 seconds")), **kw)


def _expected(job, seeds, snaps, count=1000):
    """The step fold over the job's own returns."""
    rets = [(r["portfolio_id"], r["ticker"], r["order_ts"], r["return_value"]) for r in job.portfolio_returns.collect()]
    return fold(events_for_fold(seeds, rets, snaps), count)


def _same(a, b, rel=1e-9):
    return (math.isnan(a) and math.isnan(b)) or a == b or a == pytest.approx(b, rel=rel, abs=1e-12)


SYM = {"A": {"A": 0.04, "B": 0.01}, "B": {"A": 0.01, "B": 0.09}}
MOVES = [(0, "A", "10", "10"), (1, "A", "10", "11"), (0, "B", "10", "10"), (1, "B", "10", "12"),
         (4, "A", "10", "10"), (5, "A", "10", "9"), (8, "B", "10", "10"), (9, "B", "10", "11"),
         (12, "A", "7", "7"), (13, "A", "7", "8")]
CASES = {
    "infinite return": (MOVES[:4] + [(4, "A", "10", "10"), (5, "A", "10", "0")] + MOVES[6:], {"A": 0.01, "B": 0.02}, SYM),
    "asymmetric seed": (MOVES, {"A": 0.01, "B": 0.02}, {"A": {"A": 0.04, "B": 0.01}, "B": {"A": 0.03, "B": 0.09}}),
    "one-sided cell": (MOVES, {"A": 0.01, "B": 0.02}, {"A": {"A": 0.04, "B": 0.01}, "B": {"B": 0.09}}),
    "negative variance": (MOVES, {"A": 0.01, "B": 0.02}, {"A": {"A": -0.04}, "B": {"B": 0.09}}),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_job_outside_closed_form_equals_step_fold(spark, name):
    """Series, candidates, records, final cells and metrics follow the step rule for every input."""
    ticks, means, cov = CASES[name]
    seeds = [(0, ms(D0), "portf1", means, cov)]
    snaps = [(10, ms(D0 + dt.timedelta(seconds=3)), "portf1", {"A": 0.5, "B": 0.5}),
             (11, ms(D0 + dt.timedelta(seconds=11)), "portf1", {"A": 0.2, "B": 0.7})]
    job = _job(spark, ticks, seeds, snaps)
    exp = _expected(job, seeds, snaps)
    series = {(r["ticker"], r["order_ts"]): r for r in job.series.collect()}
    records = {(r["ticker"], r["o_ts"]): r for r in job.records.collect()}
    assert len(series) == len(records) == len(exp["stats"]) > 0
    for _, t, key, (m, c) in exp["stats"]:
        r, rec = series[t, key[0]], records[t, key[0]]
        assert _same(r["mean"], m[t]) and _same(r["var"], c[t][t])
        assert {k: round(v, 9) if v == v else "nan" for k, v in rec["meanReturns"].items()} == \
            {k: round(v, 9) if v == v else "nan" for k, v in m.items()}
        assert {(i, j) for i, x in rec["covarianceMatrix"].items() for j in x} == {(i, j) for i, x in c.items() for j in x}
        assert all(_same(rec["covarianceMatrix"][i][j], v) for i, x in c.items() for j, v in x.items())
    got = sorted(job.candidates.collect(), key=lambda r: (r["o_ts"], r["o_side"], r["o_seq"], r["o_tie"]))
    assert len(got) == len(exp["candidates"]) > 0
    for r, (_, key, e, var, risk, sharpe) in zip(got, exp["candidates"]):
        assert r["o_ts"] == key[0] and _same(r["expected_return"], e) and _same(r["risk"], risk)
        assert _same(r["sharpe"], sharpe)
    assert job.emitted.count() == len(exp["emitted"])
    means, cov = exp["final"]["portf1"]
    off = {(r["i"], r["j"]): r["cov"] for r in job.offdiag.collect()}
    assert off.keys() == {(i, j) for i, x in cov.items() for j in x if i != j}
    assert all(_same(v, cov[i][j]) for (i, j), v in off.items())
    final = {r["seq"]: r for r in job.vs_final.collect()}
    for seq, _, _, w in snaps:
        e, var, risk, sharpe = py_metrics(w, means, cov)
        assert _same(final[seq]["expected_return"], e) and _same(final[seq]["risk"], risk)


def test_mean_that_becomes_zero_stays_zero(spark):
    """Mean m, return -1000 m: the new mean is exactly 0 and stays, the variance too."""
    m = 2.0 ** -10
    seed = spark.createDataFrame([(1, ms(D0), "P", {"X": m}, {"X": {"X": 0.04}})], STATS_T)
    rets = spark.createDataFrame([("P", "X", D0 + dt.timedelta(hours=h), r) for h, r in
                                  ((1, -1000 * m), (2, 0.05), (3, -0.02))], RET_T)
    applied = st.apply_to_seed(rets, seed)
    from tickrisk.operators import exact
    means = st.ew_mean_series(applied, seed, RiskParams())
    assert [r[0] for r in st.uncovered_portfolios(applied, seed, means).collect()] == ["P"]
    events = exact.fold_events(applied, seed, spark.createDataFrame([], SNAP_T), RiskParams())
    got = sorted(exact.series_of(events).collect(), key=lambda r: r["n"])
    assert [r["mean"] for r in got] == [0.0, 0.0, 0.0] and [r["var"] for r in got] == [0.04] * 3


def test_covered_and_uncovered_portfolios_side_by_side(spark):
    """Only the portfolios that need it are folded; the others keep the closed form."""
    from tickrisk.plans.batch import RiskJob
    seeds = [(0, ms(D0), "P0", {"A": 0.01, "B": 0.02}, SYM),
             (1, ms(D0), "P1", {"A": 0.01, "B": 0.02}, CASES["asymmetric seed"][2])]
    snaps = [(10 + k, ms(D0 + dt.timedelta(seconds=3)), p, {"A": 0.5, "B": 0.5}) for k, p in enumerate(("P0", "P1"))]
    base = _job(spark, MOVES, seeds, snaps)
    holdings = spark.createDataFrame([(p, t) for p in ("P0", "P1") for t in "AB"], "portfolio_id string, ticker string")
    job = RiskJob(base.ticks_raw, base.stats_records, base.weight_snapshots, holdings, params=base.params)
    assert [r[0] for r in job.uncovered.collect()] == ["P1"]
    exp = _expected(job, seeds, snaps)
    got = sorted(job.candidates.collect(), key=lambda r: (r["portfolio_id"], r["o_ts"], r["o_side"], r["o_tie"]))
    assert len(got) == len(exp["candidates"])
    for r, (p, key, e, var, risk, sharpe) in zip(got, exp["candidates"]):
        assert r["portfolio_id"] == p and _same(r["expected_return"], e) and _same(r["risk"], risk)


def test_malformed_prices_are_kept_apart(spark):
    """A window whose prices do not parse gives no return: statistics as without it."""
    ticks = MOVES[:4] + [(4, "A", "ten", "10"), (5, "A", "10", "n/a")] + MOVES[6:]
    seeds = [(0, ms(D0), "portf1", {"A": 0.01, "B": 0.02}, SYM)]
    snaps = [(10, ms(D0 + dt.timedelta(seconds=3)), "portf1", {"A": 0.5, "B": 0.5})]
    job = _job(spark, ticks, seeds, snaps, strict=False)
    without = _job(spark, MOVES[:4] + MOVES[6:], seeds, snaps)
    assert job.bad_ticks.count() == 2
    cols = ["ticker", "order_ts", "n", "mean", "var"]
    assert sorted(map(tuple, job.series.select(*cols).collect())) == sorted(map(tuple, without.series.select(*cols).collect()))
    assert job.candidates.count() == without.candidates.count() > 0


def test_empty_snapshot_triggers(spark):
    """An empty weight map: E = 0, risk = 0, Sharpe = -Infinity, until the next one."""
    seeds = [(0, ms(D0), "portf1", {"A": 0.01, "B": 0.02}, SYM)]
    snaps = [(10, ms(D0 + dt.timedelta(seconds=3)), "portf1", {"A": 0.5}),
             (11, ms(D0 + dt.timedelta(seconds=7)), "portf1", {}),
             (12, ms(D0 + dt.timedelta(seconds=11)), "portf1", {})]
    job = _job(spark, MOVES, seeds, snaps)
    got = {(r["o_ts"], r["o_side"], r["o_tie"]): r for r in job.candidates.collect()}
    after = [r for k, r in got.items() if k[0] >= D0 + dt.timedelta(seconds=7)]
    assert len(after) == 4
    assert all((r["expected_return"], r["risk"], r["sharpe"]) == (0.0, 0.0, float("-inf")) for r in after)


def test_snapshots_with_equal_seq(spark):
    """Two snapshots with one offset (of two partitions): each is current from its own time on."""
    seeds = [(0, ms(D0), "portf1", {"A": 0.01}, {"A": {"A": 0.04}})]
    snaps = [(7, ms(D0 + dt.timedelta(seconds=3)), "portf1", {"A": 0.2}),
             (7, ms(D0 + dt.timedelta(seconds=7)), "portf1", {"A": 0.5})]
    job = _job(spark, MOVES, seeds, snaps)
    mean = {r["order_ts"]: r["mean"] for r in job.series.collect()}
    rows = sorted(job.candidates.collect(), key=lambda r: (r["o_ts"], r["o_side"]))
    ratio = {r["o_ts"].second: r["expected_return"] for r in rows}
    assert ratio[3] == pytest.approx(0.2 * mean[D0 + dt.timedelta(seconds=2)])
    assert ratio[7] == pytest.approx(0.5 * mean[D0 + dt.timedelta(seconds=6)])


def test_struct_order_of_unkeyed_topics(spark):
    """seq = (timestamp, partition, offset): seeds and snapshots compare the whole of it."""
    place = T.StructType([T.StructField("timestamp", T.TimestampType()), T.StructField("partition", T.IntegerType()),
                          T.StructField("offset", T.LongType())])
    stats_t = T.StructType([T.StructField("seq", place)] + PORTFOLIO_STATS.fields)
    snap_t = T.StructType([T.StructField("seq", place)] + WEIGHT_SNAPSHOT.fields)
    t = D0 + dt.timedelta(seconds=1)
    seeds = spark.createDataFrame([((t, 1, 3), ms(D0), "P", {"A": 5.0}, {"A": {"A": 1.0}}),
                                   ((t, 0, 9), ms(D0), "P", {"A": 0.01}, {"A": {"A": 0.04}})], stats_t)
    seed = st.first_seed(seeds)
    assert seed.first()["meanReturns"] == {"A": 0.01}
    snaps = spark.createDataFrame([((t, 1, 5), ms(D0 + dt.timedelta(hours=2)), "P", {"A": 0.5}),
                                   ((t, 0, 5), ms(D0 + dt.timedelta(hours=2)), "P", {"A": 0.2})], snap_t)
    rets = spark.createDataFrame([("P", "A", D0 + dt.timedelta(hours=h), 0.02) for h in (1, 3)], RET_T)
    applied = st.apply_to_seed(rets, seed)
    cand = mt.metrics_asof(applied, st.ew_series(applied, seed, RiskParams()), seed, snaps, RiskParams())
    rows = sorted(cand.collect(), key=lambda r: (r["o_ts"], r["o_side"], r["o_seq"], r["o_tie"]))
    assert [round(r["expected_return"] / 0.01) if r["o_side"] == 9 else r["o_side"] for r in rows] == [2, 2, 1]
    assert rows[0]["expected_return"] < rows[1]["expected_return"]      # 0.2 before 0.5
    assert rows[2]["expected_return"] > 2 * rows[0]["expected_return"]  # 0.5 is current


def test_seeds_before_all_returns(spark):
    seed = spark.createDataFrame([(1, ms(D0 + dt.timedelta(days=1)), "P", {"A": 0.01}, {"A": {"A": 0.04}})], STATS_T)
    rets = spark.createDataFrame([("P", "A", D0, 0.02)], RET_T)
    assert st.apply_to_seed(rets, seed).count() == 0
    assert st.apply_to_seed(rets, seed, seed_time=False).count() == 1


def test_emit_a_b_a_and_repeat(spark):
    """Weights A, B, A, A after one applied return: three emitted, the
    repeat suppressed (FIXTURES: 'A, B, A' and 'repeat')."""
    seed = spark.createDataFrame(
        [(1, ms(D0), "P", {"X": 0.01, "Y": 0.02},
          {"X": {"X": 0.04, "Y": 0.01}, "Y": {"X": 0.01, "Y": 0.09}})], STATS_T)
    rets = spark.createDataFrame([("P", "X", D0 + dt.timedelta(hours=1), 0.02)], RET_T)
    wa, wb = {"X": 0.7, "Y": 0.3}, {"X": 0.2, "Y": 0.8}
    snaps = spark.createDataFrame(
        [(10 + k, ms(D0 + dt.timedelta(hours=2 + k)), "P", w) for k, w in enumerate([wa, wb, wa, wa])],
        SNAP_T)
    p = RiskParams()
    applied = st.apply_to_seed(rets, seed)
    cand = mt.metrics_asof(applied, st.ew_series(applied, seed, p), seed, snaps, p)
    em = sorted(r["o_seq"] for r in mt.emit_on_change(cand, p).collect())
    assert cand.count() == 4 and em == [10, 11, 12]


def test_pipeline_block_invariance(spark):
    """The whole batch job gives the same published metrics and statistics
    whatever the scan block sizes (hours, days, weeks)."""
    from tickrisk.plans import queries as Q
    sf = "/root/testdata/sf0.001"
    outs = []
    for blk, sblk in [(3600, 86400), (86400, 3 * 86400), (7 * 86400, 7 * 86400)]:
        j = Q.job(spark, sf, RiskParams(window="1 day", block_seconds=blk,
                                        series_block_seconds=sblk))
        em = sorted((r["portfolio_id"], r["o_ts"], r["o_side"], r["o_seq"], r["o_tie"],
                     round(r["expected_return"], 10), round(r["risk"], 10))
                    for r in j.emitted.collect())
        se = sorted((r["portfolio_id"], r["ticker"], r["n"], round(r["mean"], 12),
                     None if r["var"] is None else round(r["var"], 12))
                    for r in j.series.collect())
        outs.append((em, se))
    assert len(outs[0][0]) > 0 and outs[0] == outs[1] == outs[2]


def test_negative_variance_emitted_once(spark):
    """cov AA = -1, weight A = 1: risk and Sharpe NaN; a repeated snapshot
    is suppressed because NaN equals NaN (FIXTURES: 'negative variance')."""
    seed = spark.createDataFrame([(1, ms(D0), "P", {"A": 0.01}, {"A": {"A": -1.0}})], STATS_T)
    rets = spark.createDataFrame([("P", "B", D0 + dt.timedelta(hours=1), 0.02)], RET_T)
    snaps = spark.createDataFrame(
        [(10 + k, ms(D0 + dt.timedelta(hours=2 + k)), "P", {"A": 1.0}) for k in range(2)], SNAP_T)
    p = RiskParams()
    applied = st.apply_to_seed(rets, seed)
    cand = mt.metrics_asof(applied, st.ew_series(applied, seed, p), seed, snaps, p)
    rows = cand.collect()
    assert len(rows) == 2 and all(math.isnan(r["risk"]) and math.isnan(r["sharpe"]) for r in rows)
    assert mt.emit_on_change(cand, p).count() == 1
