"""Quadratic form of many triggers against plain sums over pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickrisk.operators import metrics as mt
from tickrisk.operators import quadratic
from tickrisk.params import RiskParams

SEED = ("timestamp long, portfolio_id string, meanReturns map<string,double>, "
        "covarianceMatrix map<string,map<string,double>>")
GRID = "portfolio_id string, seq long, ticker string, w double, mean double, var double, n long, g boolean"


def portfolio(rnd, name, size, triggers):
    """A seed with dead and unknown tickers and missing cells, and grid rows of several triggers."""
    tickers = [f"T{k}" for k in range(size)]
    means = {t: rnd.choice([0.0, 0.01, -0.02, 0.003]) for t in tickers if rnd.random() < .9}
    cov = {t: {} for t in tickers}
    for a in range(size):
        for b in range(a, size):
            if a == b or rnd.random() < .8:
                cov[tickers[a]][tickers[b]] = cov[tickers[b]][tickers[a]] = rnd.choice([0.04, 0.001, -0.002, 0.0])
    grid = []
    for seq in range(triggers):
        for t in rnd.sample(tickers + ["unknown"], rnd.randint(1, size + 1)):
            live = None if t not in means else means[t] != 0
            grid.append((name, seq, t, rnd.choice([0.5, -0.1, 1.0, 0.0]), means.get(t), cov.get(t, {}).get(t),
                         rnd.choice([0, 1, 7, 400]), live))
    return (0, name, means, cov), grid


def plain(seed, rows, q):
    cov, expected, variance = seed[3], 0.0, 0.0
    for _, _, i, wi, mean, var, ni, gi in rows:
        expected += wi * (mean or 0.0)
        for _, _, j, wj, _, _, nj, gj in rows:
            if i == j:
                variance += wi * wi * (var or 0.0)
            else:
                variance += wi * wj * cov.get(i, {}).get(j, 0.0) * q ** (ni * bool(gj) + nj * bool(gi))
    return expected, variance


@pytest.mark.parametrize("entries", [1 << 20, 9])
def test_equals_sums_over_pairs(spark, entries):
    rnd, seeds, grid = random.Random(5), [], []
    for k, size in enumerate([1, 2, 5, 12]):
        seed, rows = portfolio(rnd, f"p{k}", size, 6)
        seeds.append(seed)
        grid += rows
    grid += [("no seed", 1, "T0", 0.5, None, None, 0, None)]
    params = RiskParams()
    out = quadratic.trigger_metrics(spark.createDataFrame(grid, GRID), spark.createDataFrame(seeds, SEED),
                                    ["portfolio_id", "seq"], params.decay, entries).collect()
    got = {(r["portfolio_id"], r["seq"]): (r["expected_return"], r["variance"]) for r in out}
    by_name = {s[1]: s for s in seeds} | {"no seed": (0, "no seed", {}, {})}
    assert set(got) == {r[:2] for r in grid}
    for key, found in got.items():
        exp = plain(by_name[key[0]], [r for r in grid if r[:2] == key], params.decay)
        assert np.allclose(found, exp, rtol=1e-12, atol=1e-15), key


def test_equal_states_give_equal_bits(spark):
    """The same state under other keys, in other blocks and with rows in another order."""
    rnd = random.Random(6)
    seed, rows = portfolio(rnd, "p", 40, 1)
    grid = []
    for seq in range(200):
        again = [(r[0], seq, *r[2:]) for r in rows]
        rnd.shuffle(again)
        grid += again
    out = quadratic.trigger_metrics(spark.createDataFrame(grid, GRID).repartition(5), spark.createDataFrame([seed], SEED),
                                    ["portfolio_id", "seq"], RiskParams().decay, entries=300)
    assert out.count() == 200 and out.select("expected_return", "variance").distinct().count() == 1


def test_a_thousand_tickers(spark):
    """N = 1000: rows and memory of a trigger stay linear, the values are those of the dense form."""
    n, triggers = 1000, 20
    a = np.arange(n)
    dense = np.where(np.abs(a[:, None] - a[None, :]) < 40, 1.0 / (1 + np.abs(a[:, None] - a[None, :])), 0.0)
    tickers = [f"T{k:04d}" for k in range(n)]
    cov = {tickers[i]: {tickers[j]: float(dense[i, j]) for j in np.flatnonzero(dense[i])} for i in range(n)}
    seed = spark.createDataFrame([(0, "p", {t: 0.1 for t in tickers}, cov)], SEED)
    grid = (spark.range(triggers * n).select(
        F.lit("p").alias("portfolio_id"), F.floor(F.col("id") / n).alias("seq"),
        F.format_string("T%04d", F.col("id") % n).alias("ticker"), F.lit(0.001).alias("w"), F.lit(0.1).alias("mean"),
        F.lit(1.0).alias("var"), F.floor(F.col("id") / n).alias("n"), F.lit(True).alias("g")))
    out = {r["seq"]: r for r in mt.metrics_from_grid(grid, seed, ["portfolio_id", "seq"], RiskParams()).collect()}
    q, off = RiskParams().decay, dense - np.diag(np.diag(dense))
    assert len(out) == triggers
    for seq, r in out.items():
        assert math.isclose(r["expected_return"], 0.1, rel_tol=1e-12)
        assert math.isclose(r["variance"], 1e-6 * (n + off.sum() * q ** (2 * seq)), rel_tol=1e-12)
