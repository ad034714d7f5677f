"""
and matrices, one event at a time.

A portfolio's statistics are a vector of means and a covariance matrix over all tickers
of the case, each with a mask of what exists; a return replaces one mean and one masked
row and column; metrics are ``w @ m`` and ``w @ C @ w`` over the weighted tickers.

Events are dicts processed in list order:
``{"kind": "seed", "p", "means": {..}, "cov": {i: {j: c}}}``,
``{"kind": "ret", "p", "ticker", "r", "key"}``,
``{"kind": "weights", "p", "weights": {..}, "key"}``.
"""

from __future__ import annotations

import numpy as np

GAIN = 1 / 1001


class Statistics:
    def __init__(self, tickers, means, cov, gain=GAIN):
        self.at = {t: k for k, t in enumerate(tickers)}
        n, self.gain = len(tickers), gain
        self.mean, self.known = np.zeros(n), np.zeros(n, bool)
        self.cov, self.has = np.zeros((n, n)), np.zeros((n, n), bool)
        for t, v in means.items():
            self.mean[self.at[t]], self.known[self.at[t]] = v, True
        for i, row in cov.items():
            for j, v in row.items():
                self.cov[self.at[i], self.at[j]], self.has[self.at[i], self.at[j]] = v, True

    def observe(self, ticker, r):
        k = self.at[ticker]
        with np.errstate(invalid="ignore", over="ignore"):
            step = r - self.mean[k]
            if self.mean[k] != 0:                              # clause b2: a zero mean stays
                self.mean[k] += self.gain * step
            deviation = self.mean - self.mean                  # 0, or NaN where a mean is infinite
            deviation[k] = r - self.mean[k]
            mask = self.has[k] & (self.cov[k] != 0) & self.known & (self.mean != 0)
            row = self.cov[k] + self.gain * (step * deviation - self.cov[k])
        self.cov[k, mask] = self.cov[mask, k] = row[mask]
        self.has[k, mask] = self.has[mask, k] = True

    def maps(self):
        names = list(self.at)
        means = {t: float(self.mean[k]) for t, k in self.at.items() if self.known[k]}
        cov = {i: {names[l]: float(self.cov[k, l]) for l in np.flatnonzero(self.has[k])}
               for i, k in self.at.items() if self.has[k].any()}
        return means, cov

    def metrics(self, weights, periods=52, risk_free=0.0018):
        k = np.array([self.at[t] for t in weights], int)
        w = np.array(list(weights.values()), float)
        with np.errstate(invalid="ignore", divide="ignore"):
            e = np.float64(w @ self.mean[k]) if len(k) else np.float64(0)
            var = np.float64(w @ self.cov[np.ix_(k, k)] @ w) if len(k) else np.float64(0)
            risk = np.sqrt(var)
            return float(e), float(var), float(risk), float(np.sqrt(periods) * (e - risk_free) / risk)


def metrics(weights, means, cov, periods=52, rf=0.0018):
    tickers = {*weights, *means, *cov, *(j for row in cov.values() for j in row)}
    return Statistics(sorted(tickers), means, cov).metrics(weights, periods, rf)


def fold(events: list[dict], count: int = 1000):
    tickers = set()
    for ev in events:
        tickers |= {*ev.get("means", ()), *ev.get("cov", ()), *ev.get("weights", ())}
        tickers |= {j for row in ev.get("cov", {}).values() for j in row}
        tickers |= {ev["ticker"]} if "ticker" in ev else set()
    tickers = sorted(tickers)
    stats, updated, weights, last = {}, set(), {}, {}
    out = {"stats": [], "candidates": [], "emitted": []}
    for ev in events:
        p = ev["p"]
        if ev["kind"] == "seed":
            if p not in stats:                                 # clause b7: the first one wins
                stats[p] = Statistics(tickers, ev["means"], ev["cov"], 1 / (count + 1))
            continue
        if ev["kind"] == "ret":
            if p not in stats:                                 # clause b1: dropped
                continue
            stats[p].observe(ev["ticker"], ev["r"])
            updated.add(p)
            out["stats"].append((p, ev["ticker"], ev["key"], stats[p].maps()))
        else:
            weights[p] = dict(ev["weights"])
        if p in updated and p in weights:                      # clause c: both sides exist
            m = stats[p].metrics(weights[p])
            out["candidates"].append((p, ev["key"]) + m)
            pair = np.array([m[0], m[2]])
            if p not in last or not np.array_equal(pair, last[p], equal_nan=True):
                out["emitted"].append((p, ev["key"]) + m)
            last[p] = pair
    out["final"] = {p: s.maps() for p, s in stats.items()}
    return out
