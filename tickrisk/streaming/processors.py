"""Keyed stateful processors for ``transformWithStateInPandas``.

Record mode: two processors keyed by ``portfolio_id``; their state lives in the
state store (RocksDB provider). Within a micro-batch the rows of a key are
sorted by the order key ``(o_ts, o_side, o_seq, o_tie)`` before folding, so
a batch that holds the whole input gives the batch results exactly; across
micro-batches the order is arrival. A key's rows may be many more than a worker holds:
they are sorted in runs of bounded size that lie in a temporary file (``_in_order``).

``StatsUpdateProcessor`` (J1, A4-A6, T4, T6): seeds (first wins; from
``initialState`` or ``kind='seed'`` rows) and returns (``kind='ret'``). A
return of a portfolio without a seed is dropped; every other return updates
means and covariances with the original per-record rule and emits the whole
statistics record. What counts is that the seed has arrived, not its stamp: a seed given
as initial state is there before any return. A replay that knows no arrival order
can ask for the seed's time to count instead (``seed_time=True``).

``MetricsProcessor`` (J2, W1, T5, T6): updated statistics records
(``kind='stats'``) and weight snapshots (``kind='weights'``), each last write
wins; once both exist every input computes E, risk and Sharpe, emitted only
when ``(E, risk)`` differs from the last emitted pair (Java ``Double.equals``:
NaN equals NaN, 0.0 differs from -0.0).

State is loaded into dicts once per key and batch, folded in Python, and the
changed entries written back; results leave in pieces of bounded size. NaN doubles become NULL on the way from pandas
to Arrow; the record fields are never NULL, so ``topology`` restores NaN
right after each processor (``restore_nan``).

Factored mode: ``TickerStatsProcessor`` keyed by ``(portfolio_id, ticker)``
keeps ``(n, mean, var)`` per key; off-diagonal cells follow from the counts.
"""

from __future__ import annotations

import heapq
import itertools
import math
import pickle
import sys
import tempfile
from collections import namedtuple
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickrisk.functions.fold import apply_return, java_equals, portfolio_metrics
from tickrisk.operators.quadratic import OffDiagonal

# The processors run in Python workers that need not have this package
# installed: ship this module's classes and helpers by value in the task.
# (The module depends only on the standard library, pandas and pyspark.)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER = ["o_ts", "o_side", "o_seq", "o_tie"]

STATS_OUT = ("portfolio_id string, o_ts timestamp, ticker string, n long, timestamp long, "
             "meanReturns map<string,double>, covarianceMatrix map<string,map<string,double>>")
METRICS_OUT = ("portfolio_id string, o_ts timestamp, o_side int, o_seq long, o_tie string, "
               "expected_return double, variance double, risk double, sharpe double")

METRICS_COLUMNS = ["portfolio_id", *ORDER, "expected_return", "variance", "risk", "sharpe"]


def _ms(ts) -> int:
    return int(pd.Timestamp(ts).value // 1_000_000)


# emitted rows held at once: whole statistics records, and flat rows
RECORDS_AT_ONCE, ROWS_AT_ONCE = 64, 10_000


# bytes (pickled) of a run of sorted rows, and pieces in which it is read back
RUN_BYTES, RUN_PIECES = 8 << 20, 64


def _size(part: pd.DataFrame) -> float:
    """Bytes of a part as pickled, from every n-th of its rows."""
    some = part.iloc[::max(1, len(part) // 16)]
    return len(pickle.dumps(list(some.itertuples(index=False, name=None)))) * len(part) / len(some)


def _sorted(parts: list[pd.DataFrame], by: list[str]) -> pd.DataFrame:
    return pd.concat(parts, ignore_index=True).sort_values(by, kind="mergesort")


def _order_keys(part: pd.DataFrame, by: list[str]) -> list[tuple]:
    """What the rows of a part compare by; nulls come last, as in ``_sorted``."""
    keys = []
    for c in by:
        values = part[c]
        if pd.api.types.is_datetime64_dtype(values.dtype):
            values = values.astype("datetime64[ns]")
        keys.append([(True, None) if null else (False, v) for null, v in zip(values.isna(), values.tolist())])
    return list(zip(*keys))


def _write_run(file, run: pd.DataFrame, by: list[str]) -> list[int]:
    """Stores a sorted run, each row with its order key; returns where its pieces begin."""
    begins, step = [], -(-len(run) // RUN_PIECES)
    file.seek(0, 2)
    for a in range(0, len(run), step):
        begins.append(file.tell())
        piece = run.iloc[a:a + step]
        pickle.dump(list(zip(_order_keys(piece, by), piece.itertuples(index=False, name=None))), file, -1)
    return begins


def _read_run(file, begins: list[int]) -> Iterator[tuple]:
    for at in begins:
        file.seek(at)
        yield from pickle.load(file)


def _in_order(rows: Iterator[pd.DataFrame], by: list[str]) -> Iterator[tuple]:
    """The rows of a key as named tuples, sorted by ``by`` (equal ones as they arrived).

    No more than a run of ``RUN_BYTES`` is held at once: longer input goes run by run to a
    temporary file and is merged while the runs are read back piece by piece.
    """
    held, size, runs = [], 0, []
    with tempfile.TemporaryFile() as file:
        for part in rows:
            if not len(part):
                continue
            held.append(part)
            size += _size(part)
            columns = part.columns
            del part
            if size >= RUN_BYTES:
                runs.append(_write_run(file, _sorted(held, by), by))
                held, size = [], 0
        if not runs:
            if held:
                yield from _sorted(held, by).itertuples(index=False)
            return
        if held:
            runs.append(_write_run(file, _sorted(held, by), by))
            held = []
        row = namedtuple("Row", columns)._make
        for _, values in heapq.merge(*(_read_run(file, run) for run in runs), key=itemgetter(0)):
            yield row(values)


def _sync_map(state, old: dict, new: dict) -> None:
    """Write only the entries of a MapState that changed (keys are tuples)."""
    for k in old.keys() - new.keys():
        state.removeKey(k)
    for k, v in new.items():
        if k not in old or not java_equals(old[k], v):
            state.updateValue(k, (float(v),))


class StatsUpdateProcessor(StatefulProcessor):
    def __init__(self, count: int = 1000, stamp: str = "event", seed_time: bool = False):
        self.n_div = count + 1
        self.stamp = stamp
        self.seed_time = seed_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seed = handle.getValueState("seed", "seed_ms long")
        self.means = handle.getMapState("means", "ticker string", "mean double")
        self.cov = handle.getMapState("cov", "i string, j string", "cov double")
        self.counts = handle.getMapState("counts", "ticker string", "n long")

    # -- state helpers -------------------------------------------------------
    def _store_seed(self, seed_ms: int, means: dict, cov: dict) -> None:
        self.seed.update((int(seed_ms),))
        for t, m in (means or {}).items():
            self.means.updateValue((t,), (float(m),))
        for i, row in (cov or {}).items():
            for j, c in (row or {}).items():
                self.cov.updateValue((i, j), (float(c),))

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        if self.seed.exists():
            return
        first = initialState.iloc[0]             # one record: the topology picks the first
        self._store_seed(first["timestamp"], first["meanReturns"], first["covarianceMatrix"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        seed_ms = self.seed.get()[0] if self.seed.exists() else None
        means = {k[0]: v[0] for k, v in self.means.iterator()} if seed_ms is not None else {}
        cov: dict = {}
        if seed_ms is not None:
            for (i, j), (c,) in self.cov.iterator():
                cov.setdefault(i, {})[j] = c
        counts = {k[0]: v[0] for k, v in self.counts.iterator()}
        dirty_m, dirty_c, dirty_n = set(), set(), set()
        out = []
        n_div = self.n_div
        columns = ["portfolio_id", "o_ts", "ticker", "n", "timestamp", "meanReturns", "covarianceMatrix"]
        for r in _in_order(rows, ORDER):
            if r.kind == "seed":
                if seed_ms is None:
                    seed_ms = int(r.timestamp)
                    means = dict(r.meanReturns or {})
                    cov = {i: dict(row or {}) for i, row in (r.covarianceMatrix or {}).items()}
                    dirty_m |= set(means)
                    dirty_c |= {(i, j) for i, row in cov.items() for j in row}
                    self.seed.update((seed_ms,))
                continue
            if seed_ms is None or (self.seed_time and _ms(r.o_ts) < seed_ms):
                continue                          # no statistics yet: dropped
            s, ret = r.ticker, float(r.return_value)
            dirty_c |= apply_return(means, cov, s, ret, n_div)
            if s in means:
                dirty_m.add(s)
            counts[s] = counts.get(s, 0) + 1
            dirty_n.add(s)
            stamp = (_ms(pd.Timestamp.now(tz="UTC")) if self.stamp == "processing"
                     else _ms(r.o_ts))
            out.append((key[0], r.o_ts, s, counts[s], stamp, dict(means),
                        {i: dict(row) for i, row in cov.items()}))
            if len(out) >= RECORDS_AT_ONCE:
                yield pd.DataFrame(out, columns=columns)
                out = []
        for t in dirty_m:
            self.means.updateValue((t,), (float(means[t]),))
        for i, j in dirty_c:
            self.cov.updateValue((i, j), (float(cov[i][j]),))
        for t in dirty_n:
            self.counts.updateValue((t,), (int(counts[t]),))
        if out:
            yield pd.DataFrame(out, columns=columns)

    def close(self) -> None:
        pass


class MetricsProcessor(StatefulProcessor):
    def __init__(self, periods: int = 52, risk_free: float = 0.0018):
        self.periods = periods
        self.risk_free = risk_free

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.s_mean = handle.getMapState("s_mean", "ticker string", "mean double")
        self.s_cov = handle.getMapState("s_cov", "i string, j string", "cov double")
        self.has_stats = handle.getValueState("has_stats", "flag boolean")
        self.weights = handle.getMapState("weights", "ticker string", "w double")
        self.has_weights = handle.getValueState("has_weights", "flag boolean")
        self.last = handle.getValueState("last", "e double, risk double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        has_s = self.has_stats.exists()
        has_w = self.has_weights.exists()
        means = {k[0]: v[0] for k, v in self.s_mean.iterator()} if has_s else {}
        cov: dict = {}
        if has_s:
            for (i, j), (c,) in self.s_cov.iterator():
                cov.setdefault(i, {})[j] = c
        weights = {k[0]: v[0] for k, v in self.weights.iterator()} if has_w else {}
        means0 = {(t,): m for t, m in means.items()}
        cov0 = {(i, j): c for i, row in cov.items() for j, c in row.items()}
        weights0 = {(t,): w for t, w in weights.items()}
        last = self.last.get() if self.last.exists() else None
        s_changed = w_changed = False
        out = []
        for r in _in_order(rows, ORDER):
            if r.kind == "stats":
                means = dict(r.meanReturns or {})
                cov = {i: dict(row or {}) for i, row in (r.covarianceMatrix or {}).items()}
                has_s = s_changed = True
            elif r.kind == "weights":
                weights = {t: w for t, w in (r.weights or {}).items() if w is not None}
                has_w = w_changed = True
            if not (has_s and has_w):
                continue
            e, var, risk, sharpe = portfolio_metrics(weights, means, cov, self.periods,
                                                     self.risk_free)
            if last is not None and java_equals(last[0], e) and java_equals(last[1], risk):
                continue
            last = (e, risk)
            out.append((key[0], r.o_ts, int(r.o_side), int(r.o_seq), r.o_tie, e, var, risk, sharpe))
            if len(out) >= ROWS_AT_ONCE:
                yield pd.DataFrame(out, columns=METRICS_COLUMNS)
                out = []
        if s_changed:
            _sync_map(self.s_mean, means0, {(t,): m for t, m in means.items()})
            _sync_map(self.s_cov, cov0, {(i, j): c for i, row in cov.items()
                                         for j, c in row.items()})
            self.has_stats.update((True,))
        if w_changed:
            _sync_map(self.weights, weights0, {(t,): w for t, w in weights.items()})
            self.has_weights.update((True,))
        if last is not None:
            self.last.update((float(last[0]), float(last[1])))
        if out:
            yield pd.DataFrame(out, columns=METRICS_COLUMNS)

    def close(self) -> None:
        pass


TICKER_STATS_OUT = ("portfolio_id string, ticker string, o_ts timestamp, n long, "
                    "return_value double, has_mean boolean, mean double, "
                    "has_var boolean, var double")


class UnfactoredInput(ValueError):
    """Input whose statistics the factored mode cannot derive; the record mode can."""


class TickerStatsProcessor(StatefulProcessor):
    """Factored mode of the statistics update, keyed by ``(portfolio_id, ticker)``.

    Mean and diagonal covariance of a ticker depend only on its own returns,
    so the state of one key is ``(seed_ms, n, mean, var)`` and each return
    costs O(1); a hot portfolio is spread over its tickers' keys. The
    per-record rule is applied as is (same arithmetic): the mean is stored
    only for a non-zero old mean, the diagonal is updated only for a non-zero
    new mean and non-zero cell. Off-diagonal cells follow from the tick
    counts ``n`` (``stats.decay_exponent``). A ticker that its portfolio's seed does
    not name has no cell to update; its returns are counted and emitted, since they
    trigger metrics like any other. Rows carry ``seed_ms`` of their portfolio (the
    topology drops those of portfolios without a seed). Emits one row per applied return.
    """

    def __init__(self, count: int = 1000, seed_time: bool = False):
        self.n_div = count + 1
        self.seed_time = seed_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState(
            "ticker_state", "n long, has_mean boolean, mean double, has_var boolean, var double")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        if self.state.exists():
            return
        r = initialState.iloc[0]
        has_m = not pd.isna(r["mean0"])
        has_v = not pd.isna(r["var0"])
        self.state.update((0, has_m, float(r["mean0"]) if has_m else 0.0,
                           has_v, float(r["var0"]) if has_v else 0.0))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, has_m, m, has_v, c = self.state.get() if self.state.exists() else (0, False, 0.0, False, 0.0)
        out = []
        columns = ["portfolio_id", "ticker", "o_ts", "n", "return_value", "has_mean", "mean", "has_var", "var"]
        for r in _in_order(rows, ["o_ts"]):
            if self.seed_time and _ms(r.o_ts) < r.seed_ms:
                continue
            ret = float(r.return_value)
            if not math.isfinite(ret):
                raise UnfactoredInput(f"a return of {key[1]} in portfolio {key[0]} is {ret}: use mode='record'")
            old = m if has_m else 0.0
            new = old + (ret - old) / self.n_div
            if old != 0.0:
                m = new
            mo = m if has_m else 0.0
            if has_v and mo != 0.0 and c != 0.0:
                c = c + ((ret - old) * (ret - mo) - c) / self.n_div
            n += 1
            out.append((key[0], key[1], r.o_ts, n, ret, has_m, m if has_m else None,
                        has_v, c if has_v else None))
            if len(out) >= ROWS_AT_ONCE:
                yield pd.DataFrame(out, columns=columns)
                out = []
        if n:
            self.state.update((n, has_m, m, has_v, c))
        if out:
            yield pd.DataFrame(out, columns=columns)

    def close(self) -> None:
        pass


class FactoredMetricsProcessor(StatefulProcessor):
    """Factored mode of the metrics connect, keyed by ``portfolio_id``.

    State: the seed as one dense matrix with its tickers and means (from a row ``kind='seed'``
    that comes before all others, written once, read as one value), per-ticker ``(n, mean, var)`` from the factored
    series stream, the latest weights and the last emitted pair. A series row
    (an applied return) or a weight snapshot triggers; the variance is the quadratic form of
    ``operators.quadratic``: one product of the matrix with a vector a trigger, none where
    the updated ticker has no weight (the pair is unchanged then). Only the changed ticker
    entries are written back.

    Same assumptions as the closed form: a symmetric seed, finite returns, no mean that
    becomes exactly 0 mid-stream. Input that breaks one raises ``UnfactoredInput``; the record
    mode has none of them. A return of a ticker absent from the seed changes no statistic but
    triggers like any other.
    """

    def __init__(self, count: int = 1000, periods: int = 52, risk_free: float = 0.0018):
        self.q = count / (count + 1)
        self.periods = periods
        self.risk_free = risk_free

    def init(self, handle: StatefulProcessorHandle) -> None:
        # tickers joined by NUL; cells and means as 8-byte floats, NaN where the seed has no mean
        self.seed = handle.getValueState("seed", "names string, cells binary, means binary")
        self.tick = handle.getMapState(
            "tick", "ticker string",
            "n long, has_mean boolean, mean double, has_var boolean, var double")
        self.weights = handle.getMapState("weights", "ticker string", "w double")
        self.flags = handle.getValueState("flags", "has_stats boolean, has_weights boolean")
        self.last = handle.getValueState("last", "e double, risk double")

    def _store_seed(self, key, means: dict | None, cov: dict | None) -> None:
        means, cov = dict(means or {}), cov or {}
        names = sorted({*means, *cov, *(j for row in cov.values() for j in (row or {}))})
        number = {t: k for k, t in enumerate(names)}
        cells = np.zeros((len(names), len(names)))
        for i, row in cov.items():
            for j, c in (row or {}).items():
                cells[number[i], number[j]] = c
        if not np.array_equal(cells, cells.T):
            raise UnfactoredInput(f"the seed of portfolio {key[0]} is asymmetric or not a number: use mode='record'")
        self.seed.update(("\0".join(names), cells.tobytes(),
                          np.array([means.get(t, np.nan) for t in names], float).tobytes()))

    def _form(self):
        """Tickers, their seed means (NaN: none), seed variances and the form of the other cells."""
        if not self.seed.exists():
            return {}, np.zeros(0), np.zeros(0), None
        names, cells, means = self.seed.get()
        number = {t: k for k, t in enumerate(names.split("\0"))} if names else {}
        matrix = np.frombuffer(cells).reshape(len(number), len(number)).copy()
        var0 = np.diag(matrix).copy()
        np.fill_diagonal(matrix, 0.0)
        mean0 = np.frombuffer(means)
        return number, mean0, var0, OffDiagonal(matrix, ~np.isnan(mean0) & (mean0 != 0.0))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        ordered = _in_order(rows, ORDER)
        first = next(ordered, None)
        while first is not None and first.kind == "seed":          # before all others
            if not self.seed.exists():
                self._store_seed(key, first.meanReturns, first.covarianceMatrix)
            first = next(ordered, None)
        has_s, has_w = self.flags.get() if self.flags.exists() else (False, False)
        number, mean0, var0, form = self._form()
        tick = {k[0]: v for k, v in self.tick.iterator()}
        weights = {k[0]: v[0] for k, v in self.weights.iterator()} if has_w else {}
        weights_before = dict(weights)
        last = self.last.get() if self.last.exists() else None
        # the state as vectors over the seed's tickers
        n, mean, var = np.zeros(len(number)), np.nan_to_num(mean0, nan=0.0), var0
        w = np.zeros(len(number))

        def place(ticker):
            k = number.get(ticker)
            if k is None:
                return
            n[k], has_mean, m, has_var, c = tick[ticker]
            if has_mean:
                mean[k] = m
            if has_var:
                var[k] = c

        def weigh():
            w[:] = [weights.get(t, 0.0) for t in number]

        for t in tick:
            place(t)
        weigh()
        changed, fresh = set(), last is None
        out = []
        for r in itertools.chain([] if first is None else [first], ordered):
            if r.kind == "series":
                hm, hv = bool(r.has_mean), bool(r.has_var)
                k = number.get(r.ticker)
                if hm and (not np.isfinite(r.mean) or (k is not None and form.alive[k] and r.mean == 0.0)):
                    raise UnfactoredInput(f"the mean of {r.ticker} in portfolio {key[0]} became {r.mean}: use mode='record'")
                tick[r.ticker] = (int(r.n), hm, float(r.mean) if hm else 0.0,
                                  hv, float(r.var) if hv else 0.0)
                place(r.ticker)
                changed.add(r.ticker)
                has_s = True
                same = not fresh and not weights.get(r.ticker)
            else:
                weights = {t: x for t, x in (r.weights or {}).items() if x is not None}
                weigh()
                has_w, same = True, False
            if not (has_s and has_w):
                continue
            if same:
                continue                          # a ticker without weight: the pair stays as it was
            fresh = False
            y = w * np.power(self.q, n)
            e = float(np.sort(w * mean).sum())
            v = float(np.sort(w * w * var).sum())
            if form is not None:
                v += float(form(np.where(form.alive, y, w), np.where(form.alive, w, y)))
            with np.errstate(all="ignore"):
                risk = float(np.sqrt(v))
                sharpe = float(np.float64(math.sqrt(self.periods) * (e - self.risk_free)) / risk)
            if last is not None and java_equals(last[0], e) and java_equals(last[1], risk):
                continue
            last = (e, risk)
            out.append((key[0], r.o_ts, int(r.o_side), int(r.o_seq), r.o_tie, e, v, risk, sharpe))
            if len(out) >= ROWS_AT_ONCE:
                yield pd.DataFrame(out, columns=METRICS_COLUMNS)
                out = []
        for t in changed:
            self.tick.updateValue((t,), tick[t])
        if weights != weights_before:
            _sync_map(self.weights, {(t,): w for t, w in weights_before.items()},
                      {(t,): w for t, w in weights.items()})
        self.flags.update((has_s, has_w))
        if last is not None:
            self.last.update((float(last[0]), float(last[1])))
        if out:
            yield pd.DataFrame(out, columns=METRICS_COLUMNS)

    def close(self) -> None:
        pass


SNAPSHOTS_OUT = "seq long, timestamp long, portfolio_id string, weights map<string,double>, late boolean"
SNAPSHOT_COLUMNS = ["seq", "timestamp", "portfolio_id", "weights", "late"]


class WeightRowsProcessor(StatefulProcessor):
    """A7 on a stream of weight rows, keyed by ``portfolio_id``: one snapshot per time.

    The rows of a time are gathered in state (one weight per ticker, the one that arrived
    last) and emitted as one map once a row of a later time has come, or by a timer ``wait_ms`` after the
    portfolio's last row, so that a quiet portfolio's newest snapshot is not held back. Rows of a
    time that has been emitted come out as a snapshot of their own, marked ``late``: it
    holds those rows only, and none is lost. State is bounded by the rows of the pending times. A micro-batch is
    read in the order of its times, so a worker holds the rows of the pending times besides a run of sorted rows.
    """

    def __init__(self, wait_ms: int = 2000):
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getMapState("pending", "time_ms long, ticker string", "weight double, seq long")
        self.told = handle.getValueState("told", "time_ms long")
        self.due = handle.getValueState("due", "at long")

    def _waiting(self) -> dict:
        """Rows in state: time -> ticker -> (weight, seq)."""
        waiting: dict = {}
        for (time_ms, ticker), value in self.pending.iterator():
            waiting.setdefault(time_ms, {})[ticker] = value
        return waiting

    @staticmethod
    def _snapshot(key, time_ms: int, rows: dict, told: int | None) -> tuple:
        return (max(seq for _, seq in rows.values()), time_ms, key[0], {t: w for t, (w, _) in rows.items()},
                told is not None and time_ms <= told)

    def _leave(self, gone: dict, told: int | None, newest: int) -> None:
        """``gone``: the rows in state that have been emitted; ``newest``: the latest emitted time."""
        for time_ms, rows in gone.items():
            for ticker in rows:
                self.pending.removeKey((time_ms, ticker))
        if told is None or newest > told:
            self.told.update((newest,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        told = self.told.get()[0] if self.told.exists() else None
        waiting, out, done = self._waiting(), [], None
        stored = {time_ms: list(held) for time_ms, held in waiting.items()}
        now = None
        for r in _in_order(rows, ["time_ms"]):      # equal times as they arrived
            if r.time_ms != now:
                # rows of a later time: the earlier ones are whole
                now = int(r.time_ms)
                for time_ms in sorted(t for t in waiting if t < now):
                    out.append(self._snapshot(key, time_ms, waiting.pop(time_ms), told))
                    done = time_ms
                if len(out) >= ROWS_AT_ONCE:
                    yield pd.DataFrame(out, columns=SNAPSHOT_COLUMNS)
                    out = []
            held = waiting.setdefault(now, {})
            if r.ticker not in held or held[r.ticker][1] <= r.seq:
                held[r.ticker] = (float(r.weight), int(r.seq))
        newest = max(waiting)
        for time_ms in sorted(waiting):
            # a time that was emitted has no later rows to wait for
            if time_ms < newest or (told is not None and newest <= told):
                out.append(self._snapshot(key, time_ms, waiting.pop(time_ms), told))
                done = time_ms
        if done is not None:
            self._leave({t: held for t, held in stored.items() if t not in waiting}, told, done)
        for time_ms, held in waiting.items():
            for ticker, value in held.items():
                self.pending.updateValue((time_ms, ticker), value)
        if self.wait_ms is not None and waiting:
            if self.due.exists():
                self.handle.deleteTimer(self.due.get()[0])
            at = timerValues.getCurrentProcessingTimeInMs() + self.wait_ms
            self.handle.registerTimer(at)
            self.due.update((at,))
        if out:
            yield pd.DataFrame(out, columns=SNAPSHOT_COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.due.clear()
        told = self.told.get()[0] if self.told.exists() else None
        waiting = self._waiting()
        if waiting:
            self._leave(waiting, told, max(waiting))
            yield pd.DataFrame([self._snapshot(key, t, waiting[t], told) for t in sorted(waiting)],
                               columns=SNAPSHOT_COLUMNS)

    def close(self) -> None:
        pass


# one row per closed window, and one per late tick
TICK_WINDOWS_OUT = ("ticker string, start_us long, end_us long, n_ticks long, first_open double, last_current double, "
                    "last_us long, o_seq long, o_tie string, late boolean")
WINDOW_COLUMNS = ["ticker", "start_us", "end_us", "n_ticks", "first_open", "last_current", "last_us", "o_seq", "o_tie",
                  "late"]


class TickWindowProcessor(StatefulProcessor):
    """A1/T1/T2 without a lost tick, keyed by (ticker, window start, window end in microseconds).

    State is the first and the last tick by arrival order and the count; batches of any size fold into it piece by
    piece. An event-time timer at the window's end emits one row and clears the state. A tick
    whose window the watermark has passed, and that no state waits for, comes out as a
    row of its own, marked ``late``: every tick is in exactly one row.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState(
            "held", "n long, first_seq long, first_tie string, first_open double, "
                    "last_seq long, last_tie string, last_current double, last_us long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        ticker, start_us, end_us = key[0], int(key[1]), int(key[2])
        end_ms = -(-end_us // 1000)
        held = tuple(self.held.get()) if self.held.exists() else None
        if held is None:
            if end_ms <= timerValues.getCurrentWatermarkInMs():
                for part in rows:
                    yield pd.DataFrame({
                        "ticker": ticker, "start_us": start_us, "end_us": end_us, "n_ticks": 1,
                        "first_open": part["opening_price"], "last_current": part["current_price"],
                        "last_us": part["event_us"], "o_seq": part["o_seq"], "o_tie": part["o_tie"],
                        "late": True})[WINDOW_COLUMNS]
                return
            self.handle.registerTimer(end_ms)
        for part in rows:
            if not len(part):
                continue
            part = part.sort_values(["o_seq", "o_tie"], kind="mergesort")
            a, b = part.iloc[0], part.iloc[-1]
            first = (int(a["o_seq"]), a["o_tie"], float(a["opening_price"]))
            last = (int(b["o_seq"]), b["o_tie"], float(b["current_price"]), int(b["event_us"]))
            if held is None:
                held = (len(part), *first, *last)
            else:
                held = (held[0] + len(part), *(first if first[:2] < held[1:3] else held[1:4]),
                        *(last if last[:2] > held[4:6] else held[4:8]))
        if held is not None:
            self.held.update(held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        n, _, _, first_open, last_seq, last_tie, last_current, last_us = self.held.get()
        self.held.clear()
        yield pd.DataFrame([(key[0], int(key[1]), int(key[2]), n, first_open, last_current, last_us, last_seq, last_tie,
                             False)], columns=WINDOW_COLUMNS)

    def close(self) -> None:
        pass
