"""Batch form of the whole job: inputs -> returns -> statistics -> metrics.

``RiskJob`` wires the operators over four input tables (wire schemas):
price ticks, statistics records (seeds), weight snapshots and optional
holdings. Each property is built on first access: stages read several times
(seed, applied returns, series, grids, candidates, records) are materialised
then as parquet under the checkpoint folder, the rest stay lazy. Statistics use
the closed form; portfolios that it does not cover (``stats.uncovered_portfolios``) are
folded record by record (``operators.exact``), so every input gets the step rule's
result. Malformed rows raise, or with ``strict=False`` are split off before the
windows and kept in ``bad_ticks``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickrisk.operators import exact
from tickrisk.operators import metrics as mt
from tickrisk.operators import stats as st
from tickrisk.operators import ticks as tk
from tickrisk.params import RiskParams
from tickrisk.plans.materialize import materialize


@dataclass
class RiskJob:
    ticks_raw: DataFrame
    stats_records: DataFrame
    weight_snapshots: DataFrame
    holdings: DataFrame | None = None
    params: RiskParams = RiskParams()
    portfolio_id: str = "portf1"
    strict: bool = True
    materialize: str = "parquet"
    # True: a seed arrives at its own time stamp; False: seeds are there before any return
    seed_time: bool = True

    @cached_property
    def _typed(self) -> DataFrame:
        return tk.typed_ticks(self.ticks_raw, strict=self.strict)

    @cached_property
    def ticks(self) -> DataFrame:
        return self._typed if self.strict else tk.quarantine_split(self._typed)[0]

    @cached_property
    def bad_ticks(self) -> DataFrame:
        """Ticks that did not parse (``strict=False``)."""
        return tk.quarantine_split(self._typed)[1]

    @cached_property
    def returns(self) -> DataFrame:
        return tk.log_returns(self.ticks, window=self.params.window)

    @cached_property
    def portfolio_returns(self) -> DataFrame:
        r = self.returns.select("ticker", F.col("window_end").alias("order_ts"),
                                "return_value", "last_traded_ts")
        return tk.assign_portfolios(r, self.holdings, self.portfolio_id)

    @cached_property
    def seed(self) -> DataFrame:
        return materialize(st.first_seed(self.stats_records), "seed", self.materialize)

    @cached_property
    def applied(self) -> DataFrame:
        return materialize(st.apply_to_seed(self.portfolio_returns, self.seed, self.seed_time), "applied",
                           self.materialize)

    @cached_property
    def mean_series(self) -> DataFrame:
        """Closed form, all portfolios."""
        return materialize(st.ew_mean_series(self.applied, self.seed, self.params),
                           "mean_series", self.materialize)

    @cached_property
    def uncovered(self) -> DataFrame | None:
        """Portfolios outside the closed form; None if there are none."""
        found = materialize(st.uncovered_portfolios(self.applied, self.seed, self.mean_series),
                            "uncovered", self.materialize)
        return None if found.isEmpty() else found

    def _covered(self, df: DataFrame) -> DataFrame:
        return df if self.uncovered is None else df.join(self.uncovered, "portfolio_id", "left_anti")

    def _folded(self, records: bool = False) -> DataFrame:
        def only(df):
            return df.join(self.uncovered, "portfolio_id", "left_semi")
        return materialize(exact.fold_events(only(self.applied), only(self.seed), only(self.weight_snapshots),
                                             self.params, records), "events", self.materialize)

    @cached_property
    def _events(self) -> DataFrame:
        return self._folded()

    def _whole(self, closed: DataFrame, of) -> DataFrame:
        """Closed-form rows of the covered portfolios and folded rows of the others."""
        return closed if self.uncovered is None else closed.unionByName(of(self._events).select(*closed.columns))

    @cached_property
    def _closed_series(self) -> DataFrame:
        return materialize(st.ew_var_series(self._covered(self.mean_series), self._closed_seed, self.params),
                           "series", self.materialize)

    @cached_property
    def _closed_seed(self) -> DataFrame:
        return self._covered(self.seed)

    @cached_property
    def _closed_applied(self) -> DataFrame:
        return self._covered(self.applied)

    @cached_property
    def _closed_snapshots(self) -> DataFrame:
        return self._covered(self.weight_snapshots)

    @cached_property
    def series(self) -> DataFrame:
        return self._whole(self._closed_series, exact.series_of)

    @cached_property
    def offdiag(self) -> DataFrame:
        return self._whole(st.final_offdiag(self._closed_applied, self._closed_seed, self.params), exact.offdiag_of)

    @cached_property
    def final_state(self) -> DataFrame:
        """Closed form, covered portfolios."""
        return st.final_state(self._closed_applied, self._closed_seed, self._closed_series)

    @cached_property
    def weights(self) -> DataFrame:
        return mt.weights_long(self._closed_snapshots)

    @cached_property
    def vs_final(self) -> DataFrame:
        """Metrics of every weight snapshot against the final statistics."""
        grid = mt.state_grid(self.weights, self.final_state, self._closed_seed)
        g = mt.partition_by_trigger(grid, ["portfolio_id", "seq"])
        try:
            closed = materialize(mt.metrics_from_grid(g, self._closed_seed, ["portfolio_id", "seq"], self.params),
                                 "vs_final", self.materialize)
        finally:
            g.unpersist()
        return self._whole(closed, lambda e: exact.final_metrics(e, self.weight_snapshots, self.params))

    @cached_property
    def grid(self) -> DataFrame:
        return materialize(mt.trigger_grid(self._closed_applied, self._closed_series, self._closed_seed,
                                           self._closed_snapshots, self.params),
                           "grid", self.materialize)

    @cached_property
    def records(self) -> DataFrame:
        """K1 batch twin: the whole statistics record after each applied return."""
        g = mt.partition_by_trigger(mt.record_grid(self._closed_applied, self._closed_series, self._closed_seed,
                                                   self.params))
        try:
            closed = materialize(mt.statistics_records(g, self._closed_seed, self.params),
                                 "stats_records", self.materialize)
        finally:
            g.unpersist()
        if self.uncovered is None:
            return closed
        return closed.unionByName(exact.records_of(self._folded(records=True)).select(*closed.columns))

    @cached_property
    def candidates(self) -> DataFrame:
        g = mt.partition_by_trigger(self.grid)
        try:
            closed = materialize(mt.risk_from_grid(g, self._closed_seed, self.params),
                                 "candidates", self.materialize)
        finally:
            g.unpersist()
        return self._whole(closed, exact.candidates_of)

    @cached_property
    def emitted(self) -> DataFrame:
        return mt.emit_on_change(self.candidates, self.params)
