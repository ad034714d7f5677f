"""Expected return and variance of many triggers against one seed matrix.

With ``y = w * q**n`` the off-diagonal part of a trigger's variance is a quadratic form in the
portfolio's seed covariances, whatever the tick counts ``n``: a cell of two live tickers has
decayed by both counts (``y_i C_ij y_j``), one of a live and a dead ticker (mean 0, see
``stats.decay_exponent``) by the dead one's count (``w_i C_ij y_j``), one of two dead tickers not
at all. So a block of triggers meets the dense matrix once and each costs one product
of it with a vector; no pair rows and no array of the trigger's tickers in each of its rows.

Equal states give equal bits, which change detection needs: every trigger is multiplied on
its own (a product of the same shape each time), and sums run in ascending order of their terms.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickrisk.operators import stats as st
from tickrisk.operators.joins import join_small

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ENTRIES = 1 << 20                      # (trigger, ticker) entries of a block


def seed_matrix(ticker: pa.Array, cells: pa.ListArray) -> tuple[dict[str, int], np.ndarray]:
    """Number of each ticker, in order, and the dense matrix; missing cells and the diagonal are 0."""
    flat = cells.flatten()
    i_names, j_names = ticker.to_pylist(), flat.field("key").dictionary_encode()
    names = sorted({*i_names, *j_names.dictionary.to_pylist()})
    number = {name: k for k, name in enumerate(names)}
    i = np.repeat([number[x] for x in i_names], np.diff(cells.offsets.to_numpy()))
    j = np.array([number[x] for x in j_names.dictionary.to_pylist()], np.int64)[j_names.indices.to_numpy()]
    matrix = np.zeros((len(names), len(names)))
    matrix[i, j] = flat.field("value").fill_null(0.0).to_numpy(zero_copy_only=False)
    np.fill_diagonal(matrix, 0.0)
    return number, matrix


def sorted_sums(terms: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of each stretch of ``terms`` in ascending order of its terms; 0 for an empty one."""
    owner = np.repeat(np.arange(len(ends)), np.diff(np.r_[0, ends]))
    terms = terms[np.lexsort((terms, owner))]
    out = np.zeros(len(ends))
    some = np.flatnonzero(np.diff(np.r_[0, ends]))
    if len(some):
        out[some] = np.add.reduceat(terms, np.r_[0, ends[:-1]][some])
    return out


class OffDiagonal:
    """Quadratic form of the off-diagonal cells for tickers that are ``alive`` (mean not 0) or not."""

    def __init__(self, matrix: np.ndarray, alive: np.ndarray):
        self.alive = alive
        self.same = np.where(alive[:, None] == alive[None, :], matrix, 0.0)
        self.cross = None if alive.all() else matrix[np.ix_(alive, ~alive)]

    def __call__(self, by_class: np.ndarray, crossed: np.ndarray) -> float:
        """``by_class``: y of the living, w of the dead; ``crossed``: the other way round."""
        value = by_class @ (self.same @ by_class)
        if self.cross is not None:
            value += 2.0 * (crossed[self.alive] @ (self.cross @ crossed[~self.alive]))
        return value


def block_metrics(states: pa.ListArray, number: dict[str, int], matrix: np.ndarray, q: float) -> tuple[np.ndarray, np.ndarray]:
    """(expected return, variance) of triggers; ``states``: their (ticker, w, mean, var, n, g)."""
    flat = states.flatten()
    ends = np.cumsum(np.diff(states.offsets.to_numpy()))
    code = flat.field("ticker").dictionary_encode()
    at = np.array([number.get(x, -1) for x in code.dictionary.to_pylist()] or [-1], np.int64)[code.indices.to_numpy()]

    def values(name, missing):
        return flat.field(name).fill_null(missing).to_numpy(zero_copy_only=False)

    w, live = values("w", np.nan), values("g", False).astype(bool)
    # the one row of a snapshot without weights (``metrics.weights_long``)
    empty = np.array([x == "" for x in code.dictionary.to_pylist()] or [False])[code.indices.fill_null(0).to_numpy()]
    w = np.where(empty & np.isnan(w) & ~flat.field("w").is_valid().to_numpy(zero_copy_only=False), 0.0, w)
    y = w * np.power(q, values("n", 0).astype(float))
    expected = sorted_sums(w * values("mean", 0.0), ends)
    known = flat.field("var").is_valid().to_numpy(zero_copy_only=False)
    variance = sorted_sums(np.where(known, w * w * values("var", 0.0), 0.0), ends)

    alive = np.zeros(len(number), bool)
    alive[at[live & (at >= 0)]] = True
    form = OffDiagonal(matrix, alive)
    by_class, crossed = np.where(live, y, w), np.where(live, w, y)
    begin = 0
    for t, end in enumerate(ends.tolist()):
        inside = np.flatnonzero(at[begin:end] >= 0) + begin
        if len(inside):
            x, z = np.zeros(len(number)), np.zeros(len(number))
            x[at[inside]], z[at[inside]] = by_class[inside], crossed[inside]
            variance[t] += form(x, z)
        begin = end
    return expected, variance


def trigger_metrics(grid: DataFrame, seed: DataFrame, tkey: list[str], q: float, entries: int = ENTRIES) -> DataFrame:
    """``*tkey, expected_return, variance`` per trigger of ``grid`` (``*tkey, ticker, w, mean, var, n, g``).

    A portfolio's triggers are dealt over blocks of about ``entries`` grid rows by their hash; each block
    is one task's group and meets the portfolio's seed matrix, so a portfolio with a third of
    all triggers is spread over its blocks. A missing weight makes the trigger's sums NaN, but for that
    of the empty ticker: a snapshot without weights has sums of 0."""
    state = F.struct("ticker", F.col("w").cast("double").alias("w"), "mean", "var",
                     F.col("n").cast("long").alias("n"), F.col("g").alias("g"))
    each = grid.groupBy(*tkey).agg(F.collect_list(state).alias("states"))
    blocks = grid.groupBy("portfolio_id").agg(F.ceil(F.count("*") / entries).cast("int").alias("blocks"))
    dealt = join_small(each, blocks, on=["portfolio_id"]).withColumn(
        "block", F.pmod(F.xxhash64(*tkey), F.col("blocks")).cast("int")).drop("blocks")
    rows = st.seed_cov_rows(seed).select("portfolio_id", "ticker", F.map_entries("row").alias("cells"))
    placed = (join_small(rows, blocks, on=["portfolio_id"])
              .select("portfolio_id", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "ticker", "cells"))

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        number, matrix = {}, np.zeros((0, 0))
        if right.num_rows:
            right = right.combine_chunks()
            number, matrix = seed_matrix(right.column("ticker").chunk(0), right.column("cells").chunk(0))
        if left.num_rows:
            expected, variance = block_metrics(left.column("states").chunk(0), number, matrix, q)
        else:
            expected = variance = np.empty(0)
        out = left.select(tkey)
        return out.append_column("expected_return", pa.array(expected)).append_column("variance", pa.array(variance))

    schema = ", ".join(f"`{c}` {grid.schema[c].dataType.simpleString()}" for c in tkey)
    by = ["portfolio_id", "block"]
    return dealt.groupBy(*by).cogroup(placed.groupBy(*by)).applyInArrow(
        work, f"{schema}, expected_return double, variance double")
