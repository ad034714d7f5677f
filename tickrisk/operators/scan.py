"""Ordered scans per key, in two levels.

A running value per key in arrival order (running count, last non-null
value, previous row, exponentially weighted recurrence) is naturally a window
partitioned by the key; one hot key (a portfolio holding a third of all
rows) would then be scanned by one task. These scans split every key into
blocks, time buckets of the order timestamp:

* level 1 scans inside ``(key, block)`` with a window (many tasks per key);
* level 2 carries one summary row per ``(key, block)`` across the blocks of a
  key (a window over the small block table), and the carry is joined back.

Only block summaries of one key meet in one task; their number is the time
span divided by the block length, independent of the data volume. All
levels are linear in their rows. Order columns must make rows unique within
a key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Most rows of one level-1 segment and one level-2 epoch of the exponential scan.
SEG_ROWS, EPOCH_ROWS = 100_000, 300_000
# decay**-(segment + epoch) stays below e**MAX_EXPONENT, far from overflow (e**709).
MAX_EXPONENT = 400.0


def scan_lengths(decay: float) -> tuple[int, int]:
    """(segment, epoch) rows for a decay: the constants above, or less for a fast one."""
    if not 0.0 < decay < 1.0:
        raise ValueError("decay must lie between 0 and 1")
    rows = int(MAX_EXPONENT / -math.log(decay))
    seg, epoch = min(SEG_ROWS, rows // 4), min(EPOCH_ROWS, rows - rows // 4)
    if seg < 1 or seg >= epoch:
        raise ValueError(f"decay {decay} is too fast for the closed form")
    return seg, epoch


def block_of(ts, seconds: int) -> Column:
    """Block id of a TIMESTAMP column: ``floor(epoch / seconds)``."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("bigint")


def _running(keys: Sequence[str], order: Sequence[str]):
    return (Window.partitionBy(*keys).orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _before(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _whole(keys: Sequence[str]):
    return Window.partitionBy(*keys)


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: str,
            sums: dict[str, str] | None = None, lasts: dict[str, str] | None = None) -> DataFrame:
    """Several running values of one key order in a single two-level pass.

    ``sums``: ``{out: col}`` running sums; ``lasts``: ``{out: col}`` last
    non-null values (as-of). One level-1 window; the block summary is the
    block's last row (no aggregate); one level-2 window over the block rows
    and one join back, whatever the number of outputs.
    """
    keys, order = list(keys), list(order)
    sums, lasts = dict(sums or {}), dict(lasts or {})
    kb = keys + [block]
    w1 = _running(kb, order)
    d = df.select("*", *[F.sum(c).over(w1).alias(f"_ls_{o}") for o, c in sums.items()],
                  *[F.last(c, ignorenulls=True).over(w1).alias(f"_ll_{o}") for o, c in lasts.items()],
                  F.row_number().over(Window.partitionBy(*kb).orderBy(*order)).alias("_rn"),
                  F.count(F.lit(1)).over(_whole(kb)).alias("_cnt"))
    blk = d.filter(F.col("_rn") == F.col("_cnt")).select(
        *kb, *[F.col(f"_ls_{o}").alias(f"_bs_{o}") for o in sums],
        *[F.col(f"_ll_{o}").alias(f"_bl_{o}") for o in lasts])
    w2 = _before(keys, [block])
    carry = blk.select(*kb,
                       *[F.coalesce(F.sum(f"_bs_{o}").over(w2), F.lit(0)).alias(f"_cs_{o}")
                         for o in sums],
                       *[F.last(f"_bl_{o}", ignorenulls=True).over(w2).alias(f"_cl_{o}")
                         for o in lasts])
    d = d.join(carry, on=kb)
    outs = [(F.col(f"_cs_{o}") + F.col(f"_ls_{o}")).alias(o) for o in sums]
    outs += [F.coalesce(f"_ll_{o}", f"_cl_{o}").alias(o) for o in lasts]
    tmp = {"_rn", "_cnt"} | {f"_{k}_{o}" for o in sums for k in ("ls", "cs")} | \
        {f"_{k}_{o}" for o in lasts for k in ("ll", "cl")}
    return d.select(*[c for c in d.columns if c not in tmp], *outs)


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: str,
                value: str, out: str) -> DataFrame:
    """``out`` = sum of ``value`` over the rows of the key up to this row."""
    return running(df, keys, order, block, sums={out: value})


def forward_fill(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: str,
                 value: str, out: str) -> DataFrame:
    """``out`` = last non-null ``value`` of the key up to this row (as-of)."""
    return running(df, keys, order, block, lasts={out: value})


def previous_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: str,
                 cols: Sequence[str], out: str) -> DataFrame:
    """``out`` = struct of ``cols`` of the previous row of the key (NULL first)."""
    keys, order = list(keys), list(order)
    kb = keys + [block]
    w = Window.partitionBy(*kb).orderBy(*order)
    v = F.struct(*cols)
    d = df.select("*", F.lag(v).over(w).alias("_lag"), F.row_number().over(w).alias("_rn"),
                  F.count(F.lit(1)).over(_whole(kb)).alias("_cnt"))
    tail = d.filter(F.col("_rn") == F.col("_cnt")).select(*kb, v.alias("_tail"))
    carry = tail.select(*kb, F.lag("_tail").over(Window.partitionBy(*keys).orderBy(block))
                        .alias("_carry"))
    return (d.join(carry, on=kb)
            .withColumn(out, F.when(F.col("_rn") == 1, F.col("_carry")).otherwise(F.col("_lag")))
            .drop("_lag", "_rn", "_cnt", "_carry"))


def ew_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: str,
            x, init: str, decay: float, gain: float, out: str,
            prev_out: str | None = None, idx_out: str | None = None,
            seg_rows: int | None = None, epoch_rows: int | None = None) -> DataFrame:
    """Exponential recurrence ``y_k = decay*y_(k-1) + gain*x_k``, ``y_0 = init``.

    Level 1, per segment (at most ``seg_rows`` rows of one (key, block);
    local index ``j``): ``y_j = decay**j * y_start + loc_j`` with
    ``loc_j = gain * decay**j * sum_(l<=j) x_l * decay**-l``, a running sum
    whose factors stay finite. A segment is summarised by its length ``L``
    and ``S = loc_L``.

    Level 2, per key, without gathering lists: with ``C`` rows before a
    segment and ``D = C + L``,
    ``y_start(g) = decay**C * init + sum_(g' < g) decay**(C - D_g') * S_g'``.
    Segments are grouped into epochs of ``epoch_rows`` rows by ``C``; with
    ``R`` the epoch's first row, ``y_start = decay**(C-R) * (T_epoch + W) +
    decay**C * init`` where ``W`` is a running sum of ``decay**(R-D) * S`` over
    the epoch's earlier segments (exponents above ``-(epoch_rows+seg_rows)``,
    so finite) and ``T_epoch`` folds the few earlier epochs' totals.
    Work is linear in the rows; only epoch totals (rows / ``epoch_rows`` per
    key) meet in one task.

    Segment and epoch lengths follow from the decay (``scan_lengths``) unless given.
    ``init`` must be constant per key. Adds ``out`` (and optionally the value
    before this row, ``prev_out``, and the 1-based row index, ``idx_out``).
    """
    lengths = scan_lengths(decay)
    seg_rows, epoch_rows = seg_rows or lengths[0], epoch_rows or lengths[1]
    if seg_rows >= epoch_rows or (seg_rows + epoch_rows) * -math.log(decay) > 650.0:
        raise ValueError("need seg_rows < epoch_rows and decay**-(seg_rows + epoch_rows) < e**650")
    keys, order = list(keys), list(order)
    kb = keys + [block]
    kbs = kb + ["_sub"]
    q = F.lit(float(decay))
    x = F.col(x) if isinstance(x, str) else x
    d = df.withColumn("_i", F.row_number().over(Window.partitionBy(*kb).orderBy(*order)))
    d = d.withColumn("_sub", F.floor((F.col("_i") - 1) / F.lit(seg_rows)).cast("bigint"))
    d = d.withColumn("_j", (F.col("_i") - F.col("_sub") * F.lit(seg_rows)).cast("double"))
    w_seg = Window.partitionBy(*kbs).orderBy(*order)
    d = d.withColumn("_z", F.sum(x * F.pow(q, -F.col("_j"))).over(_running(kbs, order)))
    d = d.withColumn("_loc", F.lit(float(gain)) * F.pow(q, F.col("_j")) * F.col("_z"))
    if prev_out:
        d = d.withColumn("_loc_prev", F.lag("_loc").over(w_seg))
    seg = d.groupBy(*kbs).agg(
        F.count(F.lit(1)).alias("_L"),
        F.max_by("_loc", "_j").alias("_S"),
        F.first(init, ignorenulls=True).cast("double").alias("_init"))
    seg = seg.withColumn("_C", F.coalesce(F.sum("_L").over(_before(keys, [block, "_sub"])),
                                          F.lit(0)).cast("bigint"))
    seg = seg.withColumn("_e", F.floor(F.col("_C") / F.lit(epoch_rows)).cast("bigint"))
    seg = seg.withColumn("_u", F.pow(q, (F.col("_e") * F.lit(epoch_rows) - F.col("_C")
                                         - F.col("_L")).cast("double")) * F.col("_S"))
    seg = seg.withColumn("_W", F.coalesce(F.sum("_u").over(_before(keys + ["_e"], [block, "_sub"])),
                                          F.lit(0.0)))
    # earlier epochs: T_e = sum_(e' < e) decay**((e - e') * epoch_rows) * U_e'
    qe = F.pow(q, F.lit(float(epoch_rows)))
    ep = seg.groupBy(*keys, "_e").agg(F.sum("_u").alias("_U"))
    ep = ep.select(*keys, "_e", F.aggregate(
        F.coalesce(F.collect_list("_U").over(_before(keys, ["_e"])), F.array().cast("array<double>")),
        F.lit(0.0), lambda acc, u: (acc + u) * qe).alias("_T"))
    seg = seg.join(ep, keys + ["_e"])
    seg = seg.select(*kbs, "_C", (
        F.pow(q, (F.col("_C") - F.col("_e") * F.lit(epoch_rows)).cast("double"))
        * (F.col("_T") + F.col("_W"))
        + F.pow(q, F.col("_C").cast("double")) * F.col("_init")).alias("_start"))
    d = d.join(seg, on=kbs)
    d = d.withColumn(out, F.pow(q, F.col("_j")) * F.col("_start") + F.col("_loc"))
    if prev_out:
        d = d.withColumn(prev_out, F.when(F.col("_j") == 1, F.col("_start"))
                         .otherwise(F.pow(q, F.col("_j") - 1) * F.col("_start") + F.col("_loc_prev")))
    if idx_out:
        d = d.withColumn(idx_out, (F.col("_C") + F.col("_j")).cast("bigint"))
    return d.drop("_i", "_sub", "_j", "_z", "_loc", "_loc_prev", "_start", "_C")
