"""Near-duplicate embeddings by collision-counting projections.

Unit vectors are projected on random lines. A pair collides on a line if one lies
in the window centred on the other; for a pair at the threshold the difference is
normal with a known width, so the number of collisions that such a pair reaches
is calibrated, and only pairs that reach it are verified by cosine in double
precision. Lines are sorted per cell: cells come from several tables of a few
projections each, cut into steps with a random offset, whose number is calibrated
for the same recall. They deal the work: vectors that share no cell never meet.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickrisk.llm.common import rows, slices, smallest_reachable, table
from tickrisk.llm.components import connected_components
from tickrisk.plans.materialize import materialize


NO_ID = (1 << 63) - 1


class Plan:
    """Calibrated parameters for a cosine threshold.

    ``per_table`` projections of step ``step`` make a cell; ``tables`` is the number
    that misses a pair at the threshold with at most ``miss``. ``lines`` counting
    projections have windows of ``reach`` standard deviations of such a pair's
    difference; ``least`` is the largest count it falls short of with at most ``miss``.
    """

    def __init__(self, cosine: float, per_table: int = 14, step: float = 2.0, lines: int = 32,
                 reach: float = 2.0, miss: float = 0.004):
        self.cosine, self.per_table, self.step, self.lines = cosine, per_table, step, lines
        self.distance = math.sqrt(2 - 2 * cosine)
        z = np.linspace(-8, 8, 16001)
        density = np.exp(-z * z / 2) / math.sqrt(2 * math.pi) * (z[1] - z[0])
        same = float((np.maximum(0, 1 - np.abs(z) * self.distance / step) * density).sum())
        self.tables = math.ceil(math.log(miss) / math.log1p(-same ** per_table))
        self.window, self.first_window = reach * self.distance, 4.0 * self.distance
        hit = math.erf(reach / math.sqrt(2))
        below, self.least = 0.0, 0
        for k in range(lines + 1):
            below += math.comb(lines, k) * hit ** k * (1 - hit) ** (lines - k)
            if below > miss / 10:
                self.least = k
                break


@lru_cache(maxsize=8)
def _lines(dim: int, n: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, n))


def cell_keys(unit: np.ndarray, plan: Plan) -> np.ndarray:
    """One 32-bit cell number per vector and table."""
    n = plan.tables * plan.per_table
    lines = _lines(unit.shape[1], n, 1)
    offset = np.random.default_rng(2).uniform(0, plan.step, n)
    cells = np.floor((unit @ lines + offset) / plan.step).astype(np.int64).astype(np.uint64)
    cells = cells.reshape(len(unit), plan.tables, plan.per_table)
    h = np.zeros(cells.shape[:2], np.uint64)
    with np.errstate(over="ignore"):
        for k in range(plan.per_table):
            h = (h ^ cells[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return (h >> np.uint64(32)).astype(np.uint32).view(np.int32)


def candidate_pairs(unit: np.ndarray, group: np.ndarray, side: np.ndarray, plan: Plan):
    """Pairs (i, j) of one group that reach the calibrated number of collisions, in pieces.

    Rows of each group are sorted on every line at once; ``side`` 0 or 1 marks the two blocks of
    a split group, whose pairs are wanted across only; 2 marks whole groups."""
    values = unit @ _lines(unit.shape[1], plan.lines + 1, 3) + group[:, None] * 64.0    # groups lie apart
    rank, low, high = [], [], []
    for j in range(plan.lines + 1):
        order = np.argsort(values[:, j], kind="stable")
        ordered = values[order, j]
        w = plan.window if j else plan.first_window
        r = np.empty(len(order), np.int32)
        r[order] = np.arange(len(order))
        rank.append(r)
        low.append(np.searchsorted(ordered, values[:, j] - w).astype(np.int32))
        high.append(np.searchsorted(ordered, values[:, j] + w, side="right").astype(np.int32))
        if not j:
            first = order
    # pairs in the window of the first line: each row with the rows after it
    after = high[0][first] - np.arange(len(first)) - 1
    begin = 0
    while begin < len(first):
        end = begin + 1 + int(np.searchsorted(np.cumsum(after[begin + 1:]), 1 << 20))
        n = after[begin:end]
        i = np.repeat(first[begin:end], n)
        at = np.repeat(np.arange(begin, end), n)
        k = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        j = first[at + 1 + k]
        keep = (side[i] == 2) | (side[i] != side[j])
        i, j = i[keep], j[keep]
        count = np.zeros(len(i), np.int16)
        for line in range(1, plan.lines + 1):
            x = rank[line][j]
            count += (x >= low[line][i]) & (x < high[line][i])
        good = count >= plan.least
        yield i[good], j[good]
        begin = end


def _whole_groups(batches, key_columns: list[str], least: int):
    """Tables of at least ``least`` rows (but the last) that end with the end of a group; the
    input is sorted by the key columns."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < least:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        keys = [t.column(c).to_numpy() for c in key_columns]
        last = np.logical_and.reduce([k == k[-1] for k in keys])
        cut = int(np.argmax(last))
        if cut:
            yield t.slice(0, cut)
            held = t.slice(cut).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _vectors(column, kind: str) -> np.ndarray:
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), kind).reshape(len(parts), -1).astype(np.float64)


def vector_classes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str):
    """Rows with (vec_id, h): h numbers the class of equal vectors of one label, null for rows
    that link with nothing; the classes (h, label_dim, low, n, v): smallest id, count and
    components; and the components' type."""
    kind = "<f4" if vectors.schema[vector_col].dataType.elementType.simpleString() == "float" else "<f8"

    def identify(batches):
        import xxhash
        schema = pa.schema([("vec_id", pa.int64()), ("h", pa.int64()), ("label_dim", pa.string()), ("v", pa.binary())])
        for batch in slices(batches):
            hs, dims, out = [], [], []
            for label, v in zip(batch.column(2).to_pylist(), batch.column(1).to_pylist()):
                x = None
                if label is not None and v and None not in v:
                    x = np.array(v, kind) + np.array(0, kind)         # -0.0 becomes 0.0
                    if not np.isfinite(x).all() or not x.any():
                        x = None
                hs.append(None if x is None else xxhash.xxh3_64_intdigest(
                    x.tobytes(), seed=xxhash.xxh3_64_intdigest(label)) - (1 << 63))
                dims.append(None if x is None else f"{len(x)} {label}")
                out.append(None if x is None else x.tobytes())
            yield rows(schema, batch.column(0), hs, dims, out)

    each = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col), F.col(label_col).cast("string"))
            .mapInArrow(identify, "vec_id long, h long, label_dim string, v binary"))
    each = materialize(each, "vectors")
    classes = (each.where("h is not null").groupBy("h", "label_dim")
               .agg(F.min(F.coalesce("vec_id", F.lit(NO_ID))).alias("low"), F.count("*").alias("n"), F.min("v").alias("v")))
    return each, classes, kind


def embedding_links(vectors: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", block: int = 1024, plan: Plan | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Equal vectors of one label form a class and are linked; classes are compared within a
    label, by the cells they share. A pair found in several tables counts in the first one.
    A cell of more than ``block`` classes is split into blocks that meet two by two, so no
    task holds more than two blocks of it, and nothing is left out. Links are
    counted where they are found; only one edge per vector and cell leaves a task.

    A vector that is null, empty, zero or holds null or non-finite components, or whose label
    is null, links with nothing. Vectors of different lengths are never compared. Repeated rows
    are vectors of their own that link with each other. A null id is larger than any other; a
    component of null ids only has no id, and is kept.
    """
    plan = plan or Plan(cosine)
    each, classes, kind = vector_classes(vectors, id_col, vector_col, label_col)
    classes = materialize(classes, "classes")

    def unit_of(v):
        return v / np.sqrt((v * v).sum(1, keepdims=True))

    def cells(batches):
        schema = pa.schema([("h", pa.int64()), ("keys", pa.list_(pa.int32()))])
        for batch in slices(batches, 1 << 20):
            labels = np.array(batch.column("label_dim").to_pylist(), object)
            for label in dict.fromkeys(labels):               # one length of vector at a time
                at = pa.array(labels == label)
                part = batch.filter(at)
                yield rows(schema, part.column("h"), cell_keys(unit_of(_vectors(part.column("v"), kind)), plan).tolist())

    keyed = materialize(classes.mapInArrow(cells, "h long, keys array<int>"), "cells")
    placed = (classes.select("h", F.xxhash64("label_dim").alias("label"))
              .join(keyed, "h").select("h", F.posexplode("keys").alias("t", "key"), "label")
              .select("h", "t", F.xxhash64("label", "t", "key").alias("cell")))
    sizes = placed.groupBy("cell").agg(F.count("*").alias("size")).where("size > 1")
    # a split cell's row goes to every pair of blocks that its own block is in
    blocks = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int")
    met = (placed.join(sizes, "cell").withColumn("blocks", blocks).withColumn("own", own)
           .select("cell", "t", "h", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
           .select("cell", "t", "h", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                   F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
                   .alias("side")))
    full = met.join(classes.select("h", "n", "v"), "h").join(keyed, "h")

    def compare(batches):
        schema = pa.schema([("h", pa.int64()), ("links", pa.int64()), ("near", pa.int64())])
        for t in _whole_groups(batches, ["cell", "i", "j"], 4 * block):
            cell, bi, bj = (t.column(c).to_numpy() for c in ("cell", "i", "j"))
            new = np.r_[True, (cell[1:] != cell[:-1]) | (bi[1:] != bi[:-1]) | (bj[1:] != bj[:-1])]
            group, side, table_no = np.cumsum(new) - 1, t.column("side").to_numpy(), t.column("t").to_numpy()
            h, n = t.column("h").to_numpy(), t.column("n").to_numpy()
            parts = t.column("v").to_pylist()
            width = np.array([len(p) for p in parts])
            keys = np.array(t.column("keys").to_pylist(), np.int32)
            for dim in np.unique(width):                      # cells hold vectors of one length
                at = np.flatnonzero(width == dim)
                v = np.frombuffer(b"".join(parts[k] for k in at), kind).reshape(len(at), -1).astype(np.float64)
                norm = np.sqrt((v * v).sum(1))
                links, fi, fj = np.zeros(len(at), np.int64), [], []
                for i, j in candidate_pairs(v / norm[:, None], group[at], side[at], plan):
                    cos = np.einsum("ij,ij->i", v[i], v[j]) / (norm[i] * norm[j])
                    i, j = i[cos >= cosine], j[cos >= cosine]
                    fi.append(i)
                    fj.append(j)
                    # a pair counts in the first table in which its vectors share a cell
                    ki, kj = keys[at[i]], keys[at[j]]
                    first = np.argmax(ki == kj, 1) == table_no[at[i]]
                    np.add.at(links, i[first], n[at[j[first]]])
                    np.add.at(links, j[first], n[at[i[first]]])
                if not fi or not sum(map(len, fi)):
                    continue
                root = smallest_reachable(len(at), np.concatenate(fi), np.concatenate(fj))
                told = np.flatnonzero((links > 0) | (root != np.arange(len(at))))
                yield rows(schema, h[at[told]], links[told], h[at[root[told]]])

    found = materialize(full.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
                        .mapInArrow(compare, "h long, links long, near long"), "found")
    counts = found.groupBy(F.col("h").alias("ch")).agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("h").alias("a"), F.col("near").alias("b")))
    grouped = (classes.select("h", "low", "n").join(counts, F.col("h") == F.col("ch"), "left")
               .join(roots, F.col("h") == F.col("node"), "left")
               .select("h", "low", "n", F.coalesce("links", F.lit(0)).alias("links"),
                       F.coalesce("root", "h").alias("root")))
    smallest = grouped.groupBy(F.col("root").alias("r")).agg(F.min("low").alias("component"))
    grouped = grouped.join(smallest, F.col("root") == F.col("r")).select(
        F.col("h").alias("gh"), (F.col("links") + F.col("n") - 1).alias("n_links"), "component")
    out = each.select("vec_id", "h").join(grouped, F.col("h") == F.col("gh"), "left")
    component = F.coalesce(F.nullif("component", F.lit(NO_ID)), "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.col("component").isNull() | (F.col("component") == NO_ID))
                      .alias("kept"))


def op2_collision_neardup(spark, sf_dir: str) -> DataFrame:
    """Near-duplicates of ``embeddings`` within a label, cosine 0.93 or more."""
    return embedding_links(table(spark, sf_dir, "embeddings"), 0.93)


ORACLE = r"""
WITH RECURSIVE e AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
ok AS MATERIALIZED (
  SELECT r, label, v FROM e
  WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
link AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM ok a JOIN ok b ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
  SELECT r AS a, r AS b FROM e
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
low AS (SELECT a AS r, min(vec_id) AS component_id FROM reach JOIN e ON e.r = reach.b GROUP BY a),
num AS (SELECT a AS r, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM e JOIN low USING (r) LEFT JOIN num USING (r)
"""
