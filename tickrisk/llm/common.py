"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# of the batches between the JVM and Python workers: rows at most, and bytes at most
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def per_worker(key: tuple, make: Callable):
    """A value kept by a Python worker across its tasks (vocabulary files, word caches). A worker
    keeps the one it used last, so those of earlier stages are given back."""
    store = sys.modules.setdefault("_tickrisk_worker", types.ModuleType("_tickrisk_worker"))
    values = store.__dict__.setdefault("values", {})
    if key not in values:
        values.clear()
        values[key] = make()
    return values[key]


def release() -> None:
    """Memory that Arrow and the C library hold free goes back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):          # another C library
        pass


def texts_as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null text is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``most_bytes`` (a larger row stands alone). At the
    end of the partition, memory no longer used is given back."""
    yield from _slices(batches, most_bytes)
    release()


def _slices(batches: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        if n <= 1 or batch.nbytes <= most_bytes:
            yield batch
            continue
        step = max(1, int(n * most_bytes / batch.nbytes))
        for at in range(0, n, step):
            part = batch.slice(at, step)
            if part.num_rows > 1 and part.nbytes > 4 * most_bytes:
                yield from _slices(iter([part]), most_bytes)
            else:
                yield part


def rows(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)],
        schema=schema)


def heavy_keys(counts: DataFrame, key: str, n: str, share: int = 2000) -> DataFrame:
    """Keys with more than 1/``share`` of all rows: fewer than ``share`` by arithmetic,
    so the result may be broadcast whatever the size of the data."""
    total = counts.agg(F.sum(n).alias("_total")).first()["_total"] or 0
    return counts.where(F.col(n) * share > F.lit(total))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def smallest_reachable(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Component number (its smallest member) of 0..n-1 under the links (i, j)."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            return root


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """One table per run of equal keys (numbers) of sorted batches; each row is looked at once."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        edges = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
        edges = [0, *edges.tolist(), batch.num_rows]
        if held and last != [c[0] for c in columns]:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        for begin, end in zip(edges, edges[1:]):
            if begin and held:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(begin, end - begin))
        last = [c[-1] for c in columns]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
