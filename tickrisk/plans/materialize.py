"""Materialising reused intermediates.

A result consumed by several later stages (applied returns, the statistics
series, metrics candidates) is written once as parquet under the shared
checkpoint folder (``spark.checkpoint.dir``) and read back. This cuts the
lineage (a lost executor recomputes from the table, not from the raw ticks),
keeps plans small, and gives column pruning and filter pushdown on re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickrisk.session import scratch_path


def materialize(df: DataFrame, name: str, mode: str = "parquet") -> DataFrame:
    """``mode``: ``parquet`` (table in the checkpoint folder), ``checkpoint``
    (reliable ``Dataset.checkpoint``) or ``none`` (keep the lineage)."""
    if mode == "none" or df.isStreaming:
        return df
    if mode == "checkpoint":
        from tickrisk.session import checkpoint_root
        checkpoint_root(df.sparkSession)
        return df.checkpoint(eager=True)
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
