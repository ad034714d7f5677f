"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def plan_bytes(df: DataFrame) -> int:
    """Spark's own estimate of the size of ``df`` (file sizes for a written table)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi-join with a side that is expected to be small.

    No hint is given: Spark broadcasts ``small`` only if its measured bytes (at
    planning, or at run time under adaptive execution) are below
    ``spark.sql.autoBroadcastJoinThreshold``; otherwise both sides are shuffled and
    skewed keys are split. A streaming ``big`` side with a static ``small`` side
    gives a stream-static join.
    """
    return big.join(small, on=on, how=how)


def salted_join(replicated: DataFrame, skewed: DataFrame, on, salt_of, buckets: int = 64,
                how: str = "inner") -> DataFrame:
    """Equi-join that spreads hot keys of ``skewed`` over ``buckets`` tasks.

    ``skewed`` rows get a deterministic salt ``pmod(hash(salt_of), buckets)``
    (a recomputed task assigns the same salt); ``replicated`` rows are copied
    once per salt. Use it when ``replicated`` is the smaller side per key
    (e.g. one return per ticker and window against every portfolio holding
    the ticker). The salt column is dropped from the result.
    """
    on = [on] if isinstance(on, str) else list(on)
    salt_of = [salt_of] if isinstance(salt_of, str) else list(salt_of)
    s = skewed.withColumn("_salt", F.pmod(F.hash(*salt_of), F.lit(buckets)))
    r = replicated.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return r.join(s, on=on + ["_salt"], how=how).drop("_salt")
