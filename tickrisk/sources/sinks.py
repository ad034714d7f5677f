"""Sinks (K1-K6).

* ``file_sink``: parquet/json twin of a Kafka topic (stream or batch);
* ``kafka_sink`` (K1/K2/K3): record -> Avro (``to_avro``) value, no key;
* ``console_sink`` (K6);
* ``points_writer`` (K4/K5): a ``foreachBatch`` function that writes the
  micro-batch's point table (metrics -> three points, weights -> one point per
  ticker) under its own ``batch=<id>`` folder, so a retried batch replaces its
  own output and no point is written twice.

Kafka/Avro need the ``spark-sql-kafka``/``spark-avro`` packages at run time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickrisk.operators import points as pt
from tickrisk.schemas import AVRO, STRUCTS


def wire_record(df: DataFrame, record: str) -> DataFrame:
    """Select the columns of a wire record in schema order; atomic fields are
    cast to the record's types (maps keep their type: the record's maps
    declare non-null values, which a cast from nullable values rejects)."""
    def col(f):
        if isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType)):
            return F.col(f.name)
        return F.col(f.name).cast(f.dataType).alias(f.name)
    return df.select(*[col(f) for f in STRUCTS[record].fields])


def avro_value(df: DataFrame, record: str) -> DataFrame:
    from pyspark.sql.avro.functions import to_avro
    rec = wire_record(df, record)
    return rec.select(to_avro(F.struct(*rec.columns), AVRO[record]).alias("value"))


def kafka_sink(df: DataFrame, bootstrap: str, topic: str, record: str, checkpoint: str):
    """Stream ``record`` rows to a Kafka topic as Avro values (no key)."""
    return (avro_value(df, record).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
            .option("checkpointLocation", checkpoint))


def file_sink(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
              output_mode: str = "append"):
    return (df.writeStream.format(fmt).option("path", path)
            .option("checkpointLocation", checkpoint).outputMode(output_mode))


def console_sink(df: DataFrame, output_mode: str = "append"):
    """Prints every row (the console format's own limit is 20 a batch)."""
    return (df.writeStream.format("console").outputMode(output_mode)
            .option("truncate", "false").option("numRows", 2 ** 31 - 1))


def points_writer(path: str, kind: str = "metrics", fmt: str = "parquet",
                  bucket: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function writing point tables of each micro-batch.

    ``kind="metrics"``: rows are metrics wire records (K4);
    ``kind="weights"``: rows are weight snapshots (K5).
    """
    def write(batch: DataFrame, epoch_id: int) -> None:
        if kind == "metrics":
            pts = pt.metric_points(batch, bucket or pt.DEFAULT_METRICS_BUCKET)
        else:
            pts = pt.weight_points(batch, bucket or pt.DEFAULT_WEIGHTS_BUCKET)
        pt.write_points(pts, f"{path}/batch={epoch_id}", fmt=fmt, mode="overwrite")
    return write
