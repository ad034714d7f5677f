"""Sources (S1-S6): file twins, batch twins and Kafka + Avro.

Every source returns the wire schema of its record plus an arrival order
(``seq``) and an arrival time (``arrival_ts``):

* files (``file_source``): parquet/json/csv with an explicit schema, batch
  (``spark.read``) or stream (``spark.readStream``);
* Kafka (``kafka_source``): topic -> Avro-decoded record (``from_avro``,
  FAILFAST by default, PERMISSIVE + ``isNull`` as quarantine). Arrival time
  is the Kafka timestamp, arrival order ``(timestamp, partition, offset)``.
  Starting offsets ``latest`` (the original's choice) or ``earliest``.

Kafka and Avro need the ``spark-sql-kafka`` and ``spark-avro`` packages on
the classpath; they are not bundled here, so these paths are exercised only
where those packages exist (the file twins are tested instead).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickrisk.schemas import AVRO, STRUCTS


def file_source(spark: SparkSession, path: str, schema: T.StructType | str,
                fmt: str = "parquet", stream: bool = False, **options) -> DataFrame:
    """Batch or streaming read of files with a fixed schema (no inference).

    A stream over a single file needs a glob path (``dir/name.[p]arquet``).
    """
    reader = spark.readStream if stream else spark.read
    return reader.schema(schema).options(**options).format(fmt).load(path)


def single_file_glob(path: str) -> str:
    """``dir/events.parquet`` -> ``dir/events.[p]arquet`` for a stream source."""
    head, _, name = path.rpartition("/")
    return f"{head}/[{name[0]}]{name[1:]}"


def kafka_source(spark: SparkSession, bootstrap: str, topic: str, record: str,
                 starting_offsets: str = "latest", stream: bool = True,
                 mode: str = "FAILFAST", group_id: str | None = None,
                 order: str = "timestamp") -> DataFrame:
    """Kafka topic of Avro binary datums -> record columns.

    ``record`` is a key of ``schemas.AVRO`` (``price_tick``, ``weight_snapshot``,
    ``weight_row``, ``portfolio_stats``). Adds ``seq`` and ``arrival_ts``
    (Kafka timestamp). ``order="timestamp"`` (default): ``seq`` is the struct
    (timestamp, partition, offset), an order on any topic; consumers compare it as
    a whole (``stats.order_columns``). ``order="offset"``: ``seq`` is the offset, an
    order only where the records of one key share a partition; a long keeps the window
    aggregate hash-based. A batch read has no ``latest``: it starts at ``earliest``.
    """
    try:
        from pyspark.sql.avro.functions import from_avro
    except ImportError as e:  # pragma: no cover - part of pyspark
        raise RuntimeError("pyspark.sql.avro is unavailable") from e
    reader = spark.readStream if stream else spark.read
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting_offsets if stream or starting_offsets != "latest" else "earliest"}
    if group_id:
        opts["kafka.group.id"] = group_id
    raw = reader.format("kafka").options(**opts).load()
    rec = from_avro(F.col("value"), AVRO[record], {"mode": mode}).alias("r")
    cols = [F.col(f"r.{f.name}").alias(f.name) for f in STRUCTS[record].fields]
    seq = (F.col("offset") if order == "offset"
           else F.struct("timestamp", "partition", "offset"))
    return raw.select(seq.alias("seq"), F.col("timestamp").alias("arrival_ts"), rec) \
        .select("seq", "arrival_ts", *cols)


def avro_quarantine(df: DataFrame, record: str):
    """(good, bad) split of a PERMISSIVE decode: undecodable rows are NULL."""
    first = STRUCTS[record].fields[0].name
    return df.filter(F.col(first).isNotNull()), df.filter(F.col(first).isNull())
