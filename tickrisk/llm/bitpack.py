"""Token-id files: every id takes the fewest bits the vocabulary needs.

A *blob* holds the ids of consecutive documents: a header, the byte offset
of each block, and blocks of ``BLOCK`` ids. 64 ids of ``bits`` bits fill
exactly ``bits`` 64-bit words, so packing and unpacking are 64 vectorised
steps (one per lane), and any id range is read by unpacking only the blocks
it touches. Blobs are rows of a Parquet table next to the document index
(id, number of ids), so Spark's writer commits them and a lost task is
simply run again.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickrisk.llm.common import rows, slices, texts_as_bytes
from tickrisk.llm.words import word_encoder
from tickrisk.session import scratch_path

MAGIC, HEAD, BLOCK = b"TKID", "<4sIQI", 4096


def bits_for(vocabulary: int) -> int:
    """Bits of the largest id (at least one)."""
    return max(1, int(vocabulary - 1).bit_length())


def _pack_words(ids: np.ndarray, bits: int) -> np.ndarray:
    """uint64 words holding ``ids`` (length a multiple of 64), little end first."""
    lanes = np.ascontiguousarray(ids.astype(np.uint64).reshape(-1, 64).T)
    out = np.zeros((bits, lanes.shape[1]), np.uint64)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        out[word] |= lanes[k] << np.uint64(shift)
        if shift + bits > 64:
            out[word + 1] |= lanes[k] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).reshape(-1)


def _unpack_words(words: np.ndarray, bits: int) -> np.ndarray:
    cols = np.ascontiguousarray(words.reshape(-1, bits).T)
    out = np.empty((64, cols.shape[1]), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        x = cols[word] >> np.uint64(shift)
        if shift + bits > 64:
            x = x | (cols[word + 1] << np.uint64(64 - shift))
        out[k] = x & mask
    return np.ascontiguousarray(out.T).reshape(-1)


def pack(ids: np.ndarray, bits: int) -> bytes:
    """One blob. Ids must be below ``2 ** bits`` (checked)."""
    n = len(ids)
    if n and int(ids.max()) >> bits:
        raise ValueError(f"an id does not fit in {bits} bits")
    padded = np.zeros(-(-n // 64) * 64, np.uint32)
    padded[:n] = ids
    payload = _pack_words(padded, bits).astype("<u8").tobytes()
    n_blocks = -(-n // BLOCK)
    offsets = np.minimum(np.arange(n_blocks + 1, dtype="<u8") * (BLOCK // 64 * bits * 8), len(payload))
    return struct.pack(HEAD, MAGIC, bits, n, n_blocks) + offsets.astype("<u8").tobytes() + payload


def unpack(blob: bytes, first: int = 0, count: int | None = None) -> np.ndarray:
    """Ids ``first .. first + count`` of a blob (all by default); reads only their blocks."""
    magic, bits, n, n_blocks = struct.unpack_from(HEAD, blob)
    if magic != MAGIC:
        raise ValueError("not a token-id blob")
    count = n - first if count is None else count
    if first < 0 or count < 0 or first + count > n:
        raise IndexError("id range outside the blob")
    if not count:
        return np.empty(0, np.uint32)
    offsets = np.frombuffer(blob, "<u8", n_blocks + 1, struct.calcsize(HEAD))
    base, b0, b1 = struct.calcsize(HEAD) + 8 * (n_blocks + 1), first // BLOCK, -(-(first + count) // BLOCK)
    words = np.frombuffer(blob, "<u8", int(offsets[b1] - offsets[b0]) // 8, base + int(offsets[b0]))
    ids = _unpack_words(words, bits)
    return ids[first - b0 * BLOCK:first - b0 * BLOCK + count]


BLOBS = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("before", T.LongType()),
                      T.StructField("n_ids", T.LongType()),
                      T.StructField("doc_ids", T.ArrayType(T.LongType())),
                      T.StructField("lengths", T.ArrayType(T.LongType())),
                      T.StructField("data", T.BinaryType())])


def write_token_files(docs: DataFrame, path: str, tokenizer: str, vocabulary: int, end_id: int | None,
                      id_col: str = "doc_id", text_col: str = "text", blob_ids: int = 1 << 20,
                      partitions: int | None = None) -> None:
    """Encode every whole text, append ``end_id`` and write blobs in ascending id order.

    Documents are dealt by id range (null ids first, equal ids in text order);
    each task packs its documents into blobs of about ``blob_ids`` ids (a longer
    document stands in one blob). A null or empty text has only the end id.
    Other columns of ``docs`` are ignored.
    """
    bits = bits_for(max(vocabulary, (end_id or 0) + 1))
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def encode(batches):
        from pyspark import TaskContext
        part, before = TaskContext.get().partitionId(), 0
        encoder = word_encoder(tokenizer)
        ids, lengths, held, size = [], [], [], 0

        def blob():
            whole = np.frombuffer(b"".join(held), "<u4")
            return rows(schema, [part], [before], [len(whole)], [ids], [lengths], [pack(whole, bits)])

        schema = pa.schema([("part", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()),
                            ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                            ("data", pa.binary())])
        for batch in slices(batches):
            for doc, text in zip(batch.column(0).to_pylist(), texts_as_bytes(batch.column(1))):
                got = encoder(text) + end
                ids.append(doc)
                lengths.append(len(got) // 4)
                held.append(got)
                size += len(got) // 4
                if size >= blob_ids:
                    yield blob()
                    ids, lengths, held, size, before = [], [], [], 0, before + size
        if ids:
            yield blob()

    (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
     .repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(encode, BLOBS).write.mode("overwrite").parquet(path))


def read_token_files(spark, path: str, per_document, fields: str) -> DataFrame:
    """One row per document from the files: doc_id, start (ids of all documents before
    it), n_tokens, then what ``per_document(ids)`` returns (``fields``: its DDL)."""
    blobs = spark.read.schema(BLOBS).parquet(path)
    from pyspark.sql import Window as W
    # ids before each part: one row per part of the writer, so a broadcast of that many rows at most
    totals = blobs.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = totals.select(F.col("part").alias("p"), (F.sum("n").over(
        W.orderBy("part").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")).alias("before_part"))
    placed = (blobs.join(F.broadcast(before), F.col("part") == F.col("p"))
              .select((F.col("before_part") + F.col("before")).alias("start"), "doc_ids", "lengths", "data"))
    schema = T._parse_datatype_string(f"doc_id long, start long, n_tokens long, {fields}")

    def read(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        for batch in slices(batches):
            for start, docs, lengths, data in zip(*(c.to_pylist() for c in batch.columns)):
                ids = unpack(data)
                ends = np.cumsum(np.array(lengths, np.int64))
                begins = ends - lengths
                made = [per_document(ids[a:b]) for a, b in zip(begins.tolist(), ends.tolist())]
                yield rows(arrow, docs, (begins + start).tolist(), lengths, *zip(*made))

    return placed.mapInArrow(read, schema)


def crc32_of(ids: np.ndarray) -> tuple[int]:
    return (zlib.crc32(np.ascontiguousarray(ids, "<u4")),)


def op8_token_bitpack(spark, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` as bit-packed ids (word vocabulary, end id 1), read back."""
    import public_tokenizers

    from tickrisk.llm.common import table
    path = scratch_path(spark, "token-ids")
    write_token_files(table(spark, sf_dir, "documents"), path,
                      public_tokenizers.path("word_bpe_49k.json"), vocabulary=49408, end_id=1)
    return read_token_files(spark, path, crc32_of, "ids_crc32 long")
