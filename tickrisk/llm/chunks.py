"""Substring deduplication by content-defined chunks.

A gear hash of the last 8 bytes rolls over each text; a chunk ends where it is the least of
some window of 40 bytes, so boundaries move with the content, an insertion changes only the
chunks around it and none is longer than a window and a gap. Chunks are deduplicated by
digest: the first occurrence (smallest document id, then position) stays. Runs of
neighbouring repeated chunks of at least ``least_run`` bytes are removed.

The cuts in a shared passage are the same in each copy from its first whole window to its
last, so all but REACH + 2 * WINDOW bytes of it meet and a passage of ``least_run`` and that
many bytes is found. The exception are chains of candidates closer than LEAST_GAP, as in one
short word repeated dozens of times: which of them are kept may differ between copies.
A passage's first and last partial chunks stay.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickrisk.llm.common import heavy_keys, mix64, rows, slices, table, texts_as_bytes
from tickrisk.plans.materialize import materialize

REACH = 8                 # bytes that the rolling hash covers
WINDOW = 40               # any so many bytes of a text have a candidate, about 20 are apart
LEAST_GAP = 8             # a candidate is no cut if the cut before it is nearer
BLOCK = 1 << 20           # bytes whose windows are held at a time


def gear_table() -> np.ndarray:
    """One random 32-bit number per byte; 0 for the padding byte."""
    g = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint32)
    g[0] = 0
    return g


def least_places(h: np.ndarray, a: int, b: int) -> np.ndarray:
    """Place of the least hash (leftmost if tied) of each window that starts in a .. b - 1."""
    part = h[a:b + WINDOW - 1]
    least = part.astype(np.uint64) << np.uint64(32) | np.arange(len(part), dtype=np.uint64)
    span = 1
    while 2 * span <= WINDOW:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < WINDOW:
        least = np.minimum(least[:-(WINDOW - span)], least[WINDOW - span:])
    return a + (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def apart(hit: np.ndarray) -> np.ndarray:
    """Candidates from left to right without those nearer than LEAST_GAP to the one kept before."""
    keep, places, last = np.ones(len(hit), bool), hit.tolist(), 0
    for i in (np.flatnonzero(np.diff(hit) < LEAST_GAP) + 1).tolist():
        if keep[i - 1]:
            last = places[i - 1]
        keep[i] = places[i] - last >= LEAST_GAP
    return hit[keep]


def chunk_ends(texts: list[bytes], gear: np.ndarray) -> list[np.ndarray]:
    """Ends of the chunks of each text; the last is its length (none for an empty text)."""
    pad = bytes(REACH)
    data = np.frombuffer(pad + pad.join(texts) + pad, np.uint8)
    h = gear[data]
    for k in (1, 2, 4):                                      # window doubles: 2, 4, 8 bytes
        h[k:] += h[:-k] << np.uint32(k)
    h[:-1][data[1:] & 0xC0 == 0x80] = 0xFFFFFFFF             # not inside a UTF-8 character
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = REACH + np.r_[0, np.cumsum(sizes + REACH)[:-1]] if len(texts) else np.empty(0, np.int64)
    some = sizes >= WINDOW
    step = np.zeros(len(data) + 1, np.int8)                  # windows lie inside one text
    step[begins[some]] = 1
    step[(begins + sizes)[some] - WINDOW + 1] = -1
    inside = np.cumsum(step, dtype=np.int8).astype(bool)
    found = [np.empty(0, np.int64)]
    for a in range(0, len(data) - WINDOW + 1, BLOCK):
        b = min(a + BLOCK, len(data) - WINDOW + 1)
        at = least_places(h, a, b)[inside[a:b]]
        found.append(at[np.diff(at, prepend=-1) != 0])
    hit = np.concatenate(found)
    hit = apart(hit[np.diff(hit, prepend=-1) != 0])
    lo, hi = np.searchsorted(hit, begins), np.searchsorted(hit, begins + sizes - 1)
    return [np.append(hit[a:b] - begin + 1, size) if size else np.empty(0, np.int64)
            for a, b, begin, size in zip(lo, hi, begins, sizes)]


def chunk_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, tag (hash of its text), n_bytes, n_chunks and, per chunk,
    start, digest (64 bits) and whether the document had it before."""
    def work(batches):
        import xxhash
        digest_of, gear = xxhash.xxh3_64_intdigest, gear_table()
        schema = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("n_bytes", pa.int64()), ("n_chunks", pa.int32()),
                            ("starts", pa.list_(pa.int32())), ("digests", pa.list_(pa.int64())),
                            ("again", pa.list_(pa.bool_()))])
        for batch in slices(batches):
            texts = texts_as_bytes(batch.column(1))
            ends = chunk_ends(texts, gear)
            n = np.array([len(e) for e in ends], np.int64)
            starts = [np.r_[0, e[:-1]] if len(e) else e for e in ends]
            digests = np.fromiter((digest_of(t[a:b]) for t, s, e in zip(texts, starts, ends)
                                   for a, b in zip(s.tolist(), e.tolist())), np.uint64, int(n.sum())).view(np.int64)
            doc = np.repeat(np.arange(len(texts)), n)
            order = np.lexsort((digests, doc))               # stable: positions stay in order
            again = np.zeros(len(order), bool)
            again[order[1:]] = (digests[order[1:]] == digests[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
            offsets = pa.array(np.r_[0, np.cumsum(n)], pa.int32())
            flat = np.concatenate(starts) if starts else np.empty(0, np.int64)
            yield rows(schema, batch.column(0), batch.column(2), [len(t) for t in texts], n.astype(np.int32),
                       pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int32))),
                       pa.ListArray.from_arrays(offsets, pa.array(digests)),
                       pa.ListArray.from_arrays(offsets, pa.array(again)))

    text = F.col(text_col).cast("string")
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tag"))
            .mapInArrow(work, "doc_id long, tag long, n_bytes long, n_chunks int, starts array<int>, digests array<long>, "
                        "again array<boolean>"))


def repeated_runs(chunks: DataFrame, least_run: int = 100) -> DataFrame:
    """id, tag and ``spans`` (byte start and end of removed runs), for documents that have any.

    ``chunks`` is a written ``chunk_table``. A document is an id with the tag of its text, so
    spans belong to one text only. Texts that share an id do not remove each other's chunks;
    texts without id come after all others, by tag. A digest of more than 1/2000 of all
    chunks (there are fewer than 2000 such) meets its chunks by a broadcast, the others by
    a shuffled join, so no frequent passage lands in one task.
    """
    each = (chunks.select("doc_id", "tag", F.explode(F.arrays_zip(
                "starts", "digests", "again",
                F.slice(F.concat("starts", F.array(F.col("n_bytes").cast("int"))), 2, F.size("starts")).alias("ends")))
                .alias("c"))
            .select("doc_id", "tag", F.col("c.starts").alias("start"), F.col("c.ends").alias("end"),
                    F.col("c.digests").alias("digest"), F.col("c.again").alias("again")))
    fresh = each.where("not again")
    no_id = F.when(F.col("doc_id").isNull(), F.col("tag"))
    counts = fresh.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"),
                                         F.min(no_id).alias("first_tag"), F.max(no_id).alias("last_tag"),
                                         F.count("*").alias("n"))
    shared = materialize(counts.where("last > first or first_tag is not null and (first is not null or last_tag > first_tag)")
                         .select(F.col("digest").alias("d"), "first", "first_tag", "n"), "shared-chunks")
    hot = heavy_keys(shared, "d", "n").select("d", "first", "first_tag")
    cold = shared.join(F.broadcast(hot.select("d")), "d", "left_anti").select("d", "first", "first_tag")
    from_hot = fresh.join(F.broadcast(hot), fresh.digest == F.col("d"))
    from_cold = (fresh.join(F.broadcast(hot.select("d")), fresh.digest == F.col("d"), "left_anti")
                 .join(cold, F.col("digest") == F.col("d")))
    later = [x.where("doc_id > first or doc_id is null and (first is not null or tag > first_tag)")
             .select("doc_id", "tag", "start", "end") for x in (from_hot, from_cold)]
    flagged = later[0].unionByName(later[1]).unionByName(each.where("again").select("doc_id", "tag", "start", "end"))
    per_doc = flagged.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("start", "end")).alias("c"))

    def runs(batches):
        schema = pa.schema([("id", pa.int64()), ("tag", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()),
                                                                               ("end", pa.int32())])))])
        for batch in slices(batches):
            ids, tags, found = [], [], []
            for i, tag, part in zip(*(batch.column(k).to_pylist() for k in range(3))):
                spans = []
                for x in sorted((x["start"], x["end"]) for x in part):
                    if spans and x[0] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], x[1])
                    else:
                        spans.append(list(x))
                spans = [{"start": a, "end": b} for a, b in spans if b - a >= least_run]
                if spans:
                    ids.append(i)
                    tags.append(tag)
                    found.append(spans)
            yield rows(schema, ids, tags, found)

    return per_doc.mapInArrow(runs, "id long, tag long, spans array<struct<start:int,end:int>>")


def substring_report(docs: DataFrame, least_run: int = 100, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_chunks, n_removed, n_spans, spans of every row. A null or empty
    text has no chunks; other columns are ignored."""
    chunks = materialize(chunk_table(docs, id_col, text_col), "chunks")
    spans = repeated_runs(chunks, least_run)
    joined = chunks.select("doc_id", F.col("tag").alias("_tag"), "n_bytes", "n_chunks").join(
        spans, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("_tag") == F.col("tag")), "left")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + (x["end"] - x["start"]))
    return joined.select("doc_id", "n_bytes", F.col("n_chunks").cast("long").alias("n_chunks"),
                         F.coalesce(removed, F.lit(0)).alias("n_removed"),
                         F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"), "spans")


def without_spans(text: bytes, spans: list[dict]) -> bytes:
    out, at = [], 0
    for s in spans:
        out.append(text[at:s["start"]])
        at = s["end"]
    return b"".join([*out, text[at:]])


def remove_repeats(docs: DataFrame, least_run: int = 100, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``docs`` with repeated runs cut out of the texts; all rows and columns stay. Rows with
    the same id (or none) and the same text are one document."""
    spans = materialize(repeated_runs(materialize(chunk_table(docs, id_col, text_col), "chunks"), least_run), "spans")
    columns = docs.columns
    named = docs.select(*[F.col(f"`{c}`").alias(f"in{i}") for i, c in enumerate(columns)])
    at = columns.index(text_col)
    same_row = (F.col(f"in{columns.index(id_col)}").cast("long").eqNullSafe(spans["id"])
                & (F.xxhash64(F.col(f"in{at}").cast("string")) == spans["tag"]))
    joined = named.join(spans, same_row, "left").drop("id", "tag")
    out = docs.schema

    def cut(batches):
        for batch in slices(batches):
            texts, found = batch.column(at).cast(pa.binary()).to_pylist(), batch.column(len(columns)).to_pylist()
            text = pa.array([without_spans(t, s) if s and t else t for t, s in zip(texts, found)], pa.binary())
            yield pa.RecordBatch.from_arrays([text.cast(pa.string()) if i == at else batch.column(i)
                                              for i in range(len(columns))], names=columns)

    return joined.mapInArrow(cut, out)


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Every text of ``documents``: what repeats from earlier texts or places."""
    return substring_report(table(spark, sf_dir, "documents"))
