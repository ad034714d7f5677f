"""Exact removal of repeated byte strings by external induced sorting.

Every window of ``LENGTH`` bytes that starts earlier elsewhere marks its bytes for removal.

1. *Anchors.* Each window has an anchor: the smallest hash among the ``GRAM``-byte strings in it
   (leftmost if tied). Equal windows have equal anchors at equal places, so windows are
   compared per anchor string only. Neighbouring windows with one anchor form a *snippet*.
2. *Copies.* Equal snippets are collapsed, in the task that reads them and again after the
   shuffle; all but the earliest occurrence are repeats as a whole.
3. *Induced sorting.* Anchors with several different snippets go to shards. There the suffixes
   that start at one distance from their anchor are sorted by induction: their order follows
   from the order of the suffixes one byte further right, as a queue of tuples (anchor,
   byte, rank of the next suffix), and the common prefix of neighbours is one more than the
   least common prefix between them in the former order. The recursion runs from the right end of the
   context through the anchor to the leftmost window. Runs with a common
   prefix of ``LENGTH`` are equal windows; all but the earliest are repeats.

A shard's snippets are written to scratch files as they arrive and mapped, not loaded; groups of
one anchor larger than ``memory_rows`` pass through a disk-backed priority queue whose buckets
(one per byte) are files that are appended to and read back in order.
"""

from __future__ import annotations

import hashlib
import os
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickrisk.llm.collisions import _whole_groups
from tickrisk.llm.common import mix64, rows, slices, table, texts_as_bytes
from tickrisk.plans.materialize import materialize

LENGTH, GRAM = 100, 24
PLACES = LENGTH - GRAM + 1             # places of an anchor in a window
END = 256                              # stands for the byte after a snippet's end; equals nothing


def snippets(texts: list[bytes]):
    """Arrays (text number, start, anchor start, windows, anchor hash) of all snippets, in order."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(texts), np.uint8)
    n = len(data)
    none = np.empty(0, np.int64)
    if n < LENGTH:
        return none, none, none, none, np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        w = data.astype(np.uint64)                             # 8 bytes from each place on
        for k in (1, 2, 4):
            w[:-k] |= w[k:] << np.uint64(8 * k)
        g = mix64(w[:n - GRAM + 1])
        for k in range(8, GRAM, 8):
            g = mix64(g * np.uint64(3) + w[k:n - GRAM + 1 + k])
    least = (g & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(g), dtype=np.uint64)
    span = 1
    while 2 * span <= PLACES:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < PLACES:
        least = np.minimum(least[:-(PLACES - span)], least[PLACES - span:])
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)   # of the window that starts at i
    doc = np.repeat(np.arange(len(texts)), sizes)[:len(anchor)]
    start = np.flatnonzero(np.arange(len(anchor)) + LENGTH <= (begins + sizes)[doc])
    a, d = anchor[start], doc[start]
    first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (d[1:] != d[:-1])]) if len(start) else none
    windows = np.diff(np.r_[first, len(start)])
    d, lo, a = d[first], start[first], a[first]
    return d, lo - begins[d], a - begins[d], windows, g[a]


def _spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Union of byte spans per document; input sorted by (doc, start)."""
    if not len(doc):
        return doc, start, end
    far = 1 << 40                                               # keeps documents apart
    top = np.maximum.accumulate(doc * far + end)
    new = np.flatnonzero(np.r_[True, (doc * far + start)[1:] > top[:-1]])
    return doc[new], start[new], top[np.r_[new[1:], len(doc)] - 1] - doc[new] * far


EACH = "route long, gram long, hash long, key long, start int, anchor int, windows int"


def each_snippet(docs: DataFrame) -> DataFrame:
    """Rows of ``EACH`` from (key, text): the earliest occurrence of each snippet in a batch of
    documents, routed by its anchor hash, and the merged spans of the other occurrences (hash null,
    ``windows`` holds the span's length), routed evenly."""
    def work(batches):
        import xxhash
        digest = xxhash.xxh3_64_intdigest
        schema = pa.schema([(c, pa.int64()) for c in ("route", "gram", "hash", "key")]
                           + [(c, pa.int32()) for c in ("start", "anchor", "windows")])
        for batch in slices(batches, 6 << 20):
            texts, keys = texts_as_bytes(batch.column(1)), batch.column(0).to_numpy()
            by_key = np.argsort(keys, kind="stable")
            texts, keys = [texts[i] for i in by_key], keys[by_key]
            doc, start, anchor, windows, gram = snippets(texts)
            hashes = np.fromiter((digest(texts[d][s:e]) for d, s, e in zip(
                doc.tolist(), start.tolist(), (start + windows + LENGTH - 1).tolist())), np.uint64, len(doc))
            order = np.lexsort((start, keys[doc], hashes, gram))     # earliest first
            again, twin = (np.zeros(len(doc), bool) for _ in range(2))
            same = (gram[order[1:]] == gram[order[:-1]]) & (hashes[order[1:]] == hashes[order[:-1]])
            # the same place of a repeated row is no other occurrence
            twin[order[1:]] = same & (keys[doc[order[1:]]] == keys[doc[order[:-1]]]) & (start[order[1:]] == start[order[:-1]])
            again[order[1:]] = same
            again &= ~twin
            new = ~again & ~twin
            d, s, e = _spans(doc[again], start[again], (start + windows + LENGTH - 1)[again])
            gone = np.zeros(len(d), np.int64)
            with np.errstate(over="ignore"):
                spread = mix64(keys[d].astype(np.uint64) + s.astype(np.uint64)).view(np.int64)
            hash_column = pa.concat_arrays([pa.array(hashes[new].view(np.int64)), pa.nulls(len(d), pa.int64())])
            yield rows(schema, np.r_[gram[new].view(np.int64), spread], np.r_[gram[new].view(np.int64), gone],
                       hash_column, np.r_[keys[doc[new]], keys[d]],
                       *(np.r_[x, y].astype(np.int32) for x, y in
                         ((start[new], s), (anchor[new], gone), (windows[new], e - s))))

    return docs.mapInArrow(work, EACH)


def settle_copies(each: DataFrame, partitions: int) -> DataFrame:
    """(gram, key, start, anchor, windows): removed spans (gram null, ``windows`` is the length in
    bytes) and the earliest occurrences of snippets whose anchor has several."""
    def work(batches):
        schema = pa.schema([("gram", pa.int64()), ("key", pa.int64())]
                           + [(c, pa.int32()) for c in ("start", "anchor", "windows")])
        for t in _whole_groups(batches, ["route"], 1 << 16):
            is_span = t.column("hash").is_null().to_numpy()
            spans = t.filter(pa.array(is_span)).select(["key", "start", "anchor", "windows"])
            t = t.filter(pa.array(~is_span))
            gram, h = t.column("gram").to_numpy(), t.column("hash").to_numpy()
            key = t.column("key").to_numpy()
            start, anchor, windows = (t.column(c).to_numpy() for c in ("start", "anchor", "windows"))
            if len(gram):                                       # the same place of repeated rows counts once
                one = np.r_[True, (gram[1:] != gram[:-1]) | (h[1:] != h[:-1]) | (key[1:] != key[:-1])
                            | (start[1:] != start[:-1])]
                gram, h, key, start, anchor, windows = (x[one] for x in (gram, h, key, start, anchor, windows))
            new_gram = np.r_[True, gram[1:] != gram[:-1]] if len(gram) else np.empty(0, bool)
            first = new_gram | np.r_[True, h[1:] != h[:-1]] if len(gram) else new_gram
            group = np.cumsum(new_gram) - 1
            several = (np.bincount(group[first], minlength=1) > 1)[group] if len(gram) else first
            again, kept = ~first, first & several
            yield rows(schema,
                       pa.concat_arrays([pa.nulls(int(again.sum()) + len(spans), pa.int64()), pa.array(gram[kept])]),
                       np.r_[key[again], spans.column("key").to_numpy(), key[kept]],
                       np.r_[start[again], spans.column("start").to_numpy(), start[kept]],
                       np.r_[anchor[again], spans.column("anchor").to_numpy(), anchor[kept]],
                       np.r_[windows[again] + np.int32(LENGTH - 1), spans.column("windows").to_numpy(), windows[kept]])

    return (each.repartition(partitions, "route").sortWithinPartitions("route", "gram", "hash", "key", "start")
            .mapInArrow(work, "gram long, key long, start int, anchor int, windows int"))


class Snippets:
    """The snippets of a shard in sorted anchor order; arrays may be mapped files.
    ``age`` orders occurrences: (key, anchor place)."""

    def __init__(self, gram, key, start, anchor, windows, offset, data):
        self.gram, self.key, self.start, self.anchor = gram, key, start, anchor
        self.windows, self.offset, self.data = windows, offset, data

    def part(self, a: int, b: int) -> "Snippets":
        lo, hi = int(self.offset[a]), int(self.offset[b])
        cut = [np.asarray(x[a:b]) for x in (self.gram, self.key, self.start, self.anchor, self.windows)]
        return Snippets(*cut, np.asarray(self.offset[a:b + 1]) - lo, np.asarray(self.data[lo:hi]))

    def bytes_at(self, ids: np.ndarray, place: int) -> np.ndarray:
        """Byte at ``place`` from the anchor of each snippet, END outside."""
        at = self.anchor[ids] - self.start[ids] + place
        inside = (at >= 0) & (at < self.windows[ids] + LENGTH - 1)
        at = np.where(inside, self.offset[ids] + at, 0)
        return np.where(inside, self.data[at].astype(np.int64), END)


def _least_between(prefix: np.ndarray, after: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """min(prefix[after + 1 .. upto]) for each pair."""
    if not len(after):
        return np.empty(0, prefix.dtype)
    pairs = np.stack([after + 1, upto + 1], 1).reshape(-1)
    return np.minimum.reduceat(np.append(prefix, prefix.dtype.type(0)), pairs)[::2]


def _repeats(ids: np.ndarray, prefix: np.ndarray, age: np.ndarray) -> np.ndarray:
    """Ids, in sorted order with common prefixes, whose window an earlier one equals."""
    equal = prefix >= LENGTH
    if not equal.any():
        return ids[:0]
    first = np.flatnonzero(~equal)
    oldest = np.minimum.reduceat(age[ids], first)
    return ids[age[ids] != np.repeat(oldest, np.diff(np.r_[first, len(ids)]))]


def sort_group_in_memory(s: Snippets):
    """Repeated windows as (snippet, place from the anchor), for whole anchor groups."""
    n = len(s.gram)
    group = np.cumsum(np.r_[True, s.gram[1:] != s.gram[:-1]]) - 1
    age = np.empty(n, np.int64)
    age[np.lexsort((s.anchor, s.key))] = np.arange(n)
    ids, prefix = np.arange(n), np.zeros(n, np.int16)
    for place in range(LENGTH - 1, -PLACES, -1):
        byte = s.bytes_at(ids, place)
        tuples = group[ids] * (END + 1) + byte
        order = np.argsort(tuples, kind="stable")               # by (anchor, byte, rank of the next suffix)
        t = tuples[order]
        same = (t[1:] == t[:-1]) & (byte[order][1:] != END)
        induced = np.zeros(len(ids), np.int16)
        at = np.flatnonzero(same) + 1
        induced[at] = np.minimum(_least_between(prefix, order[at - 1], order[at]) + 1, LENGTH)
        ids, prefix = ids[order], induced
        if place <= 0:
            inside = byte[order] != END                         # the others sort last in their group
            ids, prefix = ids[inside], prefix[inside]
            found = _repeats(ids, prefix, age)
            if len(found):
                yield found, place
        if not len(ids):
            return


class BucketQueue:
    """Disk-backed priority queue of (byte, arrival) -> (id, common prefix): one file per byte,
    appended to in order of arrival and read back byte by byte in pieces."""

    def __init__(self, folder: str, name: str):
        self.paths = [os.path.join(folder, f"{name}-{b}") for b in range(END + 1)]

    def push(self, byte: np.ndarray, ids: np.ndarray, prefix: np.ndarray) -> None:
        order = np.argsort(byte, kind="stable")
        cuts = np.flatnonzero(np.diff(byte[order])) + 1
        for part in np.split(order, cuts) if len(order) else ():
            with open(self.paths[int(byte[part[0]])], "ab") as f:
                f.write(np.stack([ids[part], prefix[part].astype(np.int64)], 1).tobytes())

    def pieces(self, rows_each: int):
        """Pops everything, in order."""
        for path in self.paths:
            if os.path.exists(path):
                with open(path, "rb") as f:
                    while piece := f.read(16 * rows_each):
                        x = np.frombuffer(piece, np.int64).reshape(-1, 2)
                        yield x[:, 0], x[:, 1].astype(np.int16)
                os.remove(path)


def sort_group_on_disk(s: Snippets, folder: str, piece: int):
    """Like ``sort_group_in_memory`` for one anchor's snippets, ``piece`` tuples at a time."""
    n = len(s.gram)

    def initial():
        for a in range(0, n, piece):
            yield np.arange(a, min(n, a + piece)), np.zeros(min(n, a + piece) - a, np.int16)

    def age_of(ids):           # (key, anchor) of each id
        return s.key[ids], s.anchor[ids]

    source = initial()
    for place in range(LENGTH - 1, -PLACES, -1):
        queue = BucketQueue(folder, f"place{place}")
        since = np.full(END + 1, -1, np.int64)                  # least prefix since the last push of a byte
        for ids, prefix in source:
            byte = s.bytes_at(ids, place)
            order = np.argsort(byte, kind="stable")
            b = byte[order]
            induced = np.zeros(len(ids), np.int64)
            chained = np.r_[False, b[1:] == b[:-1]]
            at = np.flatnonzero(chained)
            induced[at] = _least_between(prefix, order[at - 1], order[at]).astype(np.int64) + 1
            running = np.minimum.accumulate(prefix).astype(np.int64)
            for k in np.flatnonzero(~chained):                  # first of its byte in this piece
                if since[b[k]] >= 0:
                    induced[k] = min(since[b[k]], running[order[k]]) + 1
            induced[b == END] = 0
            back = np.empty(len(ids), np.int64)
            back[order] = induced
            since = np.where(since >= 0, np.minimum(since, running[-1]), -1)
            tail = np.minimum.accumulate(prefix[::-1])[::-1].astype(np.int64)
            for k in np.flatnonzero(np.r_[b[1:] != b[:-1], True]):   # last of its byte
                since[b[k]] = tail[order[k] + 1] if order[k] + 1 < len(ids) else LENGTH
            keep = (byte != END) | (place > 0)
            queue.push(byte[keep], ids[keep], np.minimum(back, LENGTH)[keep])
        if place > 0:
            source = queue.pieces(piece)
            continue
        following = BucketQueue(folder, f"read{place}")
        run_ids, run_best = [], None                            # a run of equal windows, and its earliest

        def settle():
            later = [x for x in run_ids if x != run_best[1]]
            return np.array(later, np.int64)

        for ids, prefix in queue.pieces(piece):
            byte = s.bytes_at(ids, place)
            following.push(byte, ids, prefix)
            keys, anchors = age_of(ids)
            for i, p, k, a in zip(ids.tolist(), prefix.tolist(), keys.tolist(), anchors.tolist()):
                if p < LENGTH:
                    if len(run_ids) > 1:
                        yield settle(), place
                    run_ids, run_best = [i], ((k, a), i)
                else:
                    if (k, a) < run_best[0]:
                        run_best = ((k, a), i)
                    run_ids.append(i)
                    if len(run_ids) > piece:                    # bounded: all but the best are settled
                        yield settle(), place
                        run_ids = [run_best[1]]
        if len(run_ids) > 1:
            yield settle(), place
        source = following.pieces(piece)


def sort_shard(s: Snippets, folder: str, memory_rows: int = 1 << 19):
    """Repeated windows of a shard as arrays (key, start in the text), anchor groups in chunks."""
    n, a = len(s.gram), 0
    while a < n:
        b = min(n, a + memory_rows)
        if b < n:
            ends = np.flatnonzero(s.gram[a + 1:b + 1] != s.gram[a:b])
            if len(ends):
                b = a + 1 + int(ends[-1])
            else:                                               # one anchor beyond the memory
                while b < n and s.gram[b] == s.gram[a]:
                    step = s.gram[b:b + memory_rows] != s.gram[a]
                    b += int(np.argmax(step)) if step.any() else len(step)
        part = s.part(a, b) if b - a <= memory_rows else Snippets(
            s.gram[a:b], s.key[a:b], s.start[a:b], s.anchor[a:b], s.windows[a:b], s.offset[a:b + 1], s.data)
        found = (sort_group_in_memory(part) if b - a <= memory_rows
                 else sort_group_on_disk(part, folder, memory_rows))
        for ids, place in found:
            yield np.asarray(part.key[ids]), np.asarray(part.anchor[ids]) + place
        a = b


def induced_spans(found: DataFrame, shards: int, memory_rows: int = 1 << 19) -> DataFrame:
    """(key, start, end) of repeated windows among snippets (gram, key, start, anchor, windows, body)."""
    names = ["gram", "key", "start", "anchor", "windows"]

    def work(batches):
        schema = pa.schema([("key", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])
        with tempfile.TemporaryDirectory() as folder:           # this task's own spill files
            files = {c: open(os.path.join(folder, c), "wb") for c in [*names, "size", "data"]}
            n, last = 0, None
            for batch in batches:
                if not batch.num_rows:
                    continue
                # repeated rows bring the same snippet again: it counts once
                place = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("gram", "key", "start")], 1)
                before = np.vstack([place[:1] - 1 if last is None else last, place[:-1]])
                last = place[-1:]
                batch = batch.filter(pa.array((place != before).any(1)))
                for c in names:
                    files[c].write(batch.column(c).to_numpy().astype(np.int64).tobytes())
                bodies = batch.column("body").to_pylist()
                files["size"].write(np.array([len(x) for x in bodies], np.int64).tobytes())
                files["data"].write(b"".join(bodies))
                n += batch.num_rows
            for f in files.values():
                f.close()
            if not n:
                return
            mapped = [np.memmap(os.path.join(folder, c), np.int64, "r") for c in names]
            offset = np.r_[0, np.cumsum(np.memmap(os.path.join(folder, "size"), np.int64, "r"))]
            s = Snippets(*mapped, offset, np.memmap(os.path.join(folder, "data"), np.uint8, "r"))
            held, count = [], 0

            def merged():
                key, start = (np.concatenate(x) for x in zip(*held))
                order = np.lexsort((start, key))
                ranks, doc = np.unique(key[order], return_inverse=True)
                d, a, b = _spans(doc, start[order], start[order] + LENGTH)
                return rows(schema, ranks[d], a.astype(np.int32), b.astype(np.int32))

            for key, start in sort_shard(s, folder, memory_rows):
                held.append((key, start))
                count += len(key)
                if count > 1 << 21:
                    yield merged()
                    held, count = [], 0
            if held:
                yield merged()

    return (found.withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(shards)))
            .repartition(shards, "shard").sortWithinPartitions("gram", "key", "start")
            .mapInArrow(work, "key long, start int, end int"))


def removed_spans(docs: DataFrame, memory_rows: int = 1 << 19, shard_rows: int = 1 << 17) -> DataFrame:
    """(key, start, end) of removed bytes, spans of one key may overlap. ``docs`` has (key, text)."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    settled = materialize(settle_copies(each_snippet(docs), partitions), "snippets")
    whole = settled.where("gram is null").select("key", "start", (F.col("start") + F.col("windows")).alias("end"))
    several = settled.where("gram is not null")
    wanted = several.groupBy("key").agg(F.collect_list(F.struct("gram", "start", "anchor", "windows")).alias("wanted"))

    def bodies(batches):
        schema = pa.schema([("gram", pa.int64()), ("key", pa.int64())]
                           + [(c, pa.int32()) for c in ("start", "anchor", "windows")] + [("body", pa.binary())])
        for batch in slices(batches, 4 << 20):
            out = []
            for key, text, parts in zip(batch.column(0).to_pylist(), texts_as_bytes(batch.column(1)),
                                        batch.column(2).to_pylist()):
                out += [(p["gram"], key, p["start"], p["anchor"], p["windows"],
                         text[p["start"]:p["start"] + p["windows"] + LENGTH - 1]) for p in parts]
            if out:
                yield rows(schema, *zip(*out))

    found = docs.join(wanted, "key").select("key", "text", "wanted").mapInArrow(
        bodies, "gram long, key long, start int, anchor int, windows int, body binary")
    shards = max(64, -(-several.count() // shard_rows))
    return whole.unionByName(induced_spans(found, shards, memory_rows))


def row_keys(named: DataFrame) -> DataFrame:
    """(doc_id, key, text) from (doc_id, text): a key names one text and orders by id. The id
    itself serves where each has one text and none is null; otherwise keys are places in the
    order of (id, text hash), null ids last."""
    tagged = named.withColumn("tag", F.xxhash64("text"))
    unclear = tagged.groupBy("doc_id").agg(F.min("tag").alias("a"), F.max("tag").alias("b")).where("doc_id is null or a < b")
    if unclear.isEmpty():
        return named.select("doc_id", F.col("doc_id").alias("key"), "text")
    placed = materialize(tagged.select(F.col("doc_id").alias("id"), F.col("tag").alias("id_tag")).distinct()
                         .orderBy(F.col("id").asc_nulls_last(), "id_tag")
                         .withColumn("key", F.monotonically_increasing_id()), "row-keys")
    return materialize(tagged.join(placed, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("tag") == F.col("id_tag")))
                       .select("doc_id", "key", "text"), "keyed-texts")


def remove_repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False,
                            memory_rows: int = 1 << 19) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row (and ``kept``, binary, on request).

    A null text is empty. Rows with the same id (or none) and the same text are not copies of
    each other and give repeated results. Different texts of one id are different documents, in
    the order of their hashes; rows without id come last, in the same order. Texts shorter than ``LENGTH`` stay whole. Other columns are ignored.
    """
    named = row_keys(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    spans = removed_spans(named.select("key", "text"), memory_rows)
    per_key = spans.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def cut(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                            ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
                           + [("kept", pa.binary())] * keep_text)
        for batch in slices(batches, 4 << 20):
            out = []
            for doc, text, found in zip(batch.column(0).to_pylist(), texts_as_bytes(batch.column(1)),
                                        batch.column(2).to_pylist()):
                at, n_spans, parts = 0, 0, []
                for a, b in sorted((x["start"], min(x["end"], len(text))) for x in found or ()):
                    if a >= len(text):
                        continue
                    if a > at or not n_spans:
                        parts.append(text[at:a])
                        n_spans += 1
                    at = max(at, b)
                parts.append(text[at:])
                kept = b"".join(parts)
                row = (doc, len(text), len(text) - len(kept), n_spans, hashlib.sha256(kept).hexdigest())
                out.append(row + (kept,) if keep_text else row)
            if out:
                yield rows(schema, *zip(*out))

    return (named.join(per_key, "key", "left").select("doc_id", "text", "spans")
            .mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                        + (", kept binary" if keep_text else "")))


def op6_induced_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` without bytes of 100-byte strings that start earlier."""
    return remove_repeated_strings(table(spark, sf_dir, "documents"))


# strings of 100 bytes stand as 200 hexadecimal digits, cut out of two neighbouring pieces
ORACLE = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, ''))::BIGINT AS n FROM documents),
piece AS (
  SELECT doc_id, k, s || coalesce(lead(s) OVER (PARTITION BY doc_id ORDER BY k), '') AS s
  FROM (SELECT doc_id, unnest(l) AS s, unnest(range(len(l))) AS k
        FROM (SELECT doc_id, regexp_extract_all(x, '.{1,200}') AS l FROM d))),
gram AS MATERIALIZED (
  SELECT doc_id, 100 * k + j AS p, md5_number(s[2 * j + 1:2 * j + 200]) AS h
  FROM (SELECT doc_id, k, s, unnest(range(0, least(100, len(s) // 2 - 99))) AS j FROM piece WHERE len(s) >= 200)),
again AS (
  SELECT g.doc_id, g.p FROM gram g
  JOIN (SELECT h, min(struct_pack(doc_id, p)) AS first FROM gram GROUP BY h HAVING count(*) > 1) USING (h)
  WHERE struct_pack(doc_id := g.doc_id, p := g.p) > first),
run AS (
  SELECT doc_id, min(p) AS a, max(p) + 100 AS b
  FROM (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS i
        FROM (SELECT doc_id, p, (p > coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100, -1))::INT AS fresh FROM again))
  GROUP BY doc_id, i),
gap AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b
  FROM (SELECT * FROM run UNION ALL SELECT doc_id, n, n FROM d)),
kept AS (SELECT doc_id, string_agg(substr(x, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS y FROM gap JOIN d USING (doc_id) GROUP BY doc_id),
gone AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans FROM run GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(y)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)
"""
