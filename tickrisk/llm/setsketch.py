"""Near-duplicate documents by SetSketch registers.

A document is the set of its distinct word shingles. Register i of its sketch is the
smallest of the set's i-th hash values, seen as an exponential variable and truncated
to a power of ``BASE``: floor(1 - log_BASE(x)). Registers of a union are the maxima
of the parts' registers, and two sets share a register with a probability that rises
with their similarity. Bands of registers propose pairs, the likelihood of the
registers' order gives a joint estimate that discards hopeless pairs, and links are
confirmed on the full sets.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickrisk.llm.common import groups, mix64, per_worker, rows, slices, smallest_reachable, table, texts_as_bytes
from tickrisk.llm.components import joined_components
from tickrisk.plans.materialize import materialize

BASE, RATE = 1.02, 20.0          # register base b; rate of the exponential variables
BANDS, PER_BAND = 24, 4          # misses a pair of similarity 0.8 with (1 - 0.8 ** 4) ** 24 = 3e-6
REGISTERS = BANDS * PER_BAND
HOPELESS = 0.3                   # an estimate this far below the threshold is 7 standard errors off


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= 200_000:
            self.clear()
        if len(word) <= 64:
            self[word] = h
        return h


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text: ASCII letters lower-cased, words
    between ASCII white space; a text of fewer than ``size`` words is one shingle, a text
    without words none."""
    hashes = per_worker(("word-hashes",), _WordHashes)
    split = [t.lower().split() for t in texts]
    n = np.array([len(s) for s in split], np.int64)
    w = np.fromiter(map(hashes.__getitem__, chain.from_iterable(split)), np.uint64, int(n.sum()))
    del split
    out, ends = [], np.cumsum(n)
    with np.errstate(over="ignore"):
        if len(w) >= size:
            h = np.full(len(w) - size + 1, size, np.uint64)
            for k in range(size):
                h = mix64(h + w[k:len(w) - size + 1 + k])
        for end, count in zip(ends.tolist(), n.tolist()):
            if count >= size:
                out.append(np.unique(h[end - count:end - size + 1]))
            elif count:
                one = np.uint64(1000 + count)
                for x in w[end - count:end]:
                    one = mix64(np.array([one + x]))[0]
                out.append(np.array([one], np.uint64))
            else:
                out.append(np.empty(0, np.uint64))
    return out


def register_seeds(m: int = REGISTERS) -> tuple[np.ndarray, np.ndarray]:
    x = np.arange(1, 2 * m + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        x = mix64(x * np.uint64(0x9E3779B97F4A7C15))
    return x[:m] | np.uint64(1), x[m:]


def sketch(sets: list[np.ndarray], m: int = REGISTERS) -> np.ndarray:
    """uint16 registers, one row per set; an empty set has zeros."""
    n = np.array([len(s) for s in sets], np.int64)
    out = np.zeros((len(sets), m), np.uint16)
    some = np.flatnonzero(n)
    if not len(some):
        return out
    flat = np.concatenate([sets[i] for i in some])
    begins = np.r_[0, np.cumsum(n[some])[:-1]]
    a, b = register_seeds(m)
    least = np.empty((len(some), m))
    with np.errstate(over="ignore"):
        for i in range(m):
            least[:, i] = np.minimum.reduceat(flat * a[i] + b[i], begins)
    x = -np.log1p(-np.minimum((least + 1) / 2.0 ** 64, 1 - 2.0 ** -53)) / RATE
    out[some] = np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 1, 65535)
    return out


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def joint_estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Likeliest Jaccard similarity (to 0.01) of pairs of registers (rows), from how many
    registers of ``a`` are greater, less or equal, and the sets' sizes."""
    up, down = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - up - down
    u = na / (na + nb)
    v = 1 - u
    j = np.linspace(0, 1, 101)[None, :]

    def chance(x):                 # that the register with share x of the union is greater
        return -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)

    pu, pd = chance(u[:, None] - v[:, None] * j), chance(v[:, None] - u[:, None] * j)
    p0 = np.clip(1 - pu - pd, 1e-12, 1)
    score = up[:, None] * np.log(pu) + down[:, None] * np.log(pd) + same[:, None] * np.log(p0)
    score[j > np.minimum(u / v, v / u)[:, None] + 1e-9] = -np.inf
    return j[0, np.argmax(score, 1)]


def sketch_table(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, tag (hash of the text), n_shingles, a 128-bit digest of the set (h1, h2) and the
    registers of every row."""
    def work(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("n_shingles", pa.int64()), ("h1", pa.int64()),
                            ("h2", pa.int64()), ("registers", pa.binary())])
        for batch in slices(batches, 4 << 20):
            sets = shingle_sets(texts_as_bytes(batch.column(1)), size)
            registers = sketch(sets).astype("<u2")
            with np.errstate(over="ignore"):
                h1 = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                h2 = np.array([mix64(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            yield rows(schema, batch.column(0), batch.column(2), [len(s) for s in sets], h1, h2,
                       [r.tobytes() for r in registers])

    text = F.col(text_col).cast("string")
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tag"))
            .mapInArrow(work, "doc_id long, tag long, n_shingles long, h1 long, h2 long, registers binary"))


def band_table(classes: DataFrame) -> DataFrame:
    """(key, node): one row per band of each class."""
    def work(batches):
        import xxhash
        schema = pa.schema([("key", pa.int64()), ("node", pa.int64())])
        width = 2 * PER_BAND
        for batch in batches:
            keys = [xxhash.xxh3_64_intdigest(r[i * width:(i + 1) * width], seed=i)
                    for r in batch.column(1).to_pylist() for i in range(BANDS)]
            yield rows(schema, np.array(keys, np.uint64).view(np.int64),
                       np.repeat(batch.column(0).to_numpy(), BANDS))

    return classes.select("node", "registers").mapInArrow(work, "key long, node long")


def hopeful(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes allow ``percent`` and whose estimate is not hopeless."""
    def side(name):
        return classes.select(F.col("node").alias(name), F.col("registers").alias(f"r{name}"),
                              F.col("n_shingles").alias(f"n{name}"))

    def work(batches):
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for batch in batches:
            if not batch.num_rows:
                continue
            ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS)
                      for c in ("ra", "rb"))
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            good = pa.array(joint_estimate(ra, rb, na, nb) >= percent / 100 - HOPELESS)
            yield rows(schema, batch.column("a").filter(good), batch.column("b").filter(good))

    return (pairs.join(side("a"), "a").where("na > 0")
            .join(side("b"), "b").where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
            .mapInArrow(work, "a long, b long"))


def confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs with 100 * |intersection| >= percent * |union| on the full shingle sets.
    ``texts`` has (node, text)."""
    def work(batches):
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for batch in slices(batches, 2 << 20):
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            ta, tb = texts_as_bytes(batch.column("ta")), texts_as_bytes(batch.column("tb"))
            distinct = list({*ta, *tb})
            sets = dict(zip(distinct, shingle_sets(distinct, size)))
            good = []
            for x, y in zip(ta, tb):
                sx, sy = sets[x], sets[y]
                both = len(np.intersect1d(sx, sy, assume_unique=True))
                good.append(100 * both >= percent * (len(sx) + len(sy) - both) > 0)
            yield rows(schema, [v for v, g in zip(a, good) if g], [v for v, g in zip(b, good) if g])

    def side(name):
        return texts.select(F.col("node").alias(name), F.col("text").alias(f"t{name}"))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb").mapInArrow(
        work, "a long, b long")


def shared_counts(texts: DataFrame, size: int) -> DataFrame:
    """(node, lone): how many of a node's shingles no other node of ``texts`` has (nodes
    with at least one such)."""
    def work(batches):
        schema = pa.schema([("hash", pa.int64()), ("node", pa.int64())])
        for batch in slices(batches, 1 << 20):
            sets = shingle_sets(texts_as_bytes(batch.column("text")), size)
            n = [len(s) for s in sets]
            yield rows(schema, np.concatenate(sets).view(np.int64) if sets else [],
                       np.repeat(batch.column("node").to_numpy(), n))

    each = texts.select("node", "text").mapInArrow(work, "hash long, node long")
    return (each.groupBy("hash").agg(F.count("*").alias("n"), F.min("node").alias("node")).where("n = 1")
            .groupBy("node").agg(F.count("*").alias("lone")))


def unsettled_links(mixed: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int,
                    block: int = 1024) -> DataFrame:
    """Links (a, b) between classes of one bucket and different components, as many as tell what is
    reachable. Buckets are compared block by block inside tasks, on full sets, and only links leave.

    ``mixed`` has (key, node, label). A shingle that only one of the open nodes has is in no
    intersection, so that of two nodes is at most the smaller count of shared shingles, s, and a
    link needs (100 + percent) * s >= percent * (size of the one + size of the other). Nodes for
    which even the bucket's smallest set is too large are dropped first. No link is lost. A task holds
    two blocks at a time; the work within one bucket of m such classes grows with m * m, its memory
    and its rows (m * m / block) do not."""
    open_texts = texts.join(mixed.select("node").distinct(), "node", "left_semi")
    lone = shared_counts(open_texts, size)
    sized = (classes.select("node", F.col("n_shingles").alias("n")).join(lone, "node", "left")
             .select("node", "n", (F.col("n") - F.coalesce("lone", F.lit(0))).alias("s")))
    placed = mixed.select("key", "node", "label").join(sized, "node")
    least = placed.groupBy("key").agg(F.min("n").alias("least"))
    able = materialize(placed.join(least, "key").where(f"{100 + percent} * s >= {percent} * (n + least)")
                       .drop("least"), "able")
    still = able.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                    F.count("*").alias("classes"), F.sum("n").alias("total")).where("low < high")
    # blocks of a bucket: about ``block`` classes and 2 ** 20 shingles each
    blocks = F.greatest(F.ceil(F.col("classes") / block), F.ceil(F.col("total") / (1 << 20))).cast("int")
    met = (able.join(still.select("key", blocks.alias("blocks")), "key")
           .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
           .select("key", "node", "label", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
           .select("key", "node", "label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                   F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side")))
    sets = materialize(set_table(open_texts.join(able.select("node").distinct(), "node", "left_semi"), size), "sets")

    def compare(batches):
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for group in groups(slices(batches, 4 << 20), ["key", "i", "j"]):
            node, label, side = (group.column(c).to_numpy() for c in ("node", "label", "side"))
            found = linked([np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()],
                           label, side, percent)
            if len(found[0]):
                # what they reach is told by one link a class; the others follow from it
                root = smallest_reachable(len(node), *found)
                told = np.flatnonzero(root != np.arange(len(node)))
                yield rows(schema, node[root[told]], node[told])

    return (met.join(sets, "node").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(compare, "a long, b long"))


def set_table(texts: DataFrame, size: int) -> DataFrame:
    """(node, shingles): the sorted distinct shingle hashes of (node, text)."""
    def work(batches):
        schema = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])
        for batch in slices(batches, 1 << 20):
            yield rows(schema, batch.column("node"), [s.tobytes() for s in shingle_sets(texts_as_bytes(batch.column("text")), size)])

    return texts.select("node", "text").mapInArrow(work, "node long, shingles binary")


def linked(sets: list[np.ndarray], label: np.ndarray, side: np.ndarray, percent: int,
           width: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of different labels whose sets reach ``percent``; sides 0 and 1 meet each other
    only, 2 meets all. Intersections are counted for all pairs at once, ``width`` shingles
    at a time."""
    n = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    who = np.repeat(np.arange(len(sets)), n)
    _, number, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[number] > 1                               # others are in no intersection
    number = (np.cumsum(count > 1) - 1)[number[shared]]
    order = np.argsort(number, kind="stable")
    number, who = number[order], who[shared][order]
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    both = np.zeros((len(left), len(right)), np.int64)
    for a in range(0, int(number[-1]) + 1 if len(number) else 0, width):
        lo, hi = np.searchsorted(number, [a, a + width])
        held = np.zeros((len(sets), width), np.float32)
        held[who[lo:hi], number[lo:hi] - a] = 1
        both += (held[left] @ held[right].T).astype(np.int64)
    good = 100 * both >= percent * (n[left][:, None] + n[right][None, :] - both)
    good &= label[left][:, None] != label[right][None, :]
    i, j = np.nonzero(good)
    return left[i], right[j]


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, star_rounds: int = 3,
                    block: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Rows with equal sets form one class, told by a text of its smallest id; only classes are compared.
    A bucket (classes that share a band) is first compared with its smallest class; classes
    joined by confirmed links share a component. In further rounds, classes outside the
    component of the bucket's smallest class are compared with another of its members.
    Last, classes of one bucket that are still in different components are compared
    with each other, if their sizes and shared shingles allow a link at all
    (``unsettled_links``). So no pair of a bucket that could join two components is left
    out, while a large group of copies costs a few comparisons per member, not all pairs.

    A null, empty or blank text has no shingles and links with nothing. A row without id
    links with nothing and has no component; it is kept. Texts that share an id are classes of
    their own, each compared as itself; a link to one of them is a link to the id.
    Other columns are ignored.
    """
    sketches = materialize(sketch_table(docs, size, id_col, text_col), "sketches")
    classes = materialize(
        sketches.where("n_shingles > 0 and doc_id is not null").groupBy("h1", "h2", "n_shingles")
        .agg(F.min(F.struct("doc_id", "tag")).alias("c"), F.min("registers").alias("registers"))
        .select("h1", "h2", "n_shingles", "registers", F.col("c.doc_id").alias("low"), F.col("c.tag").alias("tag")), "classes")
    classes = numbered_classes(classes)
    bands = materialize(band_table(classes), "bands")
    buckets = bands.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last")
    members = materialize(bands.join(buckets.select("key"), "key"), "members")

    # texts of the classes that share a bucket
    active = classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "low", "tag")
    told = F.col(text_col).cast("string")
    named = docs.select(F.col(id_col).cast("long").alias("low"), told.alias("text"), F.xxhash64(told).alias("tag"))
    texts = materialize(named.join(active, ["low", "tag"]).groupBy("node").agg(F.min("text").alias("text")), "texts")

    roots = None
    for turn in range(star_rounds + 1):
        placed = members.select("key", "node", F.col("node").alias("label"))
        if roots is not None:
            placed = materialize(members.join(roots, "node", "left").select(
                "key", "node", F.coalesce("root", "node").alias("label")), "placed")
        open_ = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
        mixed = materialize(placed.join(open_.select("key", "low"), "key"), "mixed")
        if turn < star_rounds:
            # the centre is a member of the bucket's lowest component, another one each round
            rank = F.struct((F.xxhash64("node", F.lit(turn)) if turn else F.lit(0)).alias("h"), "node")
            centres = (mixed.where("label = low").groupBy("key").agg(F.min(rank).alias("c"))
                       .select("key", F.col("c.node").alias("a")))
            pairs = mixed.where("label > low").join(centres, "key").select(
                F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"))
            found = confirm(hopeful(pairs.distinct(), classes, percent), texts, size, percent)
        else:
            found = unsettled_links(mixed, classes, texts, size, percent, block)
        roots = joined_components(roots, materialize(found, "links"))

    # nodes are in the order of their smallest ids, so the smallest node of a component has its smallest id
    placed = classes.select("h1", "h2", "n_shingles", "node", "low").join(roots, "node", "left")
    lows = classes.select(F.col("node").alias("root"), F.col("low").alias("root_low"))
    placed = placed.join(lows, "root", "left").select(
        F.col("h1").alias("c1"), F.col("h2").alias("c2"), F.col("n_shingles").alias("cn"),
        F.coalesce("root_low", "low").alias("component"))
    named = sketches.join(placed, (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2"))
                          & (F.col("n_shingles") == F.col("cn")) & F.col("doc_id").isNotNull(), "left")
    component = F.coalesce("component", "doc_id")
    return named.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def numbered_classes(classes: DataFrame) -> DataFrame:
    """Adds ``node``: a number of each class, in the order of the smallest ids. That is this id itself
    while no two classes share it; else the class's place, counted over sorted partitions."""
    if classes.groupBy("low").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return classes.withColumn("node", F.col("low"))
    # sorted once and written; each file holds a range
    parts = materialize(classes.repartitionByRange("low", "h1", "h2", "n_shingles").withColumn(
        "part", F.spark_partition_id()), "class-parts")
    sizes = parts.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.select("part", F.sum("n").over(Window.orderBy("part")).alias("upto"), "n").select(
        "part", (F.col("upto") - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("low", "h1", "h2", "n_shingles"))
    return materialize(parts.withColumn("place", place).join(F.broadcast(before), "part")
                       .withColumn("node", F.col("place") + F.col("before")).drop("part", "place", "before"), "classes")


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns. Rows without id stay."""
    gone = (near_duplicates(docs, size, percent, id_col=id_col, text_col=text_col)
            .where("not kept").select(F.col("doc_id").alias("_gone")).distinct())
    columns = docs.columns
    named = docs.select(*[F.col(f"`{c}`").alias(f"in{i}") for i, c in enumerate(columns)])
    key = F.col(f"in{columns.index(id_col)}").cast("long")
    left = named.join(gone, key == F.col("_gone"), "left_anti")
    return left.select(*[F.col(f"in{i}").alias(c) for i, c in enumerate(columns)])


def op5_setsketch_neardup(spark, sf_dir: str) -> DataFrame:
    """Near-duplicates of ``documents`` on 4-word shingles, similarity 0.8 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


ORACLE = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT r, array_to_string(w[a:a + n - 1], ' ') AS t
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS a
        FROM (SELECT r, w, least(len(w), 4) AS n FROM d WHERE len(w) > 0))),
size AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
link AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.r AS a, y.r AS b, count(*) AS m FROM s x JOIN s y ON x.t = y.t AND x.r <> y.r GROUP BY x.r, y.r)
  JOIN size p ON p.r = a JOIN size q ON q.r = b
  WHERE 100 * m >= 80 * (p.n + q.n - m)),
reach AS (
  SELECT r AS a, r AS b FROM d
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
low AS (SELECT a AS r, min(doc_id) AS component_id FROM reach JOIN d ON d.r = reach.b GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM d JOIN low USING (r) LEFT JOIN size USING (r)
"""
