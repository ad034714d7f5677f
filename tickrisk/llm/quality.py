"""Quality rules: fixed rules on document statistics, then boosted trees.

The trees learn P(good) from labelled documents (``labels.quality``) and may
only see the score fall as repetition and symbols rise. Statistics of a document are computed
where its text is read; the only rows that reach the driver are those of the
training sample, whose size is the parameter ``sample``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickrisk.llm.boosting import Forest, fit
from tickrisk.llm.common import rows, slices, table, texts_as_bytes

BLANK = bytes([0x20, *range(0x09, 0x0E)])                    # separators of words
NOT_STARTING = bytes(range(0x80, 0xC0))                      # UTF-8 bytes that start no code point
SYMBOLS = b"#*$%&|<>"
WINDOW = 5

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# statistic -> direction in which P(good) may change with it (0: either)
FEATURES = {"log_words": 0, "chars_per_word": 0, "symbol_share": -1, "dup_line_share": -1,
            "repeat_share": -1, "distinct_share": 0, "top_word_share": -1, "entropy": 0,
            "digit_share": 0, "upper_share": 0, "mark_share": 0, "words_per_line": 0, "non_ascii_share": 0}


class _Numbered(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _found_twice(words: np.ndarray, doc: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mask of words in 5-word windows that their document holds twice or more.

    Windows are sorted by a 64-bit hash; those that share one are compared by their words."""
    covered = np.zeros(len(words), bool)
    n = len(words) - WINDOW + 1
    if n <= 0:
        return covered
    starts = np.flatnonzero(np.arange(n) + WINDOW <= ends[doc[:n]])
    with np.errstate(over="ignore"):
        h = doc[starts].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(WINDOW):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + words[starts + k].astype(np.uint64)
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    shared = np.zeros(len(order), bool)
    shared[1:] |= same
    shared[:-1] |= same
    at = np.sort(starts[order[shared]])
    if not len(at):
        return covered
    columns = [words[at + k] for k in range(WINDOW)] + [doc[at]]
    order = np.lexsort(columns)
    same = np.logical_and.reduce([c[order][1:] == c[order][:-1] for c in columns])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = at[order[twice]]
    for k in range(WINDOW):
        covered[hit + k] = True
    return covered


def statistics(texts: list[bytes]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Counts (name -> int64 array) and the feature matrix of whole texts."""
    n = len(texts)
    number = _Numbered()
    split = [t.split() for t in texts]
    n_words = np.array([len(s) for s in split], np.int64)
    words = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64, int(n_words.sum()))
    del split
    ends = np.cumsum(n_words)
    doc = np.repeat(np.arange(n), n_words)
    covered = _found_twice(words, doc, ends)
    repeat = np.bincount(doc[covered], minlength=n)

    size = lambda delete: np.array([len(t.translate(None, delete)) for t in texts], np.int64)
    n_bytes = np.array([len(t) for t in texts], np.int64)
    chars = size(NOT_STARTING)
    word_chars = size(BLANK + NOT_STARTING)
    symbols, digits = n_bytes - size(SYMBOLS), n_bytes - size(b"0123456789")
    upper, marks = n_bytes - size(bytes(range(65, 91))), n_bytes - size(b".,;:!?")
    non_ascii = chars - size(bytes(range(0x80, 0x100)))
    dup, lines = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i, t in enumerate(texts):
        own = [x for x in t.split(b"\n") if x.strip()]
        lines[i] = len(own)
        dup[i] = len(own) - len(set(own))

    # distinct words, most frequent word, entropy of words
    distinct, top, entropy = np.zeros(n), np.zeros(n), np.zeros(n)
    if len(words):
        key = np.sort(doc * len(number) + words)
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        count = np.diff(np.r_[first, len(key)])
        owner = key[first] // len(number)
        begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        who = owner[begins]
        distinct[who] = np.diff(np.r_[begins, len(owner)])
        top[who] = np.maximum.reduceat(count, begins)
        share = count / n_words[owner]
        entropy[who] = np.add.reduceat(-share * np.log2(share), begins)

    of = lambda a, b: a / np.maximum(b, 1)
    counts = dict(zip(COUNTS, (n_words, word_chars, symbols, dup, repeat)))
    features = np.stack([np.log1p(n_words), of(word_chars, n_words), of(symbols, chars), of(dup, lines),
                         of(repeat, n_words), of(distinct, n_words), of(top, n_words), entropy,
                         of(digits, chars), of(upper, chars), of(marks, chars), of(n_words, lines),
                         of(non_ascii, chars)], 1)
    return counts, features


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < 10) | (100 * counts["n_repeat_words"] > 20 * counts["n_words"])


def train(docs: DataFrame, labels: DataFrame, sample: int = 20_000, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality") -> Forest | None:
    """Trees fitted on at most ``sample`` labelled documents (those with the smallest
    hash of their id). Rows without id or label are left out; an id labelled twice
    counts as bad if one label says so, one on several rows gives one (the smallest hash
    of the text). None if only one class is labelled."""
    chosen = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
              .groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.min(label_col).cast("double").alias("_y"))
              .orderBy(F.xxhash64("_id"), "_id").limit(sample))
    # at most ``sample`` rows of two numbers are broadcast
    joined = (docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
              .join(F.broadcast(chosen), "_id").groupBy("_id", "_y").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text"))
              .select("_text", "_y"))

    def measure(batches):
        schema = pa.schema([("y", pa.float64()), ("x", pa.list_(pa.float64()))])
        for batch in slices(batches):
            _, x = statistics(texts_as_bytes(batch.column(0)))
            yield rows(schema, batch.column(1), x.tolist())

    found = joined.mapInArrow(measure, "y double, x array<double>").orderBy("y", "x").toArrow()
    y = found.column("y").to_numpy()
    if len(np.unique(y > 0)) < 2:
        return None
    x = np.array(found.column("x").to_pylist())
    return fit(x, (y > 0).astype(float), list(FEATURES.values()))


def _verdicts(texts: list[bytes], model: Forest | None, threshold: float):
    counts, x = statistics(texts)
    failed = base_failed(counts)
    score = model.probability(x) if model is not None else np.ones(len(texts))
    return counts, failed, score, ~failed & (score >= threshold)


def judge(docs: DataFrame, model: Forest | None, threshold: float = 0.5, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per document: id, counts, base_failed, kept, score (P(good)).

    A null or empty text has no words and fails the rules; repeated rows get equal
    rows each; other columns are ignored. Without a model the rules alone decide."""
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in COUNTS),
                        ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("score", pa.float64())])

    def work(batches):
        for batch in slices(batches):
            if batch.num_rows:
                counts, failed, score, kept = _verdicts(texts_as_bytes(batch.column(1)), model, threshold)
                yield rows(schema, batch.column(0), *(counts[c] for c in COUNTS), failed, kept, score)

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(work, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
                        + ", base_failed boolean, kept boolean, score double"))


def keep_good(docs: DataFrame, model: Forest | None, threshold: float = 0.5,
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns. Only the texts go to Python, and
    only the verdicts come back."""
    @F.arrow_udf("boolean")
    def good(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            verdicts = [pa.array([], pa.bool_())]
            for batch in slices(iter([pa.RecordBatch.from_arrays([part], ["text"])])):
                if batch.num_rows:
                    *_, kept = _verdicts(texts_as_bytes(batch.column(0)), model, threshold)
                    verdicts.append(pa.array(kept))
            yield pa.concat_arrays(verdicts)

    return docs.where(good(F.col(f"`{text_col}`").cast("string")))


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Every document of ``documents`` judged; trees trained on ``labels``."""
    docs = table(spark, sf_dir, "documents")
    return judge(docs, train(docs, table(spark, sf_dir, "labels")))
