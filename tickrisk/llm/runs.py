"""Periodic runs of words: maximal stretches in which words a period apart are equal.

Seeds and diagonals. A run with period q and at least ``least`` and 2q words matches itself on
the diagonal of lag q over at least max(least - q, q) words. So lags up to ``least`` are found
from k-grams of least // 2 words, and lags from k + 1 to 2k from k-grams of k words, k doubling: each run
holds such a k-gram and its copy q words later. Occurrence pairs of equal k-grams in one document
at those distances are seeds; a seed is extended along its diagonal in both directions, unless
the furthest place covered on its lag lies beyond it already.

Occurrences of a k-gram that follow each other within k // 2 words lie in one run of a shorter
period (a chain). Pairs inside a chain give no new run, and a match between two chains
reaches the end of one of them, so only pairs with the last occurrence of a chain are seeds: a
handful per word and length, also in texts of one repeated word.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickrisk.llm.common import mix64, rows, slices, table, texts_as_bytes


class _Numbered(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _ahead(w: np.ndarray, i: int, j: int, end: int) -> int:
    """How many words from ``i`` on equal those from ``j`` on, before ``end``."""
    n, step = 0, 32
    while j + n < end:
        size = min(step, end - j - n)
        differ = np.flatnonzero(w[i + n:i + n + size] != w[j + n:j + n + size])
        if len(differ):
            return n + int(differ[0])
        n, step = n + size, 4 * step
    return n


def _behind(w: np.ndarray, i: int, j: int, begin: int) -> int:
    """How many words before ``i`` equal those before ``j``, from ``begin`` on."""
    n, step = 0, 32
    while i - n > begin:
        size = min(step, i - n - begin)
        differ = np.flatnonzero(w[i - n - size:i - n] != w[j - n - size:j - n])
        if len(differ):
            return n + size - 1 - int(differ[-1])
        n, step = n + size, 4 * step
    return n


def _smaller_period(w: np.ndarray, start: int, q: int) -> bool:
    """Whether a stretch of at least 2q words with period q has a smaller one (a divisor of q)."""
    rest, p = q, 2
    while rest > 1:
        if p * p > rest:
            p = rest
        if rest % p == 0:
            while rest % p == 0:
                rest //= p
            d = q // p
            if np.array_equal(w[start:start + q], w[start + d:start + d + q]):
                return True
        p += 1
    return False


def _pairs(key: np.ndarray, at: np.ndarray, k: int, low: int, high: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, lag) of the occurrence pairs of equal keys, low <= lag <= high, with the last
    occurrence of a chain on one side and different chains on both. ``key``, ``at``: sorted
    by (key, at); ``size``: above all places."""
    n = len(at)
    group = np.cumsum(np.r_[0, key[1:] != key[:-1]])
    place = group * (size + high + 1) + at                   # apart: groups never meet within ``high``
    last = np.r_[(np.diff(place) > k // 2), True]
    chain_of = np.cumsum(np.r_[0, last[:-1]])
    ends = np.flatnonzero(last)
    found_i, found_q = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for forward in (True, False):
        if forward:
            lo, hi = np.searchsorted(place, place[ends] + low), np.searchsorted(place, place[ends] + high, "right")
        else:
            lo, hi = np.searchsorted(place, place[ends] - high), np.searchsorted(place, place[ends] - low, "right")
        count = hi - lo
        own = np.repeat(ends, count)
        other = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        good = chain_of[own] != chain_of[other]
        own, other = own[good], other[good]
        i, j = (own, other) if forward else (other, own)
        found_i.append(at[i])
        found_q.append(at[j] - at[i])
    return np.concatenate(found_i), np.concatenate(found_q)


def _near_pairs(key: np.ndarray, at: np.ndarray, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, lag) of all occurrence pairs of equal keys at most ``high`` apart."""
    found_i, found_q = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for step in range(1, min(high, len(at) - 1) + 1):
        good = np.flatnonzero((key[step:] == key[:-step]) & (at[step:] - at[:-step] <= high))
        if not len(good):
            break
        found_i.append(at[good])
        found_q.append(at[good + step] - at[good])
    return np.concatenate(found_i), np.concatenate(found_q)


def runs_of(w: np.ndarray, ends: np.ndarray, least: int = 12) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each document, by start, then period. ``w``: word numbers of
    all documents, one after another; ``ends``: where each document ends."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in ends]
    begins = np.r_[0, ends[:-1]]
    k = least // 2
    if len(w) < least:
        return out
    with np.errstate(over="ignore"):
        h = np.full(len(w) - k + 1, k, np.uint64)
        for d in range(k):
            h = mix64(h + w[d:len(w) - k + 1 + d].astype(np.uint64))
    doc = np.searchsorted(ends, np.arange(len(h)), "right")
    at = np.flatnonzero(np.arange(len(h)) + k <= ends[doc])
    h, longest, first = h[at], int((ends - begins).max()), True
    while len(at):
        # the places whose k-gram is found twice in the document
        order = np.lexsort((at, h, doc[at]))
        key, place = h[order], at[order]
        same = (key[1:] == key[:-1]) & (doc[place[1:]] == doc[place[:-1]])
        twice = np.r_[False, same] | np.r_[same, False]
        key, place = np.cumsum(np.r_[0, ~same])[twice], place[twice]
        if not len(place):
            break
        i, lag = _near_pairs(key, place, least) if first else _pairs(
            key, place, k, max(k, least) + 1, 2 * k, len(w))
        seeds = np.unique(np.stack([doc[i], lag, i]), axis=1) if len(i) else np.empty((3, 0), np.int64)
        # neighbours on a diagonal are one seed
        fresh = np.r_[True, (np.diff(seeds[0]) != 0) | (np.diff(seeds[1]) != 0) | (np.diff(seeds[2]) != 1)][:seeds.shape[1]]
        covered: dict[tuple[int, int], int] = {}
        for d, q, a in seeds[:, fresh].T.tolist():
            if a < covered.get((d, q), 0):
                continue
            begin, end = int(begins[d]), int(ends[d])
            after = a + _ahead(w, a, a + q, end)
            covered[d, q] = after
            if after == a:                                    # two k-grams of one hash
                continue
            start = a - _behind(w, a, a + q, begin)
            length = after + q - start
            if length >= max(least, 2 * q) and not _smaller_period(w, start, q):
                out[d].append((start - begin, length, q))
        if not first:
            k *= 2
        else:
            # lags above ``least``: k-grams of ``least`` words, from two halves
            k, first = 2 * k, False
            if least % 2:                                     # an odd length has no two halves of it
                k = least - 1
        if k >= longest // 2 + 1:
            break
        half = k // 2
        held = np.zeros(len(w), bool)
        held[place] = True
        value = np.zeros(len(w), np.uint64)
        value[at] = h
        at = place[place + half < len(w)]
        at = np.sort(at[held[at + half] & (at + k <= ends[doc[at]])])
        with np.errstate(over="ignore"):
            h = mix64(value[at] * np.uint64(0x9E3779B97F4A7C15) + value[at + half] + np.uint64(k))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains after its first period, joined by spaces."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        change[start + q] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)])


def periodic_runs(docs: DataFrame, least: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length, period; word numbers from 0) and ``collapsed``, the text
    without the repeated periods, of every row.

    Words are what lies between ASCII white space. A run has its smallest period, at least ``least``
    words and at least two periods, and no neighbouring word continues it. A null text has no
    words; repeated rows are documents of their own; other columns are ignored. Documents are
    independent: there is no exchange, so hot sources and copies cost no more than others.
    """
    if least < 4:
        raise ValueError("least is at least 4")
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                        ("collapsed", pa.string())])

    def work(batches):
        for batch in slices(batches, 2 << 20):
            split = [t.split() for t in texts_as_bytes(batch.column(1))]
            n = np.array([len(s) for s in split], np.int64)
            number = _Numbered()
            w = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64, int(n.sum()))
            found = runs_of(w, np.cumsum(n), least)
            yield rows(schema, batch.column(0), n,
                       [[{"start": a, "length": b, "period": q} for a, b, q in runs] for runs in found],
                       pa.array([collapsed(s, runs) for s, runs in zip(split, found)], pa.binary()).cast(pa.string()))

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(work, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
                        "collapsed string"))


def with_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): texts in which a tenth of the ids repeats a stretch of words, by a rule on
    the checksum of the id. Rows without id or words stay as they are."""
    words = F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+", -1), lambda x: x != "")

    def body(w):
        n = F.size(w).cast("long")
        a = F.pmod(F.col("g"), F.greatest(n, F.lit(1)))
        p = F.floor((n - a) / (F.lit(3) + F.pmod(F.col("g"), F.lit(8)))) + 1

        def moved(a, p):
            return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(
                F.get(w, (a + F.pmod(i - a, p)).cast("int")))), " ")

        return F.transform(F.array(F.struct(a.alias("a"), p.alias("p"))), lambda s: moved(s["a"], s["p"]))[0]

    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .withColumn("h", h).withColumn("g", F.floor(F.col("h") / 10))
            .select("doc_id", F.when(F.col("text").isNotNull() & (F.pmod(F.col("h"), F.lit(10)) == 0),
                                     F.transform(F.array(words), body)[0]).otherwise(F.col("text")).alias("text")))


def _told(run: Column) -> Column:
    return F.concat_ws(",", run["start"], run["length"], run["period"])


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Every text of ``documents``, repeats put in by rule, and its runs of 12 words or more."""
    found = periodic_runs(with_repeats(table(spark, sf_dir, "documents")))
    # the longest run; ties: smallest start, then period
    top = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    told = F.array_join(F.transform("runs", lambda r: F.concat(_told(r), F.lit("\n"))), "")
    return (found.withColumn("top", top)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"),
                    F.col("top.length").alias("length"), (-F.col("top.period")).alias("period"),
                    F.floor(1000 * F.col("top.length") / -F.col("top.period")).cast("long").alias("exponent_milli"),
                    F.sha2(told, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))
