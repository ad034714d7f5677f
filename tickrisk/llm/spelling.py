"""Spelling variants: words one edit apart, by an index of variable-length grams.

A word is framed by a start and an end mark. Its gram at a place is the shortest substring of
at least two characters there that is no frequent gram, or has ``longest`` characters, or ends the word:
frequent grams are pruned from the dictionary in favour of their extensions, so lists
stay short. One inserted, deleted or replaced character changes only the grams that cover its
place; the largest number of these is the word's affected-gram bound. Two words one edit apart
share all but so many grams of each, so they meet in a list of the (bound + 1) rarest
grams of both. Only these lists are merged; words that meet there are verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickrisk.llm.common import rows, slices, table, texts_as_bytes
from tickrisk.plans.materialize import materialize

# [A-Za-zÀ-ÿ]+ of lower-cased UTF-8 (fixed value)
LETTERS = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")
START, END = "\x01", "\x02"
COUNTED = 200_000                     # distinct words counted in a task before they are sent on
MET = 1 << 20                         # pairs of a list that are looked at together


def damaged(word: bytes, prefix: int) -> bytes:
    """The word without one letter, where the checksum of id and word says so."""
    h = zlib.crc32(word, prefix)
    if h % 97:
        return word
    text = word.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1:]).encode()


def word_counts(docs: DataFrame, least_length: int = 5, damage: bool = False, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(word, n): occurrences of the words of at least ``least_length`` letters in all texts. With
    ``damage``, a letter is missing in some occurrences (``damaged``), in rows with an id."""
    def work(batches):
        schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
        total: Counter = Counter()

        def told():
            words = pa.array(list(total), pa.binary()).cast(pa.string())
            return rows(schema, words, list(total.values()))

        for batch in slices(batches):
            for doc, text in zip(batch.column(0).to_pylist(), texts_as_bytes(batch.column(1))):
                found = Counter(LETTERS.findall(text.lower()))
                start = zlib.crc32(b"%d:" % doc) if damage and doc is not None else None
                for word, n in found.items():
                    if len(word) < least_length:
                        continue
                    if start is not None:
                        word = damaged(word, start)
                    if len(word) - word.count(b"\xc3") >= least_length:
                        total[word] += n
                if len(total) >= COUNTED:
                    yield told()
                    total.clear()
        if total:
            yield told()

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))


def frequent_grams(words: DataFrame, longest: int, share: int = 2000) -> set[str]:
    """Grams of 2 to ``longest - 1`` characters at more than 1/``share`` of all places of their length.
    Fewer than ``share`` of each length by arithmetic, whatever the size of the data, so the
    set may be sent to every task. Every beginning of a frequent gram counts at least as often."""
    marked = F.concat(F.lit(START), F.col("word"), F.lit(END))
    each = words.select(marked.alias("m")).select(F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.lit(longest - 1)), lambda size: F.when(F.length("m") >= size, F.transform(
            F.sequence(F.lit(1), F.length("m") - size + 1), lambda i: F.substring("m", i, size))).otherwise(
                F.array().cast("array<string>"))))).alias("gram"))
    counts = materialize(each.groupBy("gram").agg(F.count("*").alias("n")), "grams")
    sizes = counts.groupBy(F.length("gram").alias("size")).agg(F.sum("n").alias("total"))
    often = counts.join(F.broadcast(sizes), F.length("gram") == F.col("size")).where(F.col("n") * share > F.col("total"))
    return {r["gram"] for r in often.select("gram").collect()}


def grams_of(word: str, frequent: set[str], longest: int) -> list[str]:
    """The word's gram at each place of its framed form (but the last)."""
    m = START + word + END
    out = []
    for p in range(len(m) - 1):
        end = p + 2
        while end - p < longest and end < len(m) and m[p:end] in frequent:
            end += 1
        out.append(m[p:end])
    return out


def affected_bound(grams: list[str]) -> int:
    """The most grams that one edit can change: those that cover one character."""
    change = np.zeros(max(p + len(g) for p, g in enumerate(grams)) + 1, np.int64)
    for p, g in enumerate(grams):
        change[p] += 1
        change[p + len(g)] -= 1
    return int(np.cumsum(change).max())


def gram_table(words: DataFrame, frequent: set[str], longest: int) -> DataFrame:
    """(word, key, place, lists): every gram of every word with its place; the key tells equal grams of a
    word apart (which have the place -1, as an edit may change their numbers), ``lists`` is how many
    of the word's lists must be merged."""
    def work(batches):
        schema = pa.schema([("word", pa.string()), ("key", pa.string()), ("place", pa.int32()), ("lists", pa.int32())])
        for batch in slices(batches, 1 << 18):
            word, key, place, lists = [], [], [], []
            for w in batch.column(0).to_pylist():
                grams = grams_of(w, frequent, longest)
                often, seen = Counter(grams), Counter()
                for p, g in enumerate(grams):
                    seen[g] += 1
                    key.append(g if seen[g] == 1 else f"{g} {seen[g]}")
                    place.append(p if often[g] == 1 else -1)
                word += [w] * len(grams)
                lists += [affected_bound(grams) + 1] * len(grams)
            yield rows(schema, word, key, place, lists)

    return words.select("word").mapInArrow(work, "word string, key string, place int, lists int")


def _one_edit(left: np.ndarray, right: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs (i, j) of different words, lengths at most one apart, are one edit apart: the common
    beginning and the common end leave one character of the longer one. ``left`` and ``right``
    hold the words aligned at either side, filled up differently from any letter."""
    width = left.shape[1]
    same = left[i] == left[j]
    ahead = np.where(same.all(1), width, np.argmin(same, 1))
    same = right[i] == right[j]
    behind = np.where(same.all(1), width, np.argmin(same[:, ::-1], 1))
    return np.minimum(ahead, size[i]) + np.minimum(behind, size[i]) >= np.maximum(size[i], size[j]) - 1


def _letters(text: list[bytes]) -> np.ndarray:
    """The set of letters of each word as 64 bits; one edit takes one letter and brings one at most."""
    size = np.array([len(w) for w in text], np.int64)
    bits = np.uint64(1) << (np.frombuffer(b"".join(text), np.uint8) & 63).astype(np.uint64)
    return np.bitwise_or.reduceat(bits, np.r_[0, np.cumsum(size)[:-1]])


def _met(group: np.ndarray, size: np.ndarray, side: np.ndarray):
    """Pairs of rows (i < j) of one group whose words' lengths differ by one at most, about MET at a
    time; sorted by (group, size). Sides 0 and 1 meet each other only, rows of side 2 meet all."""
    n = len(group)
    place = group * (int(size.max()) + 2) + size
    until = np.searchsorted(place, place + 1, "right")
    after = until - np.arange(n) - 1
    total = np.cumsum(after)
    begin = 0
    while begin < n:
        stop = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + MET, "right")))
        count = after[begin:stop]
        i = np.repeat(np.arange(begin, stop), count)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
        keep = (side[i] == 2) | (side[i] != side[j])
        yield i[keep], j[keep]
        begin = stop


def near_words(words: DataFrame, least_length: int = 5, longest: int = 5, share: int = 2000,
               block: int = 1024) -> DataFrame:
    """(a, b), both ways round, of all pairs of distinct ``words`` exactly one edit apart.

    ``words`` has ``word`` of letters below U+0100, no repeats, ``least_length`` or more each. A list of
    more than ``block`` words is split into blocks that meet two by two, so no task holds more than
    two blocks of it; no pair leaves a task before it is verified."""
    if not 2 < longest <= least_length:
        raise ValueError("longest is from 3 to least_length: else one edit may change all grams of a word")
    frequent = frequent_grams(words, longest, share)
    each = materialize(gram_table(words, frequent, longest), "gram-places")
    common = each.groupBy("key").agg(F.count("*").alias("n"))
    ranked = each.join(common, "key").groupBy("word", "lists").agg(
        F.array_sort(F.collect_list(F.struct("n", "key", "place"))).alias("g"))
    lists = materialize(ranked.select("word", F.explode(F.slice("g", F.lit(1), F.col("lists"))).alias("g"))
                        .select("word", F.col("g.key").alias("key"), F.col("g.place").alias("place")), "lists")

    sizes = lists.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    met = (lists.join(sizes, "key").withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).withColumn("own", own)
           .select("key", "word", "place", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
           .select(F.concat_ws(" ", F.least("own", "other"), F.greatest("own", "other"), "key").alias("meeting"),
                   F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
                   .alias("side"), "place", "word"))

    def verify(batches):
        schema = pa.schema([("a", pa.string()), ("b", pa.string())])
        for t in whole_groups(batches, "meeting", 1 << 14):
            text = [w.encode("latin-1") for w in t.column("word").to_pylist()]
            size = np.array([len(w) for w in text], np.int64)
            place, side = t.column("place").to_numpy(), t.column("side").to_numpy()
            group = t.column("meeting").dictionary_encode().combine_chunks().indices.to_numpy()
            # (group, length) in order, so that rows of like width are laid out together
            order = np.lexsort((size, group))
            group = np.cumsum(np.r_[0, group[order][1:] != group[order][:-1]])
            size, place, side = size[order], place[order], side[order]
            text = [text[k] for k in order]
            found_a, found_b, letters = [], [], _letters(text)
            for i, j in _met(group, size, side):
                good = np.bitwise_count(letters[i] ^ letters[j]) <= 2
                i, j = i[good], j[good]
                # an unchanged gram moves by one place at most
                good = (np.abs(place[i] - place[j]) <= 1) | (place[i] < 0) | (place[j] < 0)
                i, j = i[good], j[good]
                by_width = np.argsort(size[j], kind="stable")
                i, j = i[by_width], j[by_width]
                cuts = np.searchsorted(np.cumsum(size[j] + 1), np.arange(0, int((size[j] + 1).sum()) + 1, 1 << 24))
                for a, b in zip(cuts, np.r_[cuts[1:], len(i)]):
                    if a == b:
                        continue
                    used, at = np.unique(np.r_[i[a:b], j[a:b]], return_inverse=True)
                    width = int(size[used].max())
                    left = np.frombuffer(b"".join(text[k].ljust(width, b"\0") for k in used), np.uint8).reshape(-1, width)
                    right = np.frombuffer(b"".join(text[k].rjust(width, b"\0") for k in used), np.uint8).reshape(-1, width)
                    ok = _one_edit(left, right, size[used], at[:b - a], at[b - a:])
                    found_a += [text[k].decode("latin-1") for k in i[a:b][ok]]
                    found_b += [text[k].decode("latin-1") for k in j[a:b][ok]]
            if found_a:
                yield rows(schema, found_a + found_b, found_b + found_a)

    return (met.repartition("meeting").sortWithinPartitions("meeting").mapInArrow(verify, "a string, b string")
            .distinct())


def whole_groups(batches, key: str, least: int):
    """Tables of whole groups of the sorted column ``key``, about ``least`` rows or one group each."""
    held, count = [], 0
    for batch in batches:
        keys = batch.column(key)
        n = batch.num_rows
        if not n:
            continue
        changes = np.flatnonzero(np.asarray(keys.slice(1).to_numpy(zero_copy_only=False)
                                            != keys.slice(0, n - 1).to_numpy(zero_copy_only=False))) + 1
        edges = [0, *changes.tolist(), n]
        if held and held[-1].column(key)[-1] != keys[0] and count >= least:
            yield pa.Table.from_batches(held)
            held, count = [], 0
        begin = 0
        for edge in edges[1:-1]:
            if count + edge - begin >= least:
                yield pa.Table.from_batches([*held, batch.slice(begin, edge - begin)])
                held, count, begin = [], 0, edge
        held.append(batch.slice(begin))
        count += n - begin
    if held:
        yield pa.Table.from_batches(held)


def spelling_forms(words: DataFrame, times: int = 2, **index) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (word, n).

    A word's form is its near word of largest n (ties: the smallest word), if it has at least ``times``
    the word's n; the root is where forms lead to. Counts grow along forms, so the way is at most
    log(n) long; it is followed by doubling."""
    if times < 2:
        raise ValueError("times is at least 2: else forms may lead in a circle")
    words = materialize(words, "words")
    pairs = materialize(near_words(words, **index), "near-words")
    of_near = pairs.join(words.select(F.col("word").alias("b"), F.col("n").alias("near_n")), "b")
    best = of_near.groupBy("a").agg(F.count("*").alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("m"), F.col("b").alias("form"))).alias("best"))
    enough = -F.col("best.m") >= times * F.col("n")
    out = materialize(words.join(best, F.col("word") == F.col("a"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.m")).alias("form_n")), "forms")

    way = out.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        ahead = way.select(F.col("word").alias("w"), F.col("root").alias("further"))
        way = materialize(way.join(ahead, F.col("root") == F.col("w"), "left")
                          .select("word", F.coalesce("further", "root").alias("root"),
                                  F.col("further").isNotNull().alias("moved")), "roots")
        if way.where("moved").isEmpty():
            break
        way = way.drop("moved")
    way = way.select(F.col("word").alias("w"), "root")
    return (out.join(way, F.col("word") == F.col("w"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op12_gram_spelling(spark, sf_dir: str) -> DataFrame:
    """Words of all ``documents`` with 3 or more occurrences, a letter missing in some by rule, and
    their forms."""
    counts = word_counts(table(spark, sf_dir, "documents"), least_length=5, damage=True)
    return spelling_forms(counts.where("n >= 3"))
