"""Benchmark decontamination by winnowing, with DataFrame functions only.

A text is the sequence of its words. A window is ``window`` consecutive words of an
item. Of every ``window - k + 1`` consecutive k-grams the least hash is a fingerprint, on both
sides, so a window that a document shares has a fingerprint in common with it: equal
windows hold equal k-grams and so an equal least hash. Fingerprints are joined, every hit is
extended to the windows around it, and these are compared word by word.

An item of fewer words than a window is one window of its own. It has no fingerprint that a
document must share; its longest word is its key instead, looked up among all words.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickrisk.llm.common import table
from tickrisk.plans.materialize import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"              # what separates words


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z) words of a text; none for null."""
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lower, BETWEEN, -1), lambda w: w != "")


def hashes_of(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _upto(n: Column) -> Column:
    """0 .. n - 1; empty for n <= 0."""
    return F.when(n > 0, F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)).otherwise(F.array().cast("array<int>"))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once a row (the optimiser would move a plain
    expression into the lambda or above the explode that uses it)."""
    return F.transform(F.array(value), body)[0]


def fingerprints(hashes: Column, k: int, window: int) -> Column:
    """Array of (p, h): the winnowed k-grams of the word hashes with their places.

    A k-gram's hash gives up its lowest bits for its place modulo a power of two above the span
    of a window, so the least value of a window also tells where it is."""
    span = window - k + 1
    bits = max(1, (span - 1).bit_length())
    low = (1 << bits) - 1

    def grams(w):
        return F.transform(_upto(F.size(w) - (k - 1)), lambda i: F.xxhash64(*[F.get(w, i + d) for d in range(k)])
                           .bitwiseAND(F.lit(~low)).bitwiseOR(i.bitwiseAND(F.lit(low)).cast("long")))

    def minima(g):
        return F.transform(_upto(F.size(g) - (span - 1)), lambda j: F.least(
            *[F.get(g, j + d) for d in range(span)]) if span > 1 else F.get(g, j))

    def place(x, j):                       # the place p in j .. j + span - 1 with these lowest bits
        return j + F.pmod(x.bitwiseAND(F.lit(low)).cast("int") - j, F.lit(low + 1))

    def changes(m):
        return F.filter(F.transform(m, lambda x, j: F.when((j == 0) | (x != F.get(m, j - 1)), F.struct(
            place(x, j).alias("p"), F.shiftright(x, bits).alias("h")))), lambda s: s.isNotNull())

    return _let(hashes, lambda w: _let(grams(w), lambda g: _let(minima(g), changes)))


def item_windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """(item_id, words) of the items that have words; ids as strings."""
    return (items.select(F.col(id_col).cast("string").alias("item_id"), words_of(F.col(text_col)).alias("words"))
            .where("size(words) > 0 and item_id is not null")
            .withColumn("n", F.least(F.size("words"), F.lit(window))))


def windows_at(words: Column, places: Column) -> Column:
    """(start, n, window) of each place (start, n): its words as a text."""
    return _let(words, lambda w: F.transform(places, lambda s: F.struct(
        s["start"].alias("start"), s["n"].alias("n"),
        F.array_join(F.slice(w, s["start"] + 1, s["n"]), " ").alias("window"))))


def candidate_windows(texts: DataFrame, items: DataFrame, k: int, window: int) -> DataFrame:
    """(key, who, start, n): places of documents where a window may begin. ``texts`` has (key, who,
    n_words, prints), ``items`` comes from ``item_windows``."""
    marks = (items.where(F.size("words") >= window)
             .select(F.explode(fingerprints(hashes_of(F.col("words")), k, window)).alias("f"))
             .select(F.col("f.h").alias("h")).distinct())
    hits = (texts.select("key", "who", "n_words", F.explode("prints").alias("f"))
            .select("key", "who", "n_words", F.col("f.p").alias("p"), F.col("f.h").alias("h"))
            .join(marks, "h", "left_semi"))
    # the windows that hold the k-gram at p
    around = F.sequence(F.greatest(F.col("p") - (window - k), F.lit(0)),
                        F.greatest(F.least(F.col("p"), F.col("n_words") - window), F.lit(0)))
    return hits.select("key", "who", F.explode(around).alias("start"), F.lit(window).alias("n"))


def candidate_short_windows(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """(key, who, start, n) for items of fewer words than a window: places of their longest word."""
    key_word = F.array_max(F.transform("words", lambda w, i: F.struct(
        F.length(w).alias("length"), (-i).alias("at"), F.xxhash64(w).alias("h"))))
    short = (items.where(F.size("words") < window).select("n", key_word.alias("w"))
             .select("n", (-F.col("w.at")).alias("before"), F.col("w.h").alias("h")).distinct())
    each = docs.select("key", "who", "n_words", F.posexplode(hashes_of(words_of(F.col("text")))).alias("p", "h"))
    return (each.join(short, "h").withColumn("start", F.col("p") - F.col("before"))
            .where("start >= 0 and start + n <= n_words").select("key", "who", "start", "n"))


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, k: int = 5, id_col: str = "doc_id",
                  text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, contaminated, item_ids (sorted strings) and hits (word
    places (start, n) of the windows found, in order) of every row.

    A document word inside any occurrence of a window is hit. A null text has no words, an item
    without words or without id no window; repeated rows get equal rows each; items of one
    id are one item. Other columns are ignored.

    Equal texts are looked at once (by MD5). Joins are equi-joins on hashes or window texts: Spark
    broadcasts the benchmark's side where it is measured to be small, and splits skewed keys otherwise.
    """
    if not 1 <= k <= window:
        raise ValueError("k is from 1 to window")
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    keyed = base.withColumn("key", F.unhex(F.md5("text"))).withColumn("who", F.xxhash64("doc_id"))
    items = materialize(item_windows(items, window, item_id_col, item_text_col), "items")
    counted = _let(words_of(F.col("text")), lambda w: F.struct(
        F.size(w).alias("n_words"), fingerprints(hashes_of(w), k, window).alias("prints")))
    prints = materialize(keyed.select("doc_id", "key", "who", counted.alias("c")).select("doc_id", "key", "who", "c.*"),
                         "prints")

    maybe = [candidate_windows(prints, items, k, window)]
    if not items.where(F.size("words") < window).isEmpty():
        numbered = keyed.withColumn("n_words", F.size(words_of(F.col("text"))))
        maybe.append(candidate_short_windows(numbered, items, window))
    starts = (reduce(DataFrame.unionByName, maybe).groupBy("key")
              .agg(F.collect_set(F.struct("start", "n")).alias("starts"), F.min("who").alias("who")))
    starts = materialize(starts, "candidates")

    # One document of each text with candidates tells the text. Documents meet the candidates by text
    # and id, so copies are dealt evenly; the candidates grow with the corpus and are never broadcast.
    texts = (keyed.select("key", "who", "text").join(starts.hint("shuffle_hash"), ["key", "who"])
             .groupBy("key", "starts").agg(F.min("text").alias("text")))
    placed = texts.select("key", F.explode(windows_at(words_of(F.col("text")), F.col("starts"))).alias("s")).select("key", "s.*")
    whole = F.transform(F.sequence(F.lit(0), F.size("words") - F.col("n")), lambda i: F.struct(
        i.alias("start"), F.col("n").alias("n")))
    known = materialize(items.select("item_id", F.explode(windows_at(F.col("words"), whole)).alias("s"))
                        .select("item_id", F.col("s.window").alias("window")).distinct(), "windows")
    hits = materialize(placed.join(known.select("window").distinct(), "window", "left_semi"), "hits")

    spans = hits.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", "n"))).alias("hits"))
    whose = (hits.select("key", "window").distinct().join(known, "window").groupBy("key")
             .agg(F.array_sort(F.collect_set("item_id")).alias("item_ids")))
    result = spans.join(whose, "key")
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate("hits", zero, lambda a, s: F.struct(
        (a["n"] + F.greatest(F.lit(0), s["start"] + s["n"] - F.greatest(a["end"], s["start"]))).alias("n"),
        F.greatest(a["end"], s["start"] + s["n"]).alias("end")), lambda a: a["n"])
    return (prints.select("doc_id", "key", "n_words").join(result, "key", "left")
            .select("doc_id", F.col("n_words").cast("long").alias("n_words"),
                    F.coalesce(covered, F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
                    F.col("hits").isNotNull().alias("contaminated"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
                    F.coalesce("hits", F.array().cast("array<struct<start:int,n:int>>")).alias("hits")))


def op11_winnowing_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` against all of ``benchmark``, windows of 10 words."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
i AS (
  SELECT item_id::VARCHAR AS item_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark WHERE item_id IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[a:a + n - 1], ' ') AS t
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS a
        FROM (SELECT item_id, w, least(len(w), 10) AS n FROM i WHERE len(w) > 0))),
dw AS (
  SELECT r, a, n, array_to_string(w[a:a + n - 1], ' ') AS t
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS a
        FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hit AS (SELECT DISTINCT r, a, n, item_id FROM dw JOIN iw USING (n, t)),
word AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(a, a + n)) AS p FROM hit) GROUP BY r),
item AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
         FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (r) LEFT JOIN item USING (r)
"""
