"""op11 against plain Python."""

import hashlib
import random
import re

import pytest

from edge import empty, frame, rows, words
from tickrisk.llm import decontaminate

LOWER = str.maketrans(decontaminate.UPPER, decontaminate.LOWER)
ITEMS = "item_id long, text string, key string, words string, start int"


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, window):
    out = []
    for doc, text in docs:
        w, hit, ids = split(text), set(), set()
        for item, body in items:
            x = split(body)
            n = min(len(x), window)
            known = {tuple(x[a:a + n]) for a in range(len(x) - n + 1)} if n and item is not None else ()
            for a in range(len(w) - n + 1):
                if tuple(w[a:a + n]) in known:
                    hit |= set(range(a, a + n))
                    ids.add(str(item))
        out.append((doc, len(w), len(hit), len(ids), sorted(ids), bool(hit)))
    return sorted(out, key=str)


def got(spark, docs, items, window, k):
    found = decontaminate.contamination(docs, items, window, k).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["item_ids"], r["contaminated"])
                   for r in found), key=str)


def items_from(texts, rnd):
    """Pieces of the documents, in other case and with other separators, short ones among them."""
    out = [(1, None), (2, ""), (3, " .,; "), (None, "an item without id of more than ten words in all, surely so")]
    for number, size in enumerate([1, 2, 4, 7, 9, 10, 11, 12, 15, 20, 30, 60, 5, 10, 3], 10):
        w = split(rnd.choice([t for t in texts if t and len(split(t)) >= size]))
        at = rnd.randrange(len(w) - size + 1)
        out.append((number, ", ".join(x.upper() if rnd.random() < .3 else x for x in w[at:at + size])))
    out += [out[-1], (11, "Wholly other words 123")]               # a repeated item, two texts of one id
    out += [(40, "line of text here " * 5), (41, "x" * 400), (42, "日本語 " * 12)]
    return out


@pytest.mark.parametrize("seed, window, k", [(1, 10, 5), (2, 10, 5), (3, 10, 1), (4, 10, 10), (5, 4, 2)])
def test_equals_brute_force(spark, seed, window, k):
    data, rnd = rows(seed), random.Random(seed)
    items = items_from([r[1] for r in data], rnd)
    table = spark.createDataFrame([(i, t, "k", "w", 1) for i, t in items], ITEMS)
    assert got(spark, frame(spark, seed), table, window, k) == brute([r[:2] for r in data], items, window)


def test_spans_of_the_guaranteed_length(spark):
    """Every shared span of ten words is found, wherever it lies; none of nine is."""
    rnd = random.Random(7)
    docs, items, expected = [], [], {}
    for i in range(150):
        size = rnd.choice([9, 10, 11, 25])
        span = words(rnd, size)
        before, after = rnd.randrange(4), rnd.randrange(4)
        docs.append((i, " ".join(filter(None, [words(rnd, before), span, words(rnd, after)]))))
        items.append((i, " ".join([words(rnd, rnd.randrange(10, 14)) + " Item", span, "Item " + words(rnd, 12)])))
        expected[i] = size >= 10
    found = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                                        spark.createDataFrame(items, "item_id long, text string"))
    rows_ = found.collect()
    assert {r["doc_id"]: r["contaminated"] for r in rows_} == expected
    for r in rows_:
        assert sum(min(s["n"], t["start"] - s["start"]) for s, t in zip(r["hits"], r["hits"][1:])) + (
            r["hits"][-1]["n"] if r["hits"] else 0) == r["n_hit"]


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "one two three", "", "", 0)], ITEMS)
    assert decontaminate.contamination(empty(spark), items).count() == 0
    none = decontaminate.contamination(frame(spark), items.limit(0)).collect()
    assert len(none) == len(rows()) and not any(r["contaminated"] for r in none)


def test_query_and_no_python_in_the_plan(spark, tmp_path):
    data = rows()
    frame(spark).write.parquet(str(tmp_path / "documents.parquet"))
    items = items_from([r[1] for r in data], random.Random(1))
    spark.createDataFrame([(i, t, "k", "w", 1) for i, t in items], ITEMS).write.parquet(str(tmp_path / "benchmark.parquet"))
    out = decontaminate.op11_winnowing_decontamination(spark, str(tmp_path))
    exp = [(r[0], r[1], r[2], r[3], hashlib.sha256(",".join(r[4]).encode()).hexdigest(), r[5])
           for r in brute([r[:2] for r in data], items, 10)]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(exp, key=str)
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan and "CartesianProduct" not in plan
