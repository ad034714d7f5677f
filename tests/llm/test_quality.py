"""op1: statistics against plain Python, constraints and held-out accuracy of the trees."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from edge import empty, frame, rows, texts, words
from tickrisk.llm import boosting, quality

WORD = re.compile("[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for k in range(i, i + 5)}
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_counts_equal_plain_python():
    extra = ["a a a a a a a", "a b c d e a b c d e f", "# * $x%", "l1\nl1\n\nl1 \n \n", "\x1c\x85 x　y"]
    cases = texts() + extra
    counts, features = quality.statistics([(t or "").encode() for t in cases])
    got = list(zip(*(counts[c].tolist() for c in quality.COUNTS)))
    assert got == [plain(t) for t in cases]
    assert features.shape == (len(cases), len(quality.FEATURES)) and np.isfinite(features).all()


def test_no_texts():
    counts, features = quality.statistics([])
    assert features.shape[0] == 0 and len(counts["n_words"]) == 0


def test_monotone_constraints_hold():
    rng = np.random.default_rng(1)
    x = rng.uniform(size=(3000, 4))
    y = ((x[:, 0] + 0.4 * np.sin(9 * x[:, 1]) - x[:, 2] + 0.6 * rng.normal(size=3000)) > 0).astype(float)
    forest = boosting.fit(x, y, [1, 0, -1, -1])
    grid = np.linspace(0, 1, 200)
    for _ in range(30):
        row = rng.uniform(size=4)
        for f, direction in ((0, 1), (2, -1), (3, -1)):
            line = np.repeat(row[None, :], 200, 0)
            line[:, f] = grid
            assert (direction * np.diff(forest.margin(line)) >= -1e-12).all()
    assert ((forest.probability(x) > 0.5) == y).mean() > 0.75


def test_flat_arrays_score_like_a_walk():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 3))
    forest = boosting.fit(x, (x[:, 0] * x[:, 1] > 0).astype(float), [0, 0, 0], trees=5)
    for row, margin in zip(x[:50], forest.margin(x[:50])):
        total = forest.base
        for node in forest.roots.tolist():
            while forest.feature[node] >= 0:
                node = int(forest.left[node] if row[forest.feature[node]] <= forest.threshold[node] else forest.right[node])
            total += forest.value[node]
        assert total == pytest.approx(margin)


def test_rows_and_edge_cases(spark):
    got = quality.judge(frame(spark), None).collect()
    exp = sorted(((r[0],) + plain(r[1]) for r in rows()), key=str)
    assert sorted(((r["doc_id"], *(r[c] for c in quality.COUNTS)) for r in got), key=str) == exp
    for r in got:
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed)
    assert quality.judge(empty(spark), None).count() == 0


def test_training_needs_two_classes(spark):
    docs = frame(spark)
    labels = "doc_id long, quality int, toxic int"
    assert quality.train(docs, spark.createDataFrame([], labels)) is None
    assert quality.train(docs, spark.createDataFrame([(6, 1, 0), (7, None, 0), (None, 0, 0)], labels)) is None
    assert quality.train(empty(spark), spark.createDataFrame([(6, 1, 0), (7, 0, 0)], labels)) is None


def test_kept_rows_keep_all_columns(spark):
    docs = frame(spark)
    kept = quality.keep_good(docs, None)
    assert kept.columns == docs.columns
    exp = sorted((r for r in rows() if not (plain(r[1])[0] < 10 or 100 * plain(r[1])[4] > 20 * plain(r[1])[0])), key=str)
    assert sorted(map(tuple, kept.collect()), key=str) == exp
    assert quality.keep_good(empty(spark), None).count() == 0


def test_held_out_accuracy(spark):
    """Trained on every other labelled document of a test table, judged on the rest."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.train(docs, labels.where("doc_id % 2 = 0"))
    got = quality.judge(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    good = [r["kept"] for r in got if r["quality"] == 1]
    bad = [r["kept"] for r in got if r["quality"] == 0]
    assert len(good) > 50 and len(bad) > 5
    assert sum(good) / len(good) >= 0.99 and sum(bad) / len(bad) <= 0.15


def test_a_hot_labelled_id_counts_once(spark):
    """Copies of one bad row do not push the other class out of the sample."""
    rnd = random.Random(5)
    good = [(k, words(rnd, 60)) for k in range(20)]
    bad = [(100 + k, words(rnd, 5) + " # $ % |" * 30) for k in range(20)]
    docs = spark.createDataFrame(good + bad + [bad[0]] * 100, "doc_id long, text string").repartition(3)
    once = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad], "doc_id long, quality int")
    model, plain_model = (quality.train(d, labels, sample=50) for d in (docs, once))
    assert model is not None
    _, x = quality.statistics([t.encode() for _, t in good + bad])
    assert (model.probability(x) == plain_model.probability(x)).all()
    assert quality.train(docs, labels, sample=40) is not None
