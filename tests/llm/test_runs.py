"""op13 against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from edge import empty, frame, rows
from tickrisk.llm import runs


def brute(w, least=12):
    """All lags, all stretches of matches on each."""
    number = {}
    w = np.array([number.setdefault(x, len(number)) for x in w], np.int64)
    out = []
    for q in range(1, len(w) // 2 + 1):
        edges = np.flatnonzero(np.diff(np.r_[0, (w[q:] == w[:-q]).astype(np.int8), 0]))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = end + q - start
            if length >= max(least, 2 * q) and not any(
                    (w[start:end + q - d] == w[start + d:end + q]).all() for d in range(1, q)):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(rnd):
    """Few distinct words, and stretches repeated whole or in part, one inside another."""
    w = [rnd.randrange(rnd.choice([1, 2, 3, 5])) for _ in range(rnd.choice([0, 3, 11, 12, 30, 60, 120]))]
    for _ in range(rnd.randrange(3)):
        unit = [rnd.randrange(rnd.choice([2, 3, 50])) for _ in range(rnd.randint(1, 40))]
        if rnd.random() < .3:
            unit += unit[:rnd.randint(1, 5)] * 3
        at = rnd.randrange(len(w) + 1)
        w[at:at] = unit * rnd.randint(2, 6) + unit[:rnd.randrange(len(unit))]
    return w


@pytest.mark.parametrize("least", [12, 4, 5, 7, 8, 20])
def test_runs_equal_brute_force(least):
    for seed in range(60):
        rnd = random.Random(1000 * least + seed)
        docs = [some_words(rnd) for _ in range(rnd.randint(1, 5))]
        flat = np.array([x for d in docs for x in d], np.int64)
        assert runs.runs_of(flat, np.cumsum([len(d) for d in docs]), least) == [brute(d, least) for d in docs]


@pytest.mark.parametrize("w, exp", [([1] * 20000, [(0, 20000, 1)]), ([1, 2] * 9000 + [1], [(0, 18001, 2)]),
                                    (list(range(7000)) * 3, [(0, 21000, 7000)]),
                                    ([1] * 5000 + [2] + [1] * 5000, [(0, 5000, 1), (5001, 5000, 1)])])
def test_long_texts(w, exp):
    assert runs.runs_of(np.array(w), np.array([len(w)])) == [exp]


def repeated(doc, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc).encode())
    if doc is not None and h % 10 == 0 and w:
        a = h // 10 % len(w)
        p = 1 + (len(w) - a) // (3 + h // 10 % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    return w


def test_query(spark, tmp_path):
    data = [(i, t) for i, t in enumerate([r[1] for r in rows()] * 3)] + [(None, "a b c " * 9), (None, None), (7, "x y " * 20)]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    exp, changed = [], 0
    for doc, text in data:
        w = repeated(doc, text)
        changed += doc is not None and zlib.crc32(str(doc).encode()) % 10 == 0 and len(w) > 20
        found = brute(w)
        gone = {i for s, length, q in found for i in range(s + q, s + length)}
        s, length, q = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
        exp.append((doc, len(found), s, length, q, 1000 * length // q if found else None,
                    hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(),
                    hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    out = runs.op13_periodic_runs(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(exp, key=str)
    assert changed > 3 and sum(r[1] for r in exp) > 10


def test_operator_rows(spark):
    found = runs.periodic_runs(frame(spark), least=8).collect()
    exp = []
    for doc, text in (r[:2] for r in rows()):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        found_here = brute(w, 8)
        gone = {i for s, length, q in found_here for i in range(s + q, s + length)}
        exp.append((doc, len(w), found_here, " ".join(x for i, x in enumerate(w) if i not in gone)))
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found]
    assert sorted(got, key=str) == sorted(exp, key=str)
    assert runs.periodic_runs(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(frame(spark), least=3)
