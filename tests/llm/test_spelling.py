"""op12 against plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from edge import empty, frame, rows
from tickrisk.llm import decontaminate, spelling

LOWER = str.maketrans(decontaminate.UPPER, decontaminate.LOWER)


def plain_counts(docs, damage):
    total = Counter()
    for doc, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOWER)
            if damage and doc is not None:
                h = zlib.crc32(f"{doc}:{w}".encode())
                if h % 97 == 0:
                    w = w[:h % len(w)] + w[h % len(w) + 1:]
            total[w] += 1
    return {w: n for w, n in total.items() if len(w) >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_forms(counts, times=2):
    by_size = defaultdict(list)
    for w in counts:
        by_size[len(w)].append(w)
    near = {w: [x for d in (-1, 0, 1) for x in by_size[len(w) + d] if one_edit(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-counts[x], x))
            if counts[best] >= times * counts[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items())


def vocabulary(seed, size=500):
    """Words of two alphabets with repeated letters and grams, chains of edits, ties of n."""
    rnd = random.Random(seed)
    letters, words = rnd.choice(["ab", "abc", "abcdefé", "abcdefghijklmnopqrstuvwxyzàÿ÷"]), {}
    while len(words) < size:
        w = "".join(rnd.choice(letters) for _ in range(rnd.choice([5, 5, 6, 7, 8, 12, 30])))
        for _ in range(rnd.randrange(1, 6)):
            words[w] = rnd.choice([3, 3, 4, 7, 8, 20, 50, 1000])
            at = rnd.randrange(len(w))
            w = rnd.choice([w[:at] + w[at + 1:], w[:at] + rnd.choice(letters) + w[at:],
                            w[:at] + rnd.choice(letters) + w[at + 1:]])
            if len(w) < 5:
                break
    return words


@pytest.mark.parametrize("seed, longest, share, block", [(0, 5, 2000, 1024), (1, 5, 20, 1024), (2, 4, 20, 16), (3, 3, 50, 7),
                                                         (4, 5, 3, 16), (5, 5, 200, 5)])
def test_equals_brute_force(spark, seed, longest, share, block):
    counts = vocabulary(seed)
    table = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    out = spelling.spelling_forms(table, longest=longest, share=share, block=block)
    assert sorted(map(tuple, out.collect())) == plain_forms(counts)


def test_lists_of_the_bound_meet():
    """Two words one edit apart share one of the bound + 1 first grams, in any common order."""
    rnd = random.Random(3)
    for _ in range(3000):
        letters = rnd.choice(["ab", "abcd"])
        w = "".join(rnd.choice(letters) for _ in range(rnd.randint(5, 9)))
        at = rnd.randrange(len(w))
        x = rnd.choice([w[:at] + rnd.choice(letters) + w[at:], w[:at] + rnd.choice(letters) + w[at + 1:]])
        frequent = {a + b for a in letters for b in letters} | {"aba", "bab", "aa" + letters[-1]}
        lists = []
        for v in (w, x):
            grams = spelling.grams_of(v, frequent, 5)
            seen, keys = Counter(), []
            for g in grams:
                seen[g] += 1
                keys.append((zlib.crc32(g.encode()) % 7, g, seen[g]))
            lists.append(set(sorted(keys)[:spelling.affected_bound(grams) + 1]))
        assert lists[0] & lists[1], (w, x)


@pytest.mark.parametrize("damage", [False, True])
def test_word_counts(spark, damage):
    found = spelling.word_counts(frame(spark), 5, damage)
    assert {r["word"]: r["n"] for r in found.collect()} == plain_counts([r[:2] for r in rows()], damage)


def test_query(spark, tmp_path):
    data = [(i, t) for i, t in enumerate([r[1] for r in rows()] * 3)] + [(None, "Größe größe größte Größte" * 3)]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = spelling.op12_gram_spelling(spark, str(tmp_path))
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    counts = {w: n for w, n in plain_counts(data, True).items() if n >= 3}
    assert sorted(map(tuple, out.collect())) == plain_forms(counts)


def test_empty_table_and_bounds(spark):
    assert spelling.spelling_forms(spelling.word_counts(empty(spark))).count() == 0
    with pytest.raises(ValueError):
        spelling.near_words(spelling.word_counts(empty(spark)), least_length=4, longest=5)
