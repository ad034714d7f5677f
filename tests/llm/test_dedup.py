"""op2, op3, op5, op6: near and exact duplicates against brute force."""

import hashlib
import math
import random
import re
import tempfile

import numpy as np
import pytest

from edge import empty, frame, rows, words
from tickrisk.llm import chunks, collisions, components, setsketch, suffixes


class Union:
    def __init__(self):
        self.up = {}

    def root(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def test_components(spark):
    rnd = random.Random(4)
    for n, m in ((30, 20), (60, 80), (5, 0)):
        edges = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)] + [(100 + k, 101 + k) for k in range(12)]
        u = Union()
        for a, b in edges:
            u.join(a, b)
        got = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
        assert {r["node"]: r["root"] for r in got} == {x: u.root(x) for a, b in edges if a != b for x in (a, b)}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- op5


def shingles(text, size):
    w = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def brute_near(items, size, percent):
    sets, u = [shingles(t, size) for _, t in items], Union()
    for k, (i, _) in enumerate(items):
        if i is not None:
            u.root(i)
        for j in range(k):
            both = len(sets[k] & sets[j])
            if both and None not in (i, items[j][0]) and 100 * both >= percent * len(sets[k] | sets[j]):
                u.join(i, items[j][0])
    return sorted(((i, len(s), None if i is None else u.root(i), i is None or u.root(i) == i)
                   for (i, _), s in zip(items, sets)), key=str)


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates_equal_brute_force(spark, size):
    docs = frame(spark)
    got = setsketch.near_duplicates(docs, size, 80)
    exp = brute_near([r[:2] for r in rows()], size, 80)
    assert sorted(map(tuple, got.collect()), key=str) == exp
    kept = setsketch.drop_near_duplicates(docs, size, 80)
    assert kept.columns == docs.columns
    gone = {r[0] for r in exp if not r[3]}
    assert sorted((r[:2] for r in map(tuple, kept.collect())), key=str) == \
        sorted((r[:2] for r in rows() if r[0] not in gone), key=str)
    assert setsketch.near_duplicates(empty(spark), size, 80).count() == 0
    assert setsketch.drop_near_duplicates(empty(spark), size, 80).count() == 0


def test_chains_around_the_threshold(spark):
    """A large group of drifting copies: links exist between members that do not link to
    the group's first document, in one bucket and across components."""
    rnd = random.Random(8)
    base = words(rnd, 80).split(" ")
    items = []
    for k in range(120):
        t = list(base)
        for _ in range(rnd.choice([0, 1, 1, 2, 2, 3])):
            t[rnd.randrange(len(t))] = f"w{rnd.randrange(40)}"
        items.append((1000 - k, " ".join(t)))
    docs = spark.createDataFrame(items, "doc_id long, text string")
    got = sorted(map(tuple, setsketch.near_duplicates(docs, 4, 80).collect()), key=str)
    assert got == brute_near(items, 4, 80)
    assert len({r[2] for r in got}) > 1


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    for share in (0.2, 0.5, 0.8, 0.95):
        n = 1000
        common = int(2 * n * share / (1 + share))
        a, b = np.sort(pool[:n]), np.sort(pool[n - common:2 * n - common])
        ra, rb, rab = setsketch.sketch([a, b, np.union1d(a, b)], 512)
        assert (setsketch.merge(ra, rb) == rab).all()
        est = setsketch.joint_estimate(ra[None], rb[None], np.array([n]), np.array([n]))[0]
        assert abs(est - share) < 0.09
    assert (setsketch.sketch([np.empty(0, np.uint64)]) == 0).all()


# --- op3


def test_cuts_follow_the_content():
    rnd, gear = random.Random(3), chunks.gear_table()
    text = words(rnd, 800).encode()
    whole = chunks.chunk_ends([text], gear)[0]
    alone = chunks.chunk_ends([b"other", text, b""], gear)
    assert (alone[1] == whole).all() and len(alone[2]) == 0 and alone[0].tolist() == [5]
    shifted = chunks.chunk_ends([b"inserted " + text], gear)[0] - 9
    later = whole[whole > 200]
    assert set(later.tolist()) <= set(shifted.tolist())                # boundaries resist the shift
    assert 20 < len(text) / len(whole) < 60
    same = "é" * 400
    assert all(e == 0 or (same.encode()[e:e + 1] or b"\xc3")[0] & 0xC0 != 0x80
               for e in chunks.chunk_ends([same.encode()], gear)[0].tolist())


def brute_chunks(items, least_run):
    """Chunk by chunk in (id, position) order; rows of one id are one document."""
    gear, first, out = chunks.gear_table(), {}, {}
    order = sorted(items, key=lambda r: (r[0] is None, r[0] or 0))
    parts = {}
    for i, t in order:
        data = (t or "").encode()
        ends = chunks.chunk_ends([data], gear)[0].tolist()
        parts[i, t] = [(a, b, data[a:b]) for a, b in zip([0, *ends], ends)]
        for _, _, c in parts[i, t]:
            first.setdefault(c, (i is None, i or 0))
    for i, t in order:
        spans, seen = [], set()
        for a, b, c in parts[i, t]:
            if c in seen or first[c] < (i is None, i or 0):
                if spans and spans[-1][1] == a:
                    spans[-1][1] = b
                else:
                    spans.append([a, b])
            seen.add(c)
        out[i, t] = [tuple(s) for s in spans if s[1] - s[0] >= least_run]
    return out


@pytest.mark.parametrize("least_run", [1, 100])
def test_substring_dedup_equals_brute_force(spark, least_run):
    docs, items = frame(spark), [r[:2] for r in rows()]
    exp = brute_chunks(items, least_run)
    got = chunks.substring_report(docs, least_run).collect()
    flat = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], tuple(map(tuple, r["spans"] or ()))) for r in got),
                  key=str)
    assert flat == sorted(((i, len((t or "").encode()), sum(b - a for a, b in exp[i, t]), len(exp[i, t]), tuple(exp[i, t]))
                           for i, t in items), key=str)
    kept = chunks.remove_repeats(docs, least_run)
    assert kept.columns == docs.columns

    def cut(i, t):
        if t is None:
            return None
        data = t.encode()
        return chunks.without_spans(data, [{"start": a, "end": b} for a, b in exp[i, t]]).decode()
    assert sorted((tuple(r)[:2] for r in kept.collect()), key=str) == sorted(((i, cut(i, t)) for i, t in items), key=str)
    assert chunks.substring_report(empty(spark)).count() == 0 == chunks.remove_repeats(empty(spark)).count()


def test_shared_passage_is_found(spark):
    rnd = random.Random(9)
    passage = words(rnd, 55)
    docs = spark.createDataFrame([(i, words(rnd, 100) + " " + passage + " " + words(rnd, 100)) for i in range(5)]
                                 + [(9, words(rnd, 200))], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in chunks.substring_report(docs).collect()}
    assert got[0] == 0 == got[9] and all(got[i] >= 0.5 * len(passage) for i in range(1, 5))


def test_no_passage_of_51_words_escapes():
    """Each shared passage keeps a run of at least 100 bytes of equal chunks, wherever it stands."""
    rnd, gear = random.Random(11), chunks.gear_table()
    kinds = (lambda n: words(rnd, n), lambda n: " ".join(rnd.choice(["été", "日本", "a", "of", "word"]) for _ in range(n)),
             lambda n: " ".join(rnd.choice(["-" * 12, "...", "==", "a", "word"]) + words(rnd, 1) for _ in range(n)))
    for k in range(1500):
        passage = kinds[k % 3](51)
        if len(passage.encode()) < 250:
            passage += words(rnd, 60)[:250 - len(passage.encode())]
        texts = [f"{words(rnd, rnd.randrange(40))} {passage} {words(rnd, rnd.randrange(40))}".encode() for _ in range(2)]
        (first, second) = ([(a, b, t[a:b]) for a, b in zip([0, *e], e)] for t, e in
                           ((t, e.tolist()) for t, e in zip(texts, chunks.chunk_ends(texts, gear))))
        known, run, best = {c for _, _, c in first}, 0, 0
        for a, b, c in second:
            run = run + b - a if c in known else 0
            best = max(best, run)
        assert best >= 100, (k, passage)
        assert max(b - a for a, b, _ in second) < chunks.WINDOW + chunks.REACH + chunks.LEAST_GAP + chunks.WINDOW


def test_passages_of_51_words_are_removed(spark):
    rnd = random.Random(12)
    passages = [words(rnd, 51) for _ in range(200)]
    docs = [(c * 1000 + k, f"{words(rnd, 30)} {p} {words(rnd, 30)}") for c in range(2) for k, p in enumerate(passages)]
    got = {r["doc_id"]: r["n_removed"] for r in
           chunks.substring_report(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(got[k] == 0 for k in range(200)) and all(got[1000 + k] >= 100 for k in range(200))


def rows_without_id(spark):
    """Texts without id, texts of one id, repeated rows; and the same with ids in the order of (id, text hash)."""
    rnd = random.Random(13)
    shared = [words(rnd, 60) for _ in range(3)]
    items = [(3, shared[0] + " " + words(rnd, 40)), (5, words(rnd, 50) + " " + shared[1]), (5, "日本語" * 30 + words(rnd, 70))]
    items += [(None, "é" * (7 + k) + words(rnd, 20) + " 日本 " + shared[k % 3] + "ü" * (90 + k) + words(rnd, 30)) for k in range(9)]
    items += [(None, "éü" * 200 + str(k)) for k in range(3)] + [(None, None), (None, ""), items[5], items[0]]
    docs = spark.createDataFrame(items, "doc_id long, text string").repartition(3)
    tag = {r["text"]: r["t"] for r in docs.selectExpr("text", "xxhash64(text) as t").collect()}
    order = sorted(set(items), key=lambda r: (r[0] is None, r[0] or 0, tag[r[1]]))
    return docs, items, {r: 10 * k for k, r in enumerate(order)}


def test_substring_dedup_of_rows_without_id(spark):
    docs, items, place = rows_without_id(spark)
    key = {r: place[r] if r[0] is None else r[0] - 100 for r in items}     # those of one id stay one id
    exp = brute_chunks([(key[r], r[1]) for r in items], 100)
    cut = {r: r[1] and chunks.without_spans(r[1].encode(), [{"start": a, "end": b} for a, b in exp[key[r], r[1]]]).decode()
           for r in items}
    assert sum(cut[r] != r[1] for r in set(items) if r[0] is None) > 6
    kept = chunks.remove_repeats(docs).collect()
    assert sorted(map(tuple, kept), key=str) == sorted(((r[0], cut[r]) for r in items), key=str)
    got = chunks.substring_report(docs).collect()
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in got), key=str) == sorted(
        ((r[0], len((r[1] or "").encode()), len((r[1] or "").encode()) - len((cut[r] or "").encode())) for r in items), key=str)


def test_texts_of_one_id_are_compared_each_as_itself(spark):
    rnd = random.Random(21)
    a, b = words(rnd, 80), words(rnd, 80)
    items = [(5, a), (5, b), (9, b + " more"), (11, a + " more"), (12, words(rnd, 80)), (12, None)]
    got = setsketch.near_duplicates(spark.createDataFrame(items, "doc_id long, text string"), size=4).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in got) == [
        (5, 5, True), (5, 5, True), (9, 5, False), (11, 5, False), (12, 12, True), (12, 12, True)]


def test_linked_counts_all_intersections():
    rnd = np.random.default_rng(4)
    for k in range(60):
        sets = [np.unique(rnd.integers(0, 40, rnd.integers(0, 60))).astype(np.uint64) for _ in range(rnd.integers(1, 25))]
        label = rnd.integers(0, 4, len(sets))
        side = np.full(len(sets), 2) if k % 2 else rnd.integers(0, 2, len(sets))
        i, j = setsketch.linked(sets, label, side, 60, width=7)
        exp = {(x, y) for x in range(len(sets)) for y in range(len(sets))
               if label[x] != label[y] and side[x] != 1 and side[y] != 0 and
               100 * len(np.intersect1d(sets[x], sets[y])) >= 60 * len(np.union1d(sets[x], sets[y]))}
        assert set(zip(i.tolist(), j.tolist())) == exp


@pytest.mark.parametrize("block", [1024, 40])
def test_links_between_edits_of_one_text(spark, block):
    """Many edits of one text, most pairs just below the threshold: the components are those of brute force."""
    rnd = random.Random(22)
    base = words(rnd, 100, 3000).split(" ")
    items = []
    for i in range(150):
        w = list(base)
        for _ in range(rnd.choice([2, 3, 3, 4])):
            w[rnd.randrange(len(w))] = f"edit{i}x{rnd.randrange(3)}"
        items.append((i, " ".join(w)))
    docs = spark.createDataFrame(items, "doc_id long, text string").repartition(3)
    got = setsketch.near_duplicates(docs, size=4, star_rounds=1 if block < 1024 else 3, block=block).collect()
    exp = brute_near(items, 4, 80)
    assert sorted(map(tuple, got)) == sorted(exp)
    assert 1 < len({r[2] for r in exp}) < 150


# --- op6


def test_repeated_strings_of_rows_without_id(spark):
    docs, items, place = rows_without_id(spark)
    exp = brute_strings([(place[r], r[1]) for r in sorted(items, key=place.get)])
    got = suffixes.remove_repeated_strings(docs).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((r[0],) + exp[place[r], r[1]][1:] for r in items), key=str)


def brute_strings(items):
    seen, out = set(), {}
    for i, t in sorted(dict.fromkeys(items), key=lambda r: (r[0] is None, r[0] or 0)):
        data = (t or "").encode()
        mark = np.zeros(len(data) + 2, np.int8)
        for k in range(len(data) - 99):
            w = data[k:k + 100]
            if w in seen:
                mark[k + 1:k + 101] = 1
            seen.add(w)
        kept = bytes(np.frombuffer(data, np.uint8)[mark[1:-1] == 0])
        out[i, t] = (i, len(data), int(mark.sum()), int((np.diff(mark) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("memory_rows", [1 << 19, 5])
def test_repeated_strings_equal_brute_force(spark, memory_rows):
    items = [r[:2] for r in rows(2)]
    exp = brute_strings(items)
    got = suffixes.remove_repeated_strings(frame(spark, 2), keep_text=True, memory_rows=memory_rows).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted((exp[x] for x in items), key=str)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in got)
    assert suffixes.remove_repeated_strings(empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_induced_order_in_memory_and_on_disk(seed):
    """Both paths mark the same windows, with tiny pieces on disk."""
    r = random.Random(seed)
    core = bytes(r.choice(b"ab") for _ in range(24))
    bodies, shapes = [], []
    for k in range(40):
        left, right = r.randint(0, 76), r.randint(0, 76)
        body = bytes(r.choice(b"ab") if r.random() < 0.02 else 97 for _ in range(left)) + core + \
            bytes(r.choice(b"ab") if r.random() < 0.02 else 98 for _ in range(right))
        if len(body) >= 100:
            bodies.append(body)
            shapes.append((k, 1000, 1000 + left, len(body) - 99))
    if not bodies:
        return
    key, start, anchor, windows = (np.array(c) for c in zip(*shapes))
    s = suffixes.Snippets(np.zeros(len(key), np.int64), key, start, anchor, windows,
                          np.r_[0, np.cumsum([len(b) for b in bodies])], np.frombuffer(b"".join(bodies), np.uint8))
    found = [sorted((int(i), place) for ids, place in suffixes.sort_group_in_memory(s) for i in ids)]
    for piece in (1, 3, 1000):
        with tempfile.TemporaryDirectory() as folder:
            found.append(sorted((int(i), place) for ids, place in suffixes.sort_group_on_disk(s, folder, piece) for i in ids))
    seen, exp = set(), []
    for i, body in enumerate(bodies):
        for w in range(windows[i]):
            place = int(w - (anchor[i] - start[i]))
            if place <= 0:
                x = (place, body[w:w + 100])
                if x in seen:
                    exp.append((i, place))
                seen.add(x)
    assert all(f == sorted(exp) for f in found)


# --- op2

VECTORS = "vec_id long, embedding array<float>, label int, h long, cell string, extra string"


def vectors(seed, n=120, dim=24):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(12, dim))
    out = []
    for i in range(n):
        v = base[rng.integers(12)] + rng.normal(size=dim) * rng.choice([0.05, 0.2, 0.3, 0.45])
        out.append((int(i), [float(np.float32(x)) for x in v], int(rng.integers(3)), 1, "c", "x"))
    out += [(200 + k, out[k][1], out[k][2], 1, "c", "x") for k in range(6)]           # exact copies
    out += [(300, None, 1, None, None, None), (301, [], 1, 1, "", ""), (302, [0.0] * dim, 1, 1, "", ""),
            (303, [math.nan] + [1.0] * (dim - 1), 1, 1, "", ""), (304, [math.inf] + [1.0] * (dim - 1), 1, 1, "", ""),
            (305, [None] + [1.0] * (dim - 1), 1, 1, "", ""), (306, out[0][1], None, 1, "", ""),
            (307, out[0][1][:5], out[0][2], 1, "", ""), (308, [x * 2 for x in out[0][1]], out[0][2], 1, "", "")]
    out += [out[3], out[3], (None, out[4][1], out[4][2], 1, "c", "x")]                # repeated rows, null id
    return out


def brute_vectors(items, cosine):
    def good(v):
        return bool(v) and None not in v and all(map(math.isfinite, v)) and any(v)
    n = [0] * len(items)
    u = Union()
    big = 1 << 63
    ids = [big if r[0] is None else r[0] for r in items]
    close = 0
    for k, r in enumerate(items):
        u.root(k)
        for j in range(k):
            q = items[j]
            if r[2] is None or r[2] != q[2] or not (good(r[1]) and good(q[1])) or len(r[1]) != len(q[1]):
                continue
            a, b = np.array(r[1]), np.array(q[1])
            c = a @ b / math.sqrt((a @ a) * (b @ b))
            if c >= cosine or r[1] == q[1]:
                n[k] += 1
                n[j] += 1
                close += c < cosine + 0.01
                u.join(k, j)
    low = {}
    for k in range(len(items)):
        low[u.root(k)] = min(low.get(u.root(k), big), ids[k])
    out = []
    for k, r in enumerate(items):
        c = low[u.root(k)]
        c = r[0] if c == big else c
        out.append((r[0], n[k], c, r[0] == c if c is not None else True))
    return out, close


@pytest.mark.parametrize("block", [1024, 4])
def test_embedding_links_equal_brute_force(spark, block):
    items = vectors(1)
    docs = spark.createDataFrame(items, VECTORS).repartition(3)
    got = collisions.embedding_links(docs, 0.93, block=block).collect()
    exp, close = brute_vectors(items, 0.93)
    exp = sorted(exp, key=str)
    got = sorted(map(tuple, got), key=str)
    links, found = sum(r[1] for r in exp), sum(r[1] for r in got)
    assert links > 200 and found >= 0.97 * links and found <= links
    if found == links:
        assert got == exp
    assert collisions.embedding_links(spark.createDataFrame([], VECTORS)).count() == 0


def test_recall_of_links_at_the_threshold(spark):
    """Pairs whose cosine is just above 0.93 are found (calibration), none below is."""
    rng = np.random.default_rng(5)
    items = []
    for k in range(300):
        a = rng.normal(size=48)
        a /= np.linalg.norm(a)
        b = rng.normal(size=48)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        c = 0.9305 if k % 2 else 0.9295
        items += [(2 * k, a.tolist(), 1), (2 * k + 1, (c * a + math.sqrt(1 - c * c) * b).tolist(), 1)]
    docs = spark.createDataFrame(items, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in collisions.embedding_links(docs, 0.93).collect()}
    above = sum(got[2 * k] for k in range(300) if k % 2)
    assert above >= 0.95 * 150 and not any(got[2 * k] for k in range(300) if not k % 2)


def test_plan_calibration():
    plan = collisions.Plan(0.93)
    rng = np.random.default_rng(1)
    delta = np.abs(rng.normal(size=(20000, plan.lines)) * plan.distance)
    assert ((delta <= plan.window).sum(1) >= plan.least).mean() > 0.998
    assert collisions.Plan(0.99).tables < plan.tables
