"""The corpus pipeline against its stages' brute-force versions, one after another."""

import re
import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from edge import SCHEMA, empty, frame, rows
from test_dedup import brute_chunks, brute_near
from test_quality import plain
from test_tokens import WORD, Tokenizer, check_packing, ids_of
from test_urls_secrets import all_spans
from tickrisk.llm import chunks, quality, secrets

LABELS = "doc_id long, quality int, toxic int"


def folder(spark, tmp_path, docs, labels=()):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(labels), LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def redacted(text):
    out, at = "", 0
    for a, _, _, b in all_spans(text, secrets.ScanRules()):
        if a >= at:
            out += text[at:a] + "[secret]"
        at = max(at, b)
    return out + text[at:]


def expected():
    kept = [r for r in rows() if not (plain(r[1])[0] < 10 or 100 * plain(r[1])[4] > 20 * plain(r[1])[0])]
    gone = {r[0] for r in brute_near([r[:2] for r in kept], 5, 80) if not r[3]}
    kept = [r for r in kept if r[0] not in gone]
    spans = brute_chunks([r[:2] for r in kept], 100)
    out = []
    for r in kept:
        cut = chunks.without_spans(r[1].encode(), [{"start": a, "end": b} for a, b in spans[r[0], r[1]]]).decode()
        text = redacted(cut)
        out.append((r[0], text) + r[2:4] + (len(text),) + r[5:])
    return out


def test_stages_equal_brute_force(spark, tmp_path):
    sf = folder(spark, tmp_path, frame(spark))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns, name
    assert sorted(map(tuple, docs.collect()), key=str) == sorted(expected(), key=str)
    tokenizer, pieces = Tokenizer.from_file(WORD), []
    for r in expected():
        ids = ids_of(tokenizer, r[1]) + [0]
        pieces += [(r[0], p, a, len(ids[a:a + 2048]), zlib.crc32(np.array(ids[a:a + 2048], "<u4").tobytes()))
                   for p, a in enumerate(range(0, len(ids), 2048))]
    got = corpus_pipeline.run(spark, sf).collect()
    n = check_packing(got, pieces, 2048)
    assert n <= -(-sum(p[3] for p in pieces) // 2048) + 1


def test_empty_tables(spark, tmp_path):
    sf = folder(spark, tmp_path, empty(spark))
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_stage_names_and_entry():
    import __spark_entry__ as E
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "minhash_near_dedup", "substring_dedup", "secret_scans", "best_fit_packing"]
    names = list(E.queries())
    assert [n for n in names if n.startswith("op")] == sorted(
        (n for n in names if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0]))
    assert sum(n.startswith("op") for n in names) == 13 and "pipeline" in names
    assert SCHEMA.startswith("doc_id")


def test_without_the_subpackage():
    """The entry module still imports and serves the other queries when the folders are gone."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = ("import sys; sys.path.insert(0, %r)\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name in ('corpus_pipeline', 'tickrisk.llm'):\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as E\n"
            "print('N', len(E.queries()), any(q.startswith('op') for q in E.queries()))\n" % repo)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    found = re.search(r"N (\d+) False", out.stdout)
    assert found and int(found[1]) >= 28, out.stderr[-1500:]


def test_trees_decide_in_the_pipeline(spark, tmp_path):
    """With labels of both classes the trees run, and the stage keeps what the operator keeps."""
    data = [r for r in rows() if r[0] is not None]
    labels = [(r[0], int("a" in (r[1] or "")[:3]), 0) for r in data]
    sf = folder(spark, tmp_path, frame(spark), labels)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    assert model is not None
    judged = {(r["doc_id"], r["n_words"]): r["kept"] for r in quality.judge(docs, model).collect()}
    kept = corpus_pipeline.quality_rules(spark, docs, sf)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(
        (r for r in rows() if judged[r[0], plain(r[1])[0]]), key=str)
    assert 0 < kept.count() < sum(plain(r[1])[0] >= 10 for r in rows())
    assert corpus_pipeline.run(spark, sf).where("piece = 0").count() > 0


def test_all_null_texts(spark, tmp_path):
    docs = frame(spark).limit(6).withColumn("text", F.lit(None).cast("string"))
    assert corpus_pipeline.run(spark, folder(spark, tmp_path, docs)).count() == 0


def test_all_null_ids(spark, tmp_path):
    """Rows without id have no near-duplicates: each good one has a first piece."""
    data = [(None, *r[1:]) for r in rows() if plain(r[1])[0] >= 10][:8]
    sf = folder(spark, tmp_path, spark.createDataFrame(data, SCHEMA))
    good = [r for r in data if not 100 * plain(r[1])[4] > 20 * plain(r[1])[0]]
    out = corpus_pipeline.run(spark, sf).collect()
    assert all(r["doc_id"] is None for r in out) and sum(r["piece"] == 0 for r in out) == len(good) > 3
