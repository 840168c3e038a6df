import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import test_pairs
import test_scans
from tidemark.llm import language, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """What each stage gets: the documents, and the rows that the stage before has kept."""
    folder, out = tmp_path_factory.mktemp("stages"), []
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out.append(docs)
        stage(spark, docs, SF).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
    return [*out, docs]


def known(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_language_stage(inputs):
    model, texts = language.learn(inputs[0]), known(inputs[0])
    names, scores = model.predict(list(texts.values()))
    assert known(inputs[1]) == {d: t for (d, t), n, s in zip(texts.items(), names, scores, strict=True) if n != "und" and s >= corpus_pipeline.MIN_SCORE}


def test_line_stage(inputs):
    texts = known(inputs[1])
    want = test_pairs.brute_lines(texts)
    got = known(inputs[2])
    assert got == {d: want[d][2] for d in texts if not want[d][0] or want[d][1] < want[d][0]}


def test_near_duplicate_stage(inputs):
    texts = known(inputs[2])
    root = test_pairs.brute_components(test_pairs.shingle_sets(texts, 5), 80)
    assert known(inputs[3]) == {d: t for d, t in texts.items() if root[d] == d}


def test_decontamination_stage(spark, inputs):
    texts, items = known(inputs[3]), [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    found = test_scans.brute_contamination(texts, items)
    got = known(inputs[4])
    assert set(got) == {d for d, x in found.items() if x[1] <= 0.5 * x[0]}
    for d, t in got.items():  # hit words go, the others stay
        assert (t == texts[d]) == (not found[d][4]) and len(test_scans.WORD.findall(t.translate({c: c + 32 for c in range(65, 91)}))) == found[d][0] - found[d][1]


def test_encoding_stage(inputs):
    from tokenizers import Tokenizer

    model, texts = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), known(inputs[4])
    got = {r.doc_id: (list(r.ids), r.n_tokens, r.ids_sha256) for r in inputs[5].collect()}
    want = {d: model.encode(t or "", add_special_tokens=False).ids for d, t in texts.items()}
    assert got == {d: (x, len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest()) for d, x in want.items()}


def test_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "", "en", "s", 0), (None, "the and of to in", "en", "s", 16)], docs.schema)
    docs = docs.union(odd)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_duplicates", "decontamination", "bpe"]
    before = docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if i < 4:
            assert out.columns == docs.columns
            assert out.count() <= before and out.where(F.col("text").isNotNull() & (F.col("n_chars") != F.char_length("text"))).count() == 0
        before, docs = out.count(), out
    assert {"doc_id", "ids", "n_tokens"} <= set(docs.columns) and before > 100


def test_run_and_registration(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 100
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
