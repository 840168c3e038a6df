import numpy as np
import pytest

from tidemark.llm import hamming_search, queries


def brute(codes, queries, k):
    out = {}
    for q in queries:
        if q in codes:
            own = sorted((bin((codes[q] ^ c) & (2**64 - 1)).count("1"), i) for i, c in codes.items() if i != q)
            out[q] = own[:k]
    return out


@pytest.mark.parametrize(("n", "bits", "k", "spread"), [(400, 32, 10, 0), (300, 16, 5, 0.05), (8, 32, 10, 0), (250, 64, 3, 0.3)])
def test_search(spark, n, bits, k, spread):
    pick = np.random.default_rng(n)
    vectors = pick.normal(size=(n, 12))
    if spread:  # groups of near and of equal vectors
        vectors = vectors[pick.integers(0, 12, n)] + spread * pick.normal(size=(n, 12)) * (pick.random((n, 1)) < 0.7)
    rows = [(i, v.tolist(), 0, "x") for i, v in enumerate(vectors)]
    rows += [rows[3], (None, rows[0][1], 1, "y"), (n, None, 1, "y"), (n + 1, [1.0], 1, "y"), (n + 2, [float("nan")] * 12, 1, "y"), (n + 3, [None] * 12, 1, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, code int, query string")
    codes = {r.id: r.code for r in hamming_search.encode(df, bits).collect()}
    assert len(codes) == n
    queries = df.where("vec_id % 5 = 0")
    old = hamming_search.CHUNK
    for chunk in (old, 7):
        hamming_search.CHUNK = chunk
        try:
            found = hamming_search.search(df, queries, k, bits).collect()
        finally:
            hamming_search.CHUNK = old
        got = {}
        for r in sorted(found, key=lambda r: (r.vec_id, r.rank)):
            got.setdefault(r.vec_id, []).append((r.distance, r.neighbor_id))
        assert got == brute(codes, range(0, n + 4, 5), k)


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_long_codes(spark, spread):
    """Codes of several words, in clusters and without: exact over the codes, and nearer to the vectors' own neighbours than short ones."""
    pick = np.random.default_rng(9)
    vectors = pick.normal(size=(500, 64))
    if spread < 1:
        vectors = vectors[pick.integers(0, 25, 500)] + spread * pick.normal(size=(500, 64))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    codes = {r.id: int.from_bytes(r.code, "little") for r in hamming_search.encode(df, 256).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    recall = {}
    for bits in (32, 256):
        got = {}
        for r in hamming_search.search(df, df.where("vec_id % 20 = 0"), 10, bits).orderBy("vec_id", "rank").collect():
            got.setdefault(r.vec_id, []).append((r.distance, r.neighbor_id))
        true = {q: set(np.argsort(-(unit @ unit[q]), kind="stable")[1:11].tolist()) for q in got}
        recall[bits] = np.mean([len(true[q] & {i for _, i in x}) / 10 for q, x in got.items()])
    assert got == {q: sorted(((codes[q] ^ c).bit_count(), i) for i, c in codes.items() if i != q)[:10] for q in range(0, 500, 20)}
    assert recall[256] > (1.5 if spread == 1 else 1.1) * recall[32]


def test_production_codes(spark, monkeypatch, tmp_path):
    """The query's codes have several times the bits of its vectors' 64 dimensions."""
    seen = []
    monkeypatch.setattr(hamming_search, "search", lambda *a, **b: seen.append(b["bits"]))
    spark.createDataFrame([(1, [0.0])], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    queries.op8_topk_hamming(spark, str(tmp_path))
    assert seen[0] >= 128


def test_a_longer_vector(spark):
    """One malformed row leaves the others as they are."""
    vectors = np.random.default_rng(2).normal(size=(30, 8)).tolist()
    good = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    bad = spark.createDataFrame([*enumerate(vectors), (99, [1.0] * 9), (100, []), (101, [None] * 9), (102, [None] * 9)], good.schema)
    assert sorted(hamming_search.encode(bad, 64).collect()) == sorted(hamming_search.encode(good, 64).collect())
    assert hamming_search.encode(bad, 64).count() == 30


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hamming_search.search(df, df).count() == 0


def test_cuts():
    assert hamming_search.cuts(32, 65536) == [(0, 16), (16, 16)] and hamming_search.cuts(8, 10**9) == [(0, 8)]
    assert sum(len(hamming_search.masks(5, r)) for r in range(6)) == 32
