"""Texts made so that weak hashes collide, and the cases that every operator has a defined result for."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

import test_pairs
import test_scans
import test_search
import test_substrings
from tidemark.llm import _arrow, bpe, decontaminate, hamming_search, jaccard_join, language, line_dedup, secrets, suffix_array, suffix_tree, tokens

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def twins(n):
    """A Thue-Morse word of n letters and its complement: alike under every polynomial hash modulo 2**64 from some length on."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [16, 200, 1024, 2048])
def test_hashes_of_twins(n):
    a, b = (np.frombuffer(x.encode(), np.uint8) for x in twins(n))
    data, starts, ends = np.concatenate((a, b, a)), np.array([0, n, 2 * n]), np.array([n, 2 * n, 3 * n])
    for hashed in (_arrow.word_hashes(data, starts, ends), _arrow.span_digests(data, starts, ends)):
        assert hashed[0] == hashed[2] != hashed[1]


def test_word_hashes_tell_words_apart():
    """Words of every length about the block size, and the same bytes at other places and before other bytes."""
    pick, words = np.random.default_rng(4), set()
    for size in range(1, 40):
        words |= {bytes(pick.integers(1, 3, size).astype(np.uint8)) for _ in range(30)}
    words |= {b"x" * i for i in (255, 256, 257, 263, 264, 265, 1000)}
    words = sorted(words)
    hashes = []
    for gap in (b"", b"\x00", b"zz"):
        data = np.frombuffer(gap.join(words), np.uint8)
        size = np.array([len(w) for w in words])
        starts = np.cumsum(size + len(gap)) - size - len(gap)
        hashes.append(_arrow.word_hashes(data, starts, starts + size).tolist())
    assert hashes[0] == hashes[1] == hashes[2] and len(set(hashes[0])) == len(words)


@pytest.fixture(scope="module", params=[1024, 2048])
def colliding(spark, request):
    a, b = twins(request.param)
    rest = " ".join(f"q{i}" for i in range(12))
    texts = {1: f"{a} {rest}", 2: f"{b} {rest}", 3: f"{rest} {a} {a} tail", 4: f"{rest} {b} {b} tail", 5: a, 6: b}
    return texts, spark.createDataFrame(list(texts.items()), "doc_id long, text string")


def test_join_of_twins(colliding):
    texts, docs = colliding
    sets = test_pairs.shingle_sets(texts, 3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link(docs, 3, 90).collect()}
    want = test_pairs.brute_components(sets, 90)
    assert got == {d: (len(sets[d]), want[d]) for d in texts}


def test_substrings_of_twins(colliding):
    texts, docs = colliding
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in suffix_tree.dedup(docs, 13).collect()}
    assert got == test_substrings.brute_words(texts, 13)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_array.dedup(docs, 200).collect()}
    assert got == test_substrings.brute_bytes(texts, 200)


def test_lines_and_benchmark_of_twins(spark, colliding):
    texts, docs = colliding
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept) for r in line_dedup.dedup(docs).collect()}
    assert got == test_pairs.brute_lines(texts)
    items = [(1, texts[5]), (2, " ".join([texts[5], *(f"q{i}" for i in range(9))]))]
    got = {r.doc_id: tuple(r)[1:6] for r in decontaminate.scan(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == test_scans.brute_contamination(texts, items)


@pytest.fixture(scope="module")
def long_texts(spark):
    """Texts beyond every chunk's limit: more than a megabyte of words, one line, one word, and copies of them."""
    pick = np.random.default_rng(8)
    vocabulary = np.array(["".join(pick.choice(list("abcdefghijklmno"), 7)) for _ in range(20_000)])
    prose = " ".join(pick.choice(vocabulary, 160_000).tolist())
    texts = {1: prose, 2: prose, 3: prose[:100_000] + " other end", 4: "w" * 1_200_000, 5: "short", 6: None, 7: "line one of it here\n" * 30_000}
    return texts, spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3).cache()


def test_long_texts_of_pairs(long_texts):
    texts, docs = long_texts
    sets = test_pairs.shingle_sets(texts, 3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link(docs, 3, 90).collect()}
    assert got == {d: (len(sets[d]), 1 if d == 2 else d) for d in texts}
    got = {r.doc_id: (r.n_lines, r.n_removed) for r in line_dedup.dedup(docs).collect()}
    assert got == {1: (1, 0), 2: (1, 1), 3: (1, 0), 4: (1, 0), 5: (1, 0), 6: (0, 0), 7: (30_000, 29_999)}


def test_long_texts_of_substrings(long_texts):
    texts, docs = long_texts
    sizes = {d: len((t or "").encode()) for d, t in texts.items()}
    got = {r.doc_id: (r.n_bytes, r.n_removed) for r in suffix_array.dedup(docs, 200).collect()}
    assert {d: x[0] for d, x in got.items()} == sizes
    assert [got[d][1] for d in (1, 2, 4, 5, 6, 7)] == [sizes[1], sizes[2], sizes[4], 0, 0, sizes[7]] and got[3][1] == 100_000
    got = {r.doc_id: (r.n_words, r.n_removed) for r in suffix_tree.dedup(docs, 13).collect()}
    n = {d: len((t or "").split()) for d, t in texts.items()}
    assert {d: x[0] for d, x in got.items()} == n and [got[d][1] for d in (1, 2, 4, 5, 6, 7)] == [0, n[2], 0, 0, 0, 0] and got[3][1] >= n[3] - 3


def test_long_texts_of_scans(spark, long_texts):
    import sentencepiece
    from tokenizers import Tokenizer

    texts, docs = long_texts
    docs = docs.where("doc_id <> 4")  # a word of megabytes takes the libraries themselves minutes
    own = {d: t or "" for d, t in texts.items() if d != 4}
    pieces, merges = sentencepiece.SentencePieceProcessor(model_file=PIECES), Tokenizer.from_file(BPE)
    assert {r.doc_id: r.n_tokens for r in tokens.count_tokens(docs, PIECES).collect()} == {d: len(pieces.encode(t)) for d, t in own.items()}
    want = {d: merges.encode(t, add_special_tokens=False).ids for d, t in own.items()}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digest(docs, BPE).collect()}
    assert got == {d: (len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(), hashlib.sha256(own[d].encode()).hexdigest()) for d, x in want.items()}
    item = " ".join(texts[1].split()[5000:5012])
    found = {r.doc_id: r.n_hit for r in decontaminate.scan(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert found == {1: 12, 2: 12, 3: 12, 5: 0, 6: 0, 7: 0}
    field = secrets.Field(np.zeros((secrets.FEATURES, 3), np.float32), np.zeros((3, 3)), np.array([1.0, 0, 0]))
    assert all(r.spans == "" for r in secrets.scan(docs.where("doc_id in (1, 7)"), field).select("spans").where("false").collect())
    assert {r.doc_id: r.n_hex for r in secrets.scan(docs, field).collect()} == {d: sum(k == 2 for k, _, _ in test_scans.brute_spans(t)) for d, t in own.items()}


def test_repeated_rows_and_clashing_columns_of_scans(spark, odd_ids):
    """A row for each row, whatever its id, and whatever other columns there are."""
    clash = odd_ids.selectExpr("doc_id", "text", "key as n_tokens", "z as chunk", "key as n_hit", "z as spans", "key as score", "z as place", "z as data", "'en' as lang")
    benchmark = spark.createDataFrame([(1, test_scans.WORD.findall(odd_ids.first().text or "x")[0], "z")], "item_id long, text string, n_hit string")
    assert sorted(r.n_tokens for r in bpe.digest(clash, BPE).collect())[:2] == [0, 0] and bpe.digest(clash, BPE).count() == 5
    assert tokens.count_tokens(clash, PIECES).where("n_tokens > 0").count() == 3
    found = decontaminate.scan(clash, benchmark.union(benchmark))
    assert sorted((r.n_items, r.contaminated) for r in found.collect()) == [(0, False), (0, False), (1, True), (1, True), (1, True)]
    field = secrets.fit(["a house near water " * 5] * 9)
    assert sorted(r.spans for r in secrets.scan(clash, field).collect()) == [""] * 5
    model = language.learn(clash)
    assert sorted(r.lang_pred for r in language.identify(clash, model).collect()) == ["en"] * 3 + ["und"] * 2
    assert language.keep(clash, model, 0.5).columns == clash.columns


def test_empty_tables_of_scans(spark, empty):
    benchmark = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    for found in (bpe.digest(empty, BPE), bpe.encode(empty, BPE), tokens.count_tokens(empty, PIECES), decontaminate.scan(empty, benchmark), decontaminate.clean(empty, benchmark), line_dedup.clean(empty), jaccard_join.keep_one(empty)):
        assert found.count() == 0


def test_secret_columns_of_the_query(spark, corpus, texts):
    """Every column of the scan but the method's own spans, against brute force over hostile and common texts."""
    rows = {**{1000 + i: t for i, t in enumerate(test_scans.SECRETS)}, **texts}
    pick = np.random.default_rng(6)
    parts = ["token", "secret=", "AKIA", "0123456789abcdef", "é", " ", "\n", "api_key: ", "'", '"', "ABCDEFGHIJKLMNOP", "deadbeef", "=", "xyz"]
    rows |= {2000 + i: "".join(pick.choice(parts, int(pick.integers(1, 12)))) for i in range(300)}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    for r in secrets.scan(docs, secrets.learn(docs)).collect():
        base = test_scans.brute_spans(rows[r.doc_id] or "")
        said = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for k, _, _ in base) for kind in range(3))
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        spans = [x.split(":") for x in r.spans.split(",") if x]
        assert [":".join(x) for x in spans if x[0] != "crf"] == [x for x in said.split(",") if x]
        assert spans == sorted(spans, key=lambda x: (int(x[1]), secrets.KINDS.index(x[0])))


def plain_ftrl(rows, epochs=3, alpha=0.5, beta=1.0, l1=0.002, l2=0.01):
    """FTRL-proximal with elastic net, feature by feature, over the same n-grams and folds."""
    languages = sorted({x[1] for x in rows})
    parts, total, _ = language.grams([x[0] for x in rows])
    documents, df = [], {}
    for i in range(len(rows)):
        count = {}
        for f, a in parts:
            for x in f[a[i] : a[i + 1]].tolist():
                count[x] = count.get(x, 0) + 1
        documents.append({x: c / max(1, total[i]) * language.SCALE for x, c in count.items()})
        for x in count:
            df[x] = df.get(x, 0) + 1
    idf = {x: np.log((1 + len(rows)) / (1 + c)) + 1 for x, c in df.items()}
    z, n, k = {}, {}, len(languages)

    def weight(key, penalty):
        zz, nn = z.get(key, 0.0), n.get(key, 0.0)
        return 0.0 if abs(zz) <= penalty else -(zz - np.sign(zz) * penalty) / ((beta + np.sqrt(nn)) / alpha + l2)

    def step(key, g, penalty):
        w, old = weight(key, penalty), n.get(key, 0.0)
        z[key] = z.get(key, 0.0) + g - (np.sqrt(old + g * g) - np.sqrt(old)) / alpha * w
        n[key] = old + g * g

    held = [i % 5 == 4 if len(rows) >= 25 else False for i in range(len(rows))]
    for _ in range(epochs):
        for i in range(len(rows)):
            if held[i]:
                continue
            x = {f: v * idf[f] for f, v in documents[i].items()}
            logit = np.array([sum(v * weight((f, c), l1) for f, v in x.items()) + weight((None, c), 0.0) for c in range(k)])
            p = np.exp(logit - logit.max())
            g = p / p.sum()
            g[languages.index(rows[i][1])] -= 1
            steps = [((f, c), v * g[c], l1) for f, v in x.items() for c in range(k)] + [((None, c), g[c], 0.0) for c in range(k)]
            for s in steps:
                step(*s)
    return languages, lambda f, c: weight((f, c), l1) * idf[f], lambda c: weight((None, c), 0.0), df


def test_language_model_against_plain_ftrl():
    pick = np.random.default_rng(3)
    words = {"aa": ["dog", "house", "the"], "bb": ["chien", "maison", "le"], "cc": ["hund", "haus", "das"]}
    rows = [(" ".join(pick.choice(words[c], 6)), c) for c in pick.choice(list(words), 40).tolist()]
    model = language.fit(rows)
    languages, weight, bias, df = plain_ftrl(rows)
    assert model.languages == languages
    for f in df:
        assert np.allclose(model.weights[f], [weight(f, c) for c in range(3)], atol=1e-5)
    assert np.allclose(model.bias, [bias(c) for c in range(3)])
    assert not model.weights[[f for f in range(2000) if f not in df]].any()
    # the temperature is the best of its grid on the fifth that isn't trained on
    held = [rows[i] for i in range(40) if i % 5 == 4]
    logits, _ = model.logits([x[0] for x in held])
    loss = lambda t: -np.mean([np.log(max(language.softmax(logits[i : i + 1] / t)[0][languages.index(x[1])], 1e-12)) for i, x in enumerate(held)])
    assert all(loss(model.temperature) <= loss(t) + 1e-9 for t in np.geomspace(0.05, 20, 121))


def test_recall_of_lines(spark):
    """Measured, not computed: of line pairs at similarity 0.8 or more that brute force finds, the operator links all but very few."""
    lines = {}
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").limit(400).collect():
        for x in (r.text or "").split("\n"):
            if x.strip(" \t\r\x0b\x0c"):
                lines.setdefault(x, len(lines))
    texts = {i: x for x, i in lines.items()}
    want = test_pairs.brute_components({i: {x[j : j + 8] for j in range(max(1, len(x) - 7))} for i, x in texts.items()}, 80)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = {r.doc_id for r in line_dedup.dedup(docs).where("n_removed = 0").collect()}
    gone, should = set(texts) - kept, {i for i in texts if want[i] != i}
    assert gone <= should and len(gone) >= 0.995 * len(should)


def test_equal_sizes_only(corpus, texts):
    """At 100 percent only equal sets link, however large they are."""
    sets = test_pairs.shingle_sets(texts, 1)
    want = test_pairs.brute_components(sets, 100)
    assert {r.doc_id: r.component_id for r in jaccard_join.link(corpus, 1, 100).collect()} == want


def test_words_are_encoded_once(spark, monkeypatch, tmp_path):
    """Each chunk gets the ids of each of its words, at its place, as the library gives them."""
    spark.createDataFrame([(i, f"alpha beta own{i} the the") for i in range(6)], "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    rows = _arrow.texts(spark.read.parquet(str(tmp_path / "d")))
    got = {}
    for r in bpe.word_ids(rows, BPE).collect():
        places, edges, data = bpe._opened(bytes(r.data), numbers=True)
        for p, a, b in zip(places, edges, edges[1:], strict=False):
            assert got.setdefault((bytes(r.chunk), int(p)), data[a:b]) == data[a:b]
    model = bpe._model(BPE)[0]
    words = ["alpha", " beta", " the", *(f" own{i}" for i in range(6))]
    assert set(got.values()) == set(bpe._ids(model, words))
    n = len({c for c, _ in got})
    assert len(got) == 3 * n + 6


def test_chunks_of_both_passes_are_the_same(spark, monkeypatch, tmp_path):
    """Also where Arrow batches are bounded by bytes, which other columns count in."""
    monkeypatch.setattr(_arrow, "BATCH_BYTES", 20_000)
    monkeypatch.setattr(bpe, "CHUNK", 30_000)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        spark.createDataFrame([(f"id {i} of a long kind", " ".join(["alpha beta", f"own{i}"] * (i % 40))) for i in range(3000)], "doc_id string, text string").write.parquet(str(tmp_path / "d"))
        rows = _arrow.texts(spark.read.parquet(str(tmp_path / "d")))
        told, packed = ({bytes(r.chunk) for r in df.select("chunk").distinct().collect()} for df in (bpe.word_ids(rows, BPE), bpe._texts(rows)))
        assert len(packed) >= 1 and told == packed
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)


def test_words_that_do_not_come_are_encoded():
    """Ids of some places, of none and of all give the same."""
    column = pa.array(["one two three", None, "two two one", " odd ", "x"])
    ids, offsets = bpe.encode_chunk(BPE, column)
    words = bpe.cut(BPE, column).words
    table = bpe._ids(bpe._model(BPE)[0], words.to_pylist())
    for places in ([], [1], list(range(len(words)))):
        own = bpe.encode_chunk(BPE, column, np.array(places, np.int32), pa.array([table[i] for i in places], pa.binary()))
        assert own[0].tolist() == ids.tolist() and own[1].tolist() == offsets.tolist()


def test_one_odd_vector(spark):
    """A vector of another length is neither found nor searched for, and takes nothing from the others."""
    vectors = np.random.default_rng(5).normal(size=(40, 8)).tolist()
    df = spark.createDataFrame([*enumerate(vectors), (50, [1.0] * 4), (51, [1.0] * 12)], "vec_id long, embedding array<double>")
    codes = {r.id: r.code for r in hamming_search.encode(df, 32).collect()}
    got = {}
    for r in hamming_search.search(df, df.where("vec_id % 20 = 0 or vec_id = 50"), 5, 32).orderBy("vec_id", "rank").collect():
        got.setdefault(r.vec_id, []).append((r.distance, r.neighbor_id))
    assert got == test_search.brute(codes, [0, 20], 5)
