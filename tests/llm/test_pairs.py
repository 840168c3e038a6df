import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import _groups, components, jaccard_join, line_dedup


def union(parent, a, b):
    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    a, b = root(a), root(b)
    parent[max(a, b)] = min(a, b)
    return root


def brute_components(sets, percent):
    parent = {d: d for d in sets}
    inverted = defaultdict(list)
    for d in sorted(sets):
        common = Counter(e for k in sets[d] for e in inverted[k])
        for e, n in common.items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[e]) - n):
                union(parent, d, e)
        for k in sets[d]:
            inverted[k].append(d)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    return {d: root(d) for d in sets}


def shingle_sets(texts, n):
    out = {}
    for d, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[d] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    return out


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_join(corpus, texts, n, percent):
    sets = shingle_sets(texts, n)
    want = brute_components(sets, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.link(corpus, n, percent).collect()}
    assert got == {d: (len(sets[d]), want[d]) for d in sets}


def test_join_of_crowds(spark):
    """Large groups of near copies in chains, so that buckets, bands and blocks are used."""
    pick = np.random.default_rng(3)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for j in pick.integers(0, 120, int(pick.integers(0, 5))):
            words[j] = f"e{pick.integers(0, 40)}"
        rows.append((i, " ".join(words[: 120 - int(pick.integers(0, 4))])))
    rows += [(1000 + i, " ".join(f"u{i}x{j}" for j in range(50)) + " " + " ".join(base[:10])) for i in range(40)]
    sets = shingle_sets(dict(rows), 3)
    want = brute_components(sets, 90)
    for block in (_groups.BLOCK, 4000):
        old, _groups.BLOCK = _groups.BLOCK, block
        try:
            got = {r.doc_id: r.component_id for r in jaccard_join.link(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()}
        finally:
            _groups.BLOCK = old
        assert got == want


def test_keep_one(corpus, texts):
    want = brute_components(shingle_sets(texts, 5), 80)
    kept = jaccard_join.keep_one(corpus, 5, 80)
    assert kept.columns == corpus.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d in want if want[d] == d)


def test_join_odd_ids(odd_ids, empty):
    got = sorted((r.n_shingles, r.component_id is None, r.component_id or 0) for r in jaccard_join.link(odd_ids, 3, 90).collect())
    assert got == [(0, False, 2), (0, True, 0), (17, False, 1), (17, False, 1), (17, False, 1)]
    assert jaccard_join.keep_one(odd_ids).count() == 3
    assert jaccard_join.link(empty).count() == 0


def brute_lines(texts, percent=80, k=8):
    place = {}
    for d in sorted(texts):
        for i, line in enumerate((texts[d] or "").split("\n")):
            if line.strip(" \t\r\x0b\x0c"):
                place.setdefault(line, (d, i))
    lines = list(place)
    root = brute_components({i: {x[j : j + k] for j in range(max(1, len(x) - k + 1))} for i, x in enumerate(lines)}, percent)
    keep = {place[lines[i]] for i in root if root[i] == i}
    out = {}
    for d, t in texts.items():
        listed = (t or "").split("\n")
        left = [x for i, x in enumerate(listed) if not x.strip(" \t\r\x0b\x0c") or (d, i) in keep]
        out[d] = (sum(bool(x.strip(" \t\r\x0b\x0c")) for x in listed), len(listed) - len(left), "\n".join(left))
    return out


def test_lines(corpus, texts):
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept) for r in line_dedup.dedup(corpus).collect()}
    assert got == brute_lines(texts)


def test_fuzzy_lines(spark):
    pick = np.random.default_rng(5)
    words = ["".join(pick.choice(list("abcdefgh"), 6)) for _ in range(300)]
    base = [" ".join(pick.choice(words, 20)) for _ in range(12)]
    texts = {}
    for d in range(60):
        lines = []
        for b in pick.choice(len(base), 3):
            line = list(base[b])
            for at in pick.integers(0, len(line), int(pick.integers(0, 3))):
                line[at] = "Z"
            lines.append("".join(line))
        texts[d] = "\n".join([*lines, f"own line of document number {d} and nothing else like it"])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept) for r in line_dedup.dedup(docs).collect()}
    assert got == brute_lines(texts)


def test_clean_lines(corpus, texts, odd_ids, empty):
    want = brute_lines(texts)
    kept = line_dedup.clean(corpus)
    assert kept.schema == corpus.schema
    got = {r.doc_id: r.text for r in kept.collect()}
    assert got == {d: (want[d][2] if texts[d] is not None else None) for d in texts if not want[d][0] or want[d][1] < want[d][0]}
    odd = line_dedup.clean(odd_ids)
    assert odd.columns == odd_ids.columns and odd.count() == 3
    assert line_dedup.dedup(empty).count() == 0


def test_recall_of_bands():
    """At the threshold a pair is a candidate with at least the probability that the module states."""
    assert 1 - (1 - 0.8**line_dedup.ROWS) ** line_dedup.BANDS > 0.999


@pytest.mark.parametrize(("common", "own", "missed"), [(8, 1, 0.0006), (80, 10, 0.0006), (34, 3, 0.0002), (36, 2, 0.0001)])
def test_measured_recall(common, own, missed):
    """Of 40,000 pairs at similarity 0.8, 0.8, 0.85 and 0.9, signatures() separates no more than independent hashes would."""
    pick, apart = np.random.default_rng(common), 0
    for _ in range(8):
        both = pick.integers(0, 1 << 64, (5000, common), dtype=np.uint64)
        sides = [np.hstack([both, pick.integers(0, 1 << 64, (5000, own), dtype=np.uint64)]) for _ in range(2)]
        bands = zip(*(line_dedup.signatures(x.ravel(), np.arange(5001) * x.shape[1]) for x in sides), strict=True)
        apart += int((~np.any([a == b for a, b in bands], axis=0)).sum())
    assert apart <= missed * 40000


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 105), (105, 101), (101, 100), (7, 7)]
    got = dict(components.components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == dict.fromkeys(range(41), 0) | dict.fromkeys((100, 101, 105), 100)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_line_sets_are_made_in_slices(monkeypatch):
    """A worker's memory follows a slice of a batch's lines besides the sets themselves, which stay the same."""
    import tracemalloc

    lines = [f"{'été ' * (i % 3)}line {i} of a batch with words {i * i} and the rest of it, which is always the same".encode() for i in range(10_000)] + [b"", b"short", b"x" * 300_000]
    tracemalloc.start()
    try:
        sets = line_dedup._line_sets(lines)
        held, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert peak - held < 35 * sum(map(len, lines))
    monkeypatch.setattr(line_dedup, "SLICE", 1 << 40)
    whole = line_dedup._line_sets(lines)
    assert len(sets) == len(whole) == len(lines) and all((a == b).all() and len(a) == len(b) for a, b in zip(sets, whole, strict=True))
    assert line_dedup._line_sets([]) == []
