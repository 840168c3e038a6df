import hashlib
import re
import sys
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import _repeats, suffix_array, suffix_tree


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def brute_bytes(texts, length):
    raw = {d: (t or "").encode() for d, t in texts.items()}
    count = Counter(b[i : i + length] for b in raw.values() for i in range(len(b) - length + 1))
    out = {}
    for d, b in raw.items():
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = True
        edges = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(c for c, g in zip(b, gone, strict=False) if not g)
        out[d] = (len(b), int(gone.sum()), edges, sha(kept))
    return out


def brute_words(texts, window):
    words = {d: re.findall(r"[^\x20\x09-\x0D]+", t or "") for d, t in texts.items()}
    least = {}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            least.setdefault(tuple(words[d][i : i + window]), d)
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if least[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        out[d] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()))
    return out


@pytest.mark.parametrize("length", [200, 30])
def test_bytes(corpus, texts, length):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_array.dedup(corpus, length).collect()}
    assert got == brute_bytes(texts, length)


@pytest.mark.parametrize("window", [13, 3])
def test_words(corpus, texts, window):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in suffix_tree.dedup(corpus, window).collect()}
    assert got == brute_words(texts, window)


def test_hot_anchors(corpus, texts, monkeypatch):
    monkeypatch.setattr(_repeats, "HOT_LEAST", 2)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_array.dedup(corpus, 40).collect()}
    assert got == brute_bytes(texts, 40)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in suffix_tree.dedup(corpus, 5).collect()}
    assert got == brute_words(texts, 5)


def test_odd_ids(odd_ids):
    got = sorted((r.n_bytes, r.n_removed) for r in suffix_array.dedup(odd_ids, 200).collect())
    assert got == [(0, 0), (0, 0), (486, 486), (486, 486), (486, 486)]
    got = sorted((r.doc_id is None, r.n_words, r.n_removed) for r in suffix_tree.dedup(odd_ids, 13).collect())
    assert got == [(False, 0, 0), (False, 102, 0), (False, 102, 0), (True, 0, 0), (True, 102, 102)]


def test_empty(empty):
    assert suffix_array.dedup(empty).count() == 0 and suffix_tree.dedup(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 6))
def test_suffix_array(values, copies):
    text = np.array(values * copies, np.uint8)
    raw = text.tolist()
    want = sorted(range(len(raw)), key=lambda i: raw[i:])
    order = suffix_array.suffix_array(text)
    assert order.tolist() == want
    lcp = suffix_array.common_prefixes(text, order).tolist()
    for k in range(1, len(want)):
        a, b, n = want[k - 1], want[k], 0
        while max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
            n += 1
        assert lcp[k] == n


@pytest.mark.parametrize("letters", [2, 20, 256])
def test_suffix_array_of_repeats(letters):
    pick = np.random.default_rng(letters)
    part = pick.integers(0, letters, 900).astype(np.uint8)
    text = np.concatenate([part, part[100:700], pick.integers(0, letters, 500).astype(np.uint8), part])
    raw = text.tobytes()
    assert suffix_array.suffix_array(text).tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])


@pytest.mark.parametrize("letters", [2, 4, 26])
def test_recursion_and_its_end(letters):
    """The same order, wherever the recursion ends; periods and copies make it deep."""
    pick = np.random.default_rng(letters)
    part = pick.integers(0, letters, 700).astype(np.uint8)
    for text in (np.tile(part[:60], 50), np.concatenate([part, part, part[::-1], part]), np.zeros(900, np.uint8), pick.integers(0, letters, 3000).astype(np.uint8)):
        raw = text.tobytes()
        want = sorted(range(len(raw)), key=lambda i: raw[i:])
        assert all(suffix_array.suffix_array(text, base).tolist() == want for base in (0, 5, 100, 1 << 15))


@pytest.mark.parametrize("kind", [np.uint8, np.uint16, np.int32])
def test_order_and_prefixes_of_long_spans(kind):
    """Spans beyond the words that are compared at once, texts that end in zeros, and the highest byte."""
    rise = np.repeat(np.arange(0, 256, 5), 4)
    late = np.concatenate([rise[:-1], [254, 255]])
    for parts in ([rise, late, rise, late[:-3], rise, [0] * 9], [[7] * 150, [3], [7] * 150, [3], [7] * 149, [9], [0]], [[255] * 20, [0] * 20, [255] * 20, [0] * 12], [[0, 0, 255, 255] * 60]):
        text = np.concatenate([np.asarray(x) for x in parts]).astype(kind)
        raw = text.tolist()
        want = sorted(range(len(raw)), key=lambda i: raw[i:])
        assert all(suffix_array.suffix_array(text, base).tolist() == want for base in (0, 1 << 15))
        lcp = suffix_array.common_prefixes(text, np.array(want)).tolist()
        for a, b, n in zip(want, want[1:], lcp[1:], strict=False):
            assert raw[a : a + n] == raw[b : b + n] and raw[a + n : a + n + 1] != raw[b + n : b + n + 1]


def test_short_stretches_take_no_sort_each():
    """Where each entry settles only the next one, stretches are induced without a call of NumPy's sort for each."""
    text = np.concatenate([np.arange(3000, 0, -1), np.arange(1, 3000), np.arange(3000, 0, -1)]).astype(np.int32)
    calls = Counter()
    sys.setprofile(lambda _, event, what: calls.update([getattr(what, "__name__", "")]) if event == "c_call" else None)
    try:
        order = suffix_array.suffix_array(text)
    finally:
        sys.setprofile(None)
    raw = text.tolist()
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    assert calls["argsort"] < 100


def test_groups_of_suffixes():
    pick = np.random.default_rng(1)
    text = pick.integers(0, 4, 5000)
    suffixes, least = np.arange(4990), pick.integers(0, 1000, 5000)
    want = {}
    for i in suffixes:
        key = text[i : i + 6].tobytes()
        want[key] = min(want.get(key, 10**9), least[i])
    for limit in (16, 100000):
        got = suffix_tree.least_ids(text, suffixes, least, 6, limit)
        assert all(got[i] == want[text[i : i + 6].tobytes()] for i in suffixes)
