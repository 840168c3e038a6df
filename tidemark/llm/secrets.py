"""Secret scans: fixed patterns, and a linear-chain conditional random field over the tokens of each line.

The field tags tokens as outside, begin or inside of a secret. Its features: a token's shape (classes of
characters, changes between them, length), the words around it, and features of the whole text (shares of
digits and marks). It is trained on the driver by stochastic gradient on the log-likelihood (forward-backward), on a bounded
sample of texts whose labels are the fixed patterns' spans and generated secrets set into their lines; weights are hashed into
a table of fixed size. Lines are decoded by Viterbi, all lines of a chunk at once.

Spans are in code points, end exclusive. ``base`` spans: kinds assign, access, hex. ``crf`` spans that
touch a base span are dropped. Defined results: null and empty texts have no spans; repeated rows and ids give a row each, ids may be of
any type; of spans that start at the same place the kinds' order counts, and of equally good taggings the one with the lower labels.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._arrow import LOWER, flat, lowest, mix, per_text, prefix_sums, runs, sha256, span_hashes, texts

KINDS = ("assign", "access", "hex", "crf")
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_STEMS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Classes of bytes: 0 space, 1 lower, 2 upper, 3 digit, 4 joiner inside words, 5 other mark, 6 beyond ASCII.
_CLASS = np.full(256, 5, np.uint8)
_CLASS[[9, 11, 12, 13, 32]] = 0
_CLASS[10] = 7  # ends a line
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 6
_CLASS[[ord(c) for c in "+/_.-"]] = 4
_HEX = np.zeros(256, bool)
_HEX[48:58] = _HEX[97:103] = True
#: Hashed features of a token and labels (0 outside, 1 begin, 2 inside).
FEATURES, LABELS = 1 << 14, 3


def base_spans(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text, kind, start, end) in bytes of the whole buffer, by text, start and kind."""
    found = []
    raw = LOWER[data].tobytes()
    near = set()
    for stem in _STEMS:
        at = raw.find(stem)
        while at >= 0:
            doc = int(np.searchsorted(offsets, at, side="right")) - 1
            near.add(doc)
            at = raw.find(stem, max(at + 1, int(offsets[doc + 1]) - len(stem) + 1))
    whole = data.tobytes()
    for doc in near:
        a = int(offsets[doc])
        for m in _ASSIGN.finditer(whole[a : offsets[doc + 1]]):
            if m.end(2) - m.start(2) >= 12:
                found.append((doc, 0, a + m.start(), a + m.end()))
    at = whole.find(b"AKIA")
    while at >= 0:
        doc = int(np.searchsorted(offsets, at, side="right")) - 1
        m = _ACCESS.match(whole, at, int(offsets[doc + 1]))
        if m and m.end() - at >= 18:
            found.append((doc, 1, at, m.end()))
        at = whole.find(b"AKIA", m.end() if m else at + 1)
    mask = _HEX[data]
    a, b = runs(mask)
    for a, b in zip(*(x[b - a >= 16] for x in (a, b)), strict=True):
        cuts = offsets[np.searchsorted(offsets, a, side="right") : np.searchsorted(offsets, b, side="left")]  # texts that begin inside the run
        edges = [int(a), *map(int, np.unique(cuts)), int(b)]
        found += [(int(np.searchsorted(offsets, x, side="right")) - 1, 2, x, y) for x, y in zip(edges, edges[1:], strict=False) if y - x >= 16]
    return sorted(found, key=lambda x: (x[0], x[2], x[1]))


@dataclass
class Tokens:
    starts: np.ndarray
    ends: np.ndarray
    line: np.ndarray  # each line's first token, and the number of tokens
    features: np.ndarray  # tokens x features
    first: np.ndarray  # each text's first token


def tokenize(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    kind = _CLASS[data]
    word = (kind >= 1) & (kind <= 4) | (kind == 6)
    mark = kind == 5
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    begin[inner] = word[inner]
    begin |= mark
    starts = np.flatnonzero(begin)
    # a token ends before the next token, space, line end or text
    last = (word | mark).copy()
    if len(data):
        last[:-1] &= ~(word[1:] & ~begin[1:])
    ends = np.flatnonzero(last) + 1
    n = len(starts)
    first = np.searchsorted(starts, offsets)
    breaks = np.unique(np.concatenate((np.searchsorted(starts, np.flatnonzero(kind == 7)), first)))
    line = np.unique(np.concatenate((breaks[breaks < n], [0, n]))) if n else np.zeros(1, np.int64)
    if not n:
        return Tokens(starts, ends, line, np.zeros((0, 10), np.int32), first)
    sums = [np.concatenate(([0], np.cumsum(kind == c, dtype=np.int32))) for c in (1, 2, 3, 4, 6)]
    count = [s[ends] - s[starts] for s in sums]
    change = np.concatenate(([0, 0], np.cumsum(kind[1:] != kind[:-1], dtype=np.int32)))
    turns = change[ends] - change[starts + 1]
    length = ends - starts
    bucket = np.minimum(length, 8) + np.searchsorted([12, 16, 20, 28, 40, 64], length, side="right")
    mask = sum((c > 0).astype(np.int64) << i for i, c in enumerate(count))
    digits = (4 * count[2] / length).astype(np.int64)
    turns = np.minimum(turns, 12)
    hashed = (span_hashes(prefix_sums(LOWER[data]), starts, ends) >> np.uint64(20)).astype(np.int64)
    place = np.searchsorted(line, np.arange(n), side="right") - 1
    left, right = line[place], line[place + 1]

    def near(values: np.ndarray, by: int) -> np.ndarray:
        at = np.arange(n) + by
        return np.where((at >= left) & (at < right), values[np.clip(at, 0, n - 1)], 1)

    text_of = np.searchsorted(first, np.arange(n), side="right") - 1
    size = np.maximum(np.diff(offsets), 1)
    shares = []
    for c in (3, 5):
        total = np.concatenate(([0], np.cumsum(kind == c, dtype=np.int64)))[offsets]
        shares.append(np.searchsorted([0.002, 0.01, 0.03, 0.1], np.diff(total) / size))
    shape = mask | bucket << 5
    marks = np.where(data[starts] == ord("="), 1, np.where(data[starts] == ord(":"), 2, np.where(mask == 0, 3, 0)))
    raw = [shape, shape << 8 | turns << 3 | digits, np.where(length > 11, 0, hashed), near(hashed, -1), near(hashed, -2), near(hashed, 1), near(marks, -1) << 2 | near(marks, 1) | bucket << 8, near(hashed, -3), shape << 8 | shares[0][text_of] << 4 | shares[1][text_of], near(shape, -1) << 20 | shape]
    columns = [(mix(x.astype(np.uint64) * np.uint64(16) + np.uint64(i)) >> np.uint64(50)).astype(np.int32) % FEATURES for i, x in enumerate(raw)]
    return Tokens(starts, ends, line, np.stack(columns, axis=1), first)


@dataclass
class Field:
    emission: np.ndarray  # features x labels
    transition: np.ndarray  # labels x labels, from row to column
    start: np.ndarray

    def scores(self, tokens: Tokens) -> np.ndarray:
        out = np.zeros((len(tokens.starts), LABELS), np.float32)
        for column in tokens.features.T:
            out += self.emission[column]
        return out


def viterbi(field: Field, tokens: Tokens) -> np.ndarray:
    """The best label of each token, by line.

    A token whose score for outside leads by more than any change of its two transitions can make up is outside
    on every best path; such tokens cut lines into runs, and only these are searched, longest first and side by side.
    """
    score, t = field.scores(tokens), field.transition.astype(np.float32)
    n = len(score)
    swing = max([0.0, *(float(t[a, x] + t[x, b] - t[a, 0] - t[0, b]) for x in (1, 2) for a in range(LABELS) for b in range(LABELS)), *(float(t[a, x] - t[a, 0]) for x in (1, 2) for a in range(LABELS)), *(float(s + t[x, b] - field.start[0] - t[0, b]) for x, s in enumerate(field.start) for b in range(LABELS))])
    open_ = np.flatnonzero(score[:, 0] - np.maximum(score[:, 1], score[:, 2]) <= swing + 1e-3)
    label = np.zeros(n, np.int8)
    if not len(open_):
        return label
    first = np.zeros(n + 1, bool)
    first[tokens.line] = True
    new = np.concatenate(([True], (np.diff(open_) > 1) | first[open_[1:]]))
    at = open_[new]
    size = np.diff(np.append(np.flatnonzero(new), len(open_)))
    order = np.argsort(-size, kind="stable")
    at, size = at[order], size[order]
    active = len(size) - np.searchsorted(size[::-1], np.arange(size[0]), side="right")
    back = np.zeros((n, LABELS), np.int8)
    best = score[at] + np.where(first[at][:, None], field.start, t[0])
    for step in range(1, len(active)):
        m = int(active[step])
        own, old = at[:m] + step, best[:m]
        for to in range(LABELS):
            paths = old + t[:, to]
            back[own, to] = paths.argmax(axis=1)
            if to == 0:
                new_best = np.empty_like(old)
            new_best[:, to] = paths.max(axis=1)
        best[:m] = new_best + score[own]
    best += np.where(first[at + size][:, None], 0.0, t[:, 0])
    now = best.argmax(axis=1)
    for step in range(len(active) - 1, -1, -1):
        own = at[: active[step]] + step
        label[own] = now[: active[step]]
        if step:
            now[: active[step]] = back[own, now[: active[step]]]
    return label


def train(tokens: Tokens, labels: np.ndarray, epochs: int = 12, rate: float = 0.3, l2: float = 1e-4, max_tokens: int = 400) -> Field:
    """AdaGrad on the negative log-likelihood, in batches of lines; gradients by forward-backward."""
    field = Field(np.zeros((FEATURES, LABELS), np.float64), np.zeros((LABELS, LABELS)), np.zeros(LABELS))
    params = (field.emission, field.transition, field.start)
    squares = [np.full_like(p, 1e-2) for p in params]
    # every line with a secret and as many of the others, none of over max_tokens
    size, some = np.diff(tokens.line), np.add.reduceat(labels, tokens.line[:-1]) > 0
    other = np.flatnonzero(~some & (size <= max_tokens))
    lines = np.concatenate((np.flatnonzero(some & (size <= max_tokens)), other[:: max(1, len(other) // max(1, 6 * int(some.sum())))]))
    pick = np.random.default_rng(7)
    for _ in range(epochs):
        pick.shuffle(lines)
        for some in np.array_split(lines, max(1, len(lines) // 256)):
            grads = _gradient(field, tokens, labels, some)
            for p, s, g in zip(params, squares, grads, strict=True):
                g = g / max(1, len(some)) + l2 * p
                s += g * g
                p -= rate * g / np.sqrt(s)
    field.emission = field.emission.astype(np.float32)
    return field


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _gradient(field, tokens, labels, some):
    size = np.diff(tokens.line)[some]
    some, size = some[np.argsort(-size, kind="stable")], np.sort(size)[::-1]
    at = tokens.line[:-1][some]
    index = np.concatenate([np.arange(a, a + s) for a, s in zip(at, size, strict=True)])
    own = np.concatenate(([0], np.cumsum(size)))[:-1]
    emit = field.emission[tokens.features[index]].sum(axis=1)
    y = labels[index]
    forward, backward = np.zeros_like(emit), np.zeros_like(emit)
    active = [int((size > t).sum()) for t in range(int(size[0]))]
    for t, m in enumerate(active):
        i = own[:m] + t
        forward[i] = emit[i] + (field.start if t == 0 else _logsum(forward[i - 1][:, :, None] + field.transition, 1))
    total = _logsum(forward[own + size - 1], 1)
    pair = np.zeros((LABELS, LABELS))
    for t in range(len(active) - 1, 0, -1):
        i = own[: active[t]] + t
        after = emit[i] + backward[i]
        edge = forward[i - 1][:, :, None] + field.transition + after[:, None, :] - total[: active[t], None, None]
        pair += np.exp(edge).sum(axis=0)
        np.subtract.at(pair, (y[i - 1], y[i]), 1)
        backward[i - 1] = _logsum(field.transition[None] + after[:, None, :], 2)
    node = np.exp(forward + backward - np.repeat(total, size)[:, None])
    node[np.arange(len(y)), y] -= 1
    features, width = tokens.features[index].ravel(), tokens.features.shape[1]
    grad = np.stack([np.bincount(features, np.repeat(node[:, c], width), FEATURES) for c in range(LABELS)], axis=1)
    return grad, pair, node[own].sum(axis=0)


def _generated(rng: random.Random) -> str:
    """A made-up secret."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    kind = rng.randrange(4)
    if kind == 0:
        return "".join(rng.choice(letters) for _ in range(rng.randrange(20, 44)))
    if kind == 1:
        return rng.choice(["ghp_", "sk-", "xoxb-", "pk_live_", "glpat-"]) + "".join(rng.choice(letters) for _ in range(rng.randrange(16, 36)))
    if kind == 2:
        return "".join(rng.choice(letters + "+/") for _ in range(rng.randrange(24, 60)))
    return ".".join("".join(rng.choice(letters + "_-") for _ in range(rng.randrange(12, 30))) for _ in range(3))


def examples(values: list[str], seed: int = 5) -> tuple[list[str], list[list[tuple[int, int]]]]:
    """Texts, a third of them with generated secrets set in, and the secrets' byte spans."""
    rng, out, spans = random.Random(seed), [], []
    for k, value in enumerate(values):
        lines, made = value.split("\n"), []
        if k % 3 == 0:
            for _ in range(rng.randrange(1, 4)):
                name = rng.choice(["key", "auth", "credential", "private_key", "bearer", "access", "token", "secret", "pwd", ""])
                joint = rng.choice([" = ", ": ", "=", ' = "', " "]) if name else ""
                secret = _generated(rng)
                words = lines[(at := rng.randrange(len(lines)))].split(" ")
                words.insert(rng.randrange(len(words) + 1), name + joint + secret + ('"' if '"' in joint else ""))
                lines[at] = " ".join(words)
                made.append(secret)
        value = "\n".join(lines)
        raw = value.encode()
        own = []
        for secret in made:
            i = raw.find(secret.encode())
            own.append((i, i + len(secret)))
        for _, kind, a, b in base_spans(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])):
            if kind == 0:  # the value alone, not its name
                a = a + _ASSIGN.match(raw[a:b]).start(2)
            own.append((a, b))
        out.append(value)
        spans.append(own)
    return out, spans


def learn(docs: DataFrame, max_rows: int = 300, max_chars: int = 8_000, max_tokens: int = 400, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """A field trained on at most max_rows texts of at most max_chars characters, those with the lowest hashes, and of them on lines
    of at most max_tokens tokens. These bounds are of training alone; scans read whole texts and lines."""
    rows = texts(docs, id_col, text_col)
    short = rows.where(F.col("text").isNotNull() & (F.length("text") <= max_chars))
    rows = lowest(short, rows.select("doc_id").count(), max_rows, "doc_id", "text")
    return fit([r.text for r in rows], max_tokens)


def fit(values: list[str], max_tokens: int = 400) -> Field:
    values, spans = examples(values)
    column = pa.array(values, pa.string())
    data, offsets = flat(column)
    tokens = tokenize(data, offsets)
    labels = np.zeros(len(tokens.starts), np.int8)
    for i, own in enumerate(spans):
        for a, b in own:
            x, y = np.searchsorted(tokens.ends, offsets[i] + a, side="right"), np.searchsorted(tokens.starts, offsets[i] + b)
            labels[x:y] = 2
            labels[x : x + 1] = 1
    if not len(labels):
        return Field(np.zeros((FEATURES, LABELS), np.float32), np.zeros((LABELS, LABELS)), np.array([1.0, 0, 0]))
    return train(tokens, labels, max_tokens=max_tokens)


def spans_of(data: np.ndarray, offsets: np.ndarray, field: Field) -> list[list[tuple[int, int, int]]]:
    """(kind, start, end) in code points of each text, by start and kind."""
    base = base_spans(data, offsets)
    tokens = tokenize(data, offsets)
    found = []
    if len(tokens.starts):
        label = viterbi(field, tokens)
        inside = label > 0
        begins = np.flatnonzero(inside & ((label == 1) | ~np.concatenate(([False], inside[:-1])) | np.isin(np.arange(len(label)), tokens.line)))
        taken = np.zeros(len(data) + 1, np.int32)
        for _, _, a, b in base:
            taken[a:b] = 1
        taken = np.concatenate(([0], np.cumsum(taken)))
        limit = np.append(begins[1:], len(label))[: len(begins)]
        outside = np.flatnonzero(~inside)
        for i, j in zip(begins, limit, strict=True):
            k = int(np.searchsorted(outside, i))
            stop = min(int(j), int(outside[k]) if k < len(outside) else len(label))
            a, b = int(tokens.starts[i]), int(tokens.ends[stop - 1])
            if taken[b] == taken[a]:
                found.append((int(np.searchsorted(tokens.first, i, side="right")) - 1, 3, a, b))
    out: list[list] = [[] for _ in range(len(offsets) - 1)]
    if base or found:
        points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        for doc, kind, a, b in sorted(base + found, key=lambda x: (x[0], x[2], x[1])):
            zero = points[offsets[doc]]
            out[doc].append((kind, int(points[a] - zero), int(points[b] - zero)))
    return out


def scan(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_crf of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def work(part: pa.RecordBatch) -> list:
        listed = spans_of(*flat(part.column("text")), shared.value)
        said = [[(k, f"{KINDS[k]}:{a}:{b}") for k, a, b in own] for own in listed]
        count = [[sum(k == kind for k, _ in own) for own in said] for kind in range(4)]
        return [
            *(pa.array(c, pa.int64()) for c in count[:3]), pa.array([sha256(",".join(x for k, x in own if k < 3).encode()) for own in said], pa.string()),
            pa.array([",".join(x for _, x in own) for own in said], pa.string()), pa.array(count[3], pa.int64()),
        ]

    return per_text(texts(docs, id_col, text_col), "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_crf bigint", work, limit=1 << 19)
