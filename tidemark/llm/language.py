"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies of the hashed n-grams are counted over all labelled rows that aren't held out. The weights are learned on the driver
from at most ``max_rows`` of them (the documented bound of the sample; those whose ids hash lowest), by follow-the-regularised-leader with elastic-net penalties, and its scores are
calibrated by a temperature fitted on a fifth of that sample. N-grams are hashed into a fixed number of
features, so the model's size is fixed by its parameters and the number of languages in the sample. Prediction
reads whole texts in Arrow batches; it sees nothing but the text.

Defined results: a text that is null or has no letter is ``und`` with score 0; so is every text if
there was no labelled row to learn from. A null id is never held out and never learned from. Ties between languages go
to the one first in alphabetical order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._arrow import bounded, chunks, give_back, lean, lowest, mix, per_text, texts

#: N-gram sizes and the number of hashed features.
SIZES, FEATURES = (1, 2, 3), 1 << 17
#: Relative frequencies are small; this brings features to about 1.
SCALE = 20.0
#: Characters that learning looks at in one go; a longer text is looked at alone.
SLICE = 1 << 18
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def grams(values: list[str | None]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """For each size (features, each text's first), then the number of n-grams and whether there is a letter."""
    low = [(v or "").lower() for v in values]
    sizes = np.fromiter(map(len, low), np.int64, len(low))
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), "<u4")
    letter = letters()[code]
    code = np.where(letter, code, 32).astype(np.uint64)
    ends = np.cumsum(sizes)
    has = np.diff(np.concatenate(([0], np.cumsum(letter)))[np.concatenate(([0], ends))]) > 0
    out, total, running = [], np.zeros(len(low), np.int64), code
    for n in range(1, max(SIZES) + 1):
        if n > 1:
            running = running[:-1] * np.uint64(0x9E3779B97F4A7C15) + code[n - 1 :] if len(running) else running
        if n not in SIZES:
            continue
        feature = (mix(running + np.uint64(n)) >> np.uint64(40)).astype(np.int64) % FEATURES
        # the last n - 1 characters of a text begin no n-gram of it
        counts = np.maximum(sizes - n + 1, 0)
        skip = np.zeros(len(code) + 1, np.int8)
        first_bad = ends - np.minimum(sizes, n - 1)
        np.add.at(skip, first_bad, 1)
        np.add.at(skip, ends, -1)
        feature = feature[np.cumsum(skip[: len(feature)]) == 0] if n > 1 else feature
        out.append((feature, np.concatenate(([0], np.cumsum(counts)))))
        total += counts
    return out, total, has


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # features x languages, idf included
    bias: np.ndarray
    temperature: float

    def logits(self, values: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        parts, total, has = grams(values)
        z = np.zeros((len(values), len(self.languages)))
        for feature, first in parts:
            full = np.flatnonzero(np.diff(first))
            if len(full):
                z[full] += np.add.reduceat(self.weights[feature], first[full], axis=0)
        return z * (SCALE / np.maximum(total, 1))[:, None] + self.bias, has

    def predict(self, values: list[str | None]) -> tuple[list[str], np.ndarray]:
        z, has = self.logits(values)
        p = softmax(z / self.temperature)
        best = p.argmax(axis=1)
        return [self.languages[b] if h else "und" for b, h in zip(best, has, strict=True)], np.where(has, p[np.arange(len(best)), best], 0.0)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def slices(values: list[str]) -> Iterator[list[str]]:
    """The same texts in lists of at most SLICE characters, or of one text."""
    some, size = [], 0
    for v in values:
        if some and size + len(v) > SLICE:
            yield some
            some, size = [], 0
        some.append(v)
        size += len(v)
    if some:
        yield some


def fit(rows: list[tuple[str, str]], epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.002, l2: float = 0.01, counted: tuple[np.ndarray, int] | None = None) -> Model | None:
    """rows: (text, language), in a fixed order; every fifth calibrates. counted: documents with each feature, and documents (without: of the rows)."""
    languages = sorted({x[1] for x in rows})
    if not languages:
        return None
    target = np.array([languages.index(x[1]) for x in rows])
    docs = []  # each text's features, how often it has them, and its n-grams
    df = np.zeros(FEATURES)
    for some in slices([x[0] for x in rows]):
        parts, total, _ = grams(some)
        for i in range(len(some)):
            feature, count = np.unique(np.concatenate([f[a[i] : a[i + 1]] for f, a in parts]), return_counts=True)
            df[feature] += 1
            docs.append((feature.astype(np.int32), count.astype(np.int32), max(1, total[i])))
    df, total_rows = counted or (df, len(rows))
    idf = np.log((1 + total_rows) / (1 + df)) + 1
    k = len(languages)
    z, n = np.zeros((FEATURES, k)), np.zeros((FEATURES, k))
    zb, nb = np.zeros(k), np.zeros(k)

    def weight(z, n, l1):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    held = np.arange(len(rows)) % 5 == 4 if len(rows) >= 25 else np.zeros(len(rows), bool)
    for _ in range(epochs):
        for i in np.flatnonzero(~held):
            feature, count, grams_of_it = docs[i]
            x = (count / grams_of_it * SCALE * idf[feature])[:, None]
            w, b = weight(z[feature], n[feature], l1), weight(zb, nb, 0.0)
            logit = (x * w).sum(axis=0) + b
            g = softmax(logit[None])[0]
            g[target[i]] -= 1
            for zz, nn, ww, gg, at in ((z, n, w, x * g, feature), (zb, nb, b, g, slice(None))):
                grown = nn[at] + gg * gg
                zz[at] += gg - (np.sqrt(grown) - np.sqrt(nn[at])) / alpha * ww
                nn[at] = grown
    model = Model(languages, (weight(z, n, l1) * idf[:, None]).astype(np.float32), weight(zb, nb, 0.0), 1.0)
    check = np.flatnonzero(held) if held.any() else np.arange(len(rows))
    logits, truth = np.concatenate([model.logits(some)[0] for some in slices([rows[i][0] for i in check])]), target[check]

    def loss(t):
        return -np.log(np.maximum(softmax(logits / t)[np.arange(len(truth)), truth], 1e-12)).mean()

    model.temperature = float(min(np.geomspace(0.05, 20, 121), key=loss))
    return model


def held_out(doc_id: Column) -> Column:
    """The rows kept out of learning: crc32 of the id as text is 2 modulo 4; a null id isn't."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, max_rows: int = 2000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """A model of at most max_rows labelled rows that aren't held out, those with the lowest hashes."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    bounded(rows.sparkSession)
    rows = rows.where(F.col("text").isNotNull())
    counted = document_frequencies(rows)
    some = lowest(rows, counted[1], max_rows, "doc_id", "text", "lang")
    model = fit([(r.text, r.lang) for r in some], counted=counted)
    give_back()
    return model


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """How many of the texts have each feature, and how many there are; FEATURES + 1 numbers reach the driver."""

    def count(batches):
        total = np.zeros(FEATURES + 1, np.int64)
        for part in chunks(batches, limit=1 << 18):
            own, _, _ = grams(part.column("text").to_pylist())
            n = len(part)
            key = np.concatenate([np.repeat(np.arange(n), np.diff(first)) * FEATURES + feature for feature, first in own])
            key.sort()
            key = key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key
            total[:FEATURES] += np.bincount(key % FEATURES, minlength=FEATURES)
            total[FEATURES] += n
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(total[full])], names=["feature", "n"])

    out = np.zeros(FEATURES + 1, np.int64)
    for r in rows.select("text").mapInArrow(lean(count), "feature int, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r.feature] = r.n
    return out[:FEATURES].astype(float), int(out[FEATURES])


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred and score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(part: pa.RecordBatch) -> list:
        values = part.column("text").to_pylist()
        names, score = shared.value.predict(values) if shared.value else (["und"] * len(values), np.zeros(len(values)))
        return [pa.array(names, pa.string()), pa.array(score)]

    out = per_text(texts(docs, id_col, text_col), "lang_pred string, score double", work, limit=1 << 18)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep(docs: DataFrame, model: Model | None, min_score: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns as they are, whose language is known with at least min_score."""
    shared = bounded(docs.sparkSession).sparkContext.broadcast(model)

    def run(batches):
        for part in chunks(batches, text_col, 1 << 18):
            names, score = shared.value.predict(part.column(text_col).to_pylist()) if shared.value else (["und"] * len(part), np.zeros(len(part)))
            yield part.filter(pa.array(np.array([x != "und" for x in names], bool) & (score >= min_score)))

    return docs.mapInArrow(lean(run), docs.schema)
