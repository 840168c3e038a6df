"""Token counts: texts are encoded in Arrow batches and only lengths come back.

A chunk of texts (balanced by bytes) is cut where no piece of the vocabulary can cross: before a
single space after another character, since no piece holds a word-start mark behind anything but
such marks. Segments are gathered by Arrow's dictionary encoding, each distinct one is encoded
once, in one batch, and the lengths are summed by text. A text where that cut isn't provably safe
(double, leading or trailing spaces, the mark itself) is cut between a non-space and a run of
spaces, or encoded whole if it holds the mark.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows and ids give a row each.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ._arrow import flat, per_text, texts

#: Segments whose lengths a worker remembers from one batch to the next.
REMEMBERED = 200_000
_MODELS: dict[str, tuple] = {}
_CUT = re.compile(r"(?<=[^ ])(?= )")


def _model(path: str):
    if path not in _MODELS:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (model.id_to_piece(i) for i in range(model.vocab_size()))
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece crosses a word start; texts can't be cut at spaces")
        _MODELS[path] = model, {}
    return _MODELS[path]


def _lengths(path: str, segments: list[str]) -> np.ndarray:
    """Tokens of each segment, as what follows a word start."""
    model, known = _model(path)
    missing = [s for s in segments if s not in known]
    if len(known) + len(missing) > REMEMBERED:
        known.clear()
        missing = segments
    found = dict(zip(missing, map(len, model.encode(missing, num_threads=1)), strict=True)) if missing else {}
    found[""] = len(model.encode("a ")) - len(model.encode("a"))  # a space alone
    if len(found) <= REMEMBERED:
        known.update(found)
    return np.fromiter((found[s] if s in found else known[s] for s in segments), np.int64, len(segments))


def _odd(path: str, text: str) -> int:
    """Any text: cut between a non-space and the spaces after it."""
    model, _ = _model(path)
    if "▁" in text:
        return len(model.encode(text, num_threads=1))
    if not text:
        return 0
    first, *rest = _CUT.split(text)
    return len(model.encode(first, num_threads=1)) + int(_lengths(path, [s[1:] for s in rest]).sum())


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every whole text; model_path: a sentencepiece model."""

    def work(part: pa.RecordBatch) -> list:
        column = part.column("text")
        sizes = np.diff(flat(column)[1])
        column = pc.fill_null(column, "")
        odd = pc.or_(pc.or_(pc.match_substring(column, "  "), pc.match_substring(column, "▁")), pc.or_(pc.starts_with(column, " "), pc.ends_with(column, " ")))
        odd = odd.to_numpy(zero_copy_only=False) | (sizes == 0)
        split = pc.split_pattern(column.filter(pa.array(~odd)), " ")
        table = split.flatten().dictionary_encode()
        lengths = _lengths(model_path, table.dictionary.to_pylist()) if len(table) else np.zeros(0, np.int64)
        tokens = np.zeros(len(sizes), np.int64)
        if len(split):
            tokens[~odd] = np.add.reduceat(lengths[table.indices.to_numpy()], split.offsets.to_numpy()[:-1] - split.offsets.to_numpy()[0])
        for i in np.flatnonzero(odd):
            tokens[i] = _odd(model_path, column[int(i)].as_py())
        return [pa.array(sizes), pa.array(tokens), pa.array(tokens > limit)]

    return per_text(texts(docs, id_col, text_col), "n_bytes bigint, n_tokens bigint, over_limit boolean", work, limit=8 << 20)
