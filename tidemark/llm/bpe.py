"""Byte-pair encoding and decoding by a table of distinct words.

Texts are cut before every single space that stands between two characters that aren't white space, where the
pre-tokenizer starts a word whatever stands around. Chunks of texts tell their distinct words, each with its place among them, in one parcel for each bucket
of words (by hash). A bucket's words meet in one task, which encodes each distinct one once and sends the ids back, a parcel for each
chunk, where they meet the chunk's texts. Arrow's dictionary encoding gives every occurrence's place in its chunk's distinct words, by which
ids are joined to positions. Decoding joins ids with the table of their byte pieces.
A text in which some cut isn't safe (white space beside a space, or an added token's string) is encoded whole.

A chunk is named by a 128-bit hash of its texts, so ids never reach other words, even if a lost task is run again with other chunks;
words whose ids don't come are encoded where they occur. So texts should come from a table, whose order is fixed; after a shuffle the two
passes over them may see other chunks, which costs time but changes no result.

Defined results: null and empty texts have no ids and decode to the empty text; repeated rows and ids
give a row each.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._arrow import bounded, flat, lean, sha256, texts, word_hashes

#: Bytes of a chunk; words that a bucket's task remembers: a bucket with more encodes some again; buckets at most; level of
#: compression.
CHUNK, REMEMBERED, BUCKETS, LEVEL = 8 << 20, 1 << 18, 2048, 5
#: Ids that are joined to positions, hashed and decoded at once.
PART = 1 << 18
_MODELS: dict[str, tuple] = {}
#: White space of the pre-tokenizer's pattern, at either end of a word.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, as characters from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in set(plain))}


def _model(path: str):
    if path not in _MODELS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        with open(path, encoding="utf-8") as f:
            added = [x["content"] for x in json.load(f).get("added_tokens", [])]
        table, pieces = _byte_of(), []
        for i in range(model.get_vocab_size(with_added_tokens=True)):
            piece = model.id_to_token(i) or ""
            pieces.append(bytes(table[c] for c in piece) if piece not in added and all(c in table for c in piece) else piece.encode())
        _MODELS[path] = model, added, pa.array(pieces, pa.large_binary())
    return _MODELS[path]


def _ids(model, words: list[str]) -> list[bytes]:
    """Ids of words, as little-endian 32-bit integers."""
    out: list[bytes] = []
    for at in range(0, len(words), 4096):
        out += [array("I", e.ids).tobytes() for e in model.encode_batch_fast(words[at : at + 4096], add_special_tokens=False)]
    return out


def _unsafe(word: str) -> bool:
    return not word or word.strip(_SPACE) != word


@dataclass
class Cut:
    """A chunk's texts, cut: its distinct words (spaces before them included), and what stands where."""

    words: pa.Array
    code: np.ndarray  # of each occurrence, in order, the word
    text: np.ndarray  # and the text that it is in
    whole: np.ndarray  # texts that are encoded whole
    n: int


def cut(path: str, column: pa.Array) -> Cut:
    added = _model(path)[1]
    column = pc.fill_null(column, "")
    n = len(column)
    odd = pc.equal(column, "")
    for x in added:
        odd = pc.or_(odd, pc.match_substring(column, x))
    split = pc.split_pattern(column, " ")
    flat_words, at = split.flatten(), split.offsets.to_numpy().astype(np.int64)
    at = at - at[0]
    # the first word of a text has no space before it
    lead = np.zeros(len(flat_words), bool)
    lead[at[:-1]] = True
    plain = flat_words.dictionary_encode()
    bad = np.fromiter(map(_unsafe, plain.dictionary.to_pylist()), bool, len(plain.dictionary))
    index = plain.indices.to_numpy()
    odd = odd.to_numpy(zero_copy_only=False) | (np.logical_or.reduceat(bad[index], at[:-1]) if n else np.zeros(0, bool))
    per_word = np.diff(at)
    skip = np.repeat(odd, per_word)
    size = len(plain.dictionary)
    code = np.where(lead, index + size, index)[~skip]  # of the distinct words, and of those without a space before them
    seen = np.zeros(2 * size, bool)
    seen[code] = True
    used = np.flatnonzero(seen)
    listed = plain.dictionary.cast(pa.string())
    spaced, first = listed.take(pa.array(used[used < size])), listed.take(pa.array(used[used >= size] - size))
    words = pa.concat_arrays([pc.binary_join_element_wise(pa.scalar(" "), spaced, ""), first])
    place = (np.cumsum(seen) - 1).astype(np.int32)
    return Cut(words, place[code], np.repeat(np.arange(n, dtype=np.int32), per_word)[~skip], np.flatnonzero(odd), n)


def encode_chunk(path: str, column: pa.Array, places: np.ndarray | None = None, known: pa.Array | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of the texts of a column, in order; known: ids (little-endian, 32 bits) of the words at some places, each once."""
    parts = [(ids, offsets) for _, _, ids, offsets in encode_parts(path, column, places, known)]
    sizes = [np.diff(offsets) for _, offsets in parts]
    return np.concatenate([ids for ids, _ in parts] or [np.zeros(0, "<u4")]), np.concatenate(([0], np.cumsum(np.concatenate(sizes or [np.zeros(0, np.int64)]))))


def encode_parts(path: str, column: pa.Array, places: np.ndarray | None = None, known: pa.Array | None = None):
    """As encode_chunk(), in parts of about PART ids: (a, b, ids, offsets) of the texts a .. b - 1."""
    own, model = cut(path, column), _model(path)[0]
    size = len(own.words)
    given = np.zeros(size, np.int64)
    have = np.zeros(size, bool)
    if places is not None and len(places):
        have[places] = True
        given[places] = np.arange(len(places))
    missing = np.flatnonzero(~have)
    table = _ids(model, own.words.take(pa.array(missing)).to_pylist())
    table += [array("I", e.ids).tobytes() for i in own.whole for e in [model.encode(column[int(i)].as_py() or "", add_special_tokens=False)]]
    data, cuts = flat(known) if known is not None else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
    own_cuts = np.concatenate(([0], np.cumsum(np.fromiter(map(len, table), np.int64, len(table)))))
    # the pool: ids that came, then those of words and texts that are encoded here
    pool = np.concatenate((data, np.frombuffer(b"".join(table), np.uint8))).view("<u4")
    begins, lengths = (np.zeros(size + len(own.whole), np.int64) for _ in range(2))
    here = np.concatenate((missing, size + np.arange(len(own.whole))))
    begins[here], lengths[here] = (own_cuts[:-1] + len(data)) // 4, np.diff(own_cuts) // 4
    there = np.flatnonzero(have)
    begins[there], lengths[there] = cuts[given[there]] // 4, (cuts[given[there] + 1] - cuts[given[there]]) // 4
    # one entry for each word, or for each text encoded whole, in order of the texts
    entry, text = own.code, own.text
    if len(own.whole):
        entry, text = np.concatenate((entry, size + np.arange(len(own.whole)))), np.concatenate((text, own.whole))
        order = np.argsort(text, kind="stable")
        entry, text = entry[order], text[order]
    per_text = np.bincount(text, lengths[entry], own.n).astype(np.int64)
    first, total = np.searchsorted(text, np.arange(own.n + 1)), np.concatenate(([0], np.cumsum(per_text)))
    a = 0
    while a < own.n:
        b = max(a + 1, int(np.searchsorted(total, total[a] + PART, side="right")) - 1)
        some = entry[first[a] : first[b]]
        take = lengths[some]
        # the join by position: each entry's ids stand in the pool from begins[entry]
        at = np.repeat(begins[some] - (np.cumsum(take) - take), take)
        at += np.arange(len(at))
        yield a, b, pool[at], total[a : b + 1] - total[a]
        a = b


def _name(column: pa.Array) -> bytes:
    data, offsets = flat(column)
    told = xxhash.xxh3_128(offsets.tobytes())
    told.update(np.ascontiguousarray(data))
    return told.digest()


def _chunks(batches):
    """The rows in pieces of about CHUNK bytes of text, whatever batches they come in; a longer text is one of its own."""
    held: list[pa.RecordBatch] = []
    room = CHUNK
    for batch in batches:
        sizes, at = np.diff(flat(batch.column("text"))[1]), 0
        while at < len(batch):
            ends = np.cumsum(sizes[at:])
            take = int(np.searchsorted(ends, room, side="right"))
            if not take and held:
                yield pa.concat_batches(held)
                held, room = [], CHUNK
                continue
            take = max(take, 1)
            held.append(batch.slice(at, take))
            room -= int(ends[take - 1])
            at += take
    if held:
        yield pa.concat_batches(held)


def _planes(values: np.ndarray) -> bytes:
    """32-bit numbers as their first bytes, then their second ones and so on: small numbers leave planes of zeros."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _numbers(raw: bytes, n: int, at: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n).T).view("<u4").ravel()


def _parcel(places: np.ndarray, values: pa.Array, numbers: bool = False) -> bytes:
    """Ascending places and the bytes that belong to them, compressed; numbers: the bytes are 32-bit numbers."""
    data, ends = flat(values)
    body = np.uint32(len(places)).tobytes() + _planes(np.diff(places, prepend=0)) + _planes(np.diff(ends)) + (_planes(data.view("<u4")) if numbers else data.tobytes())
    return zstandard.compress(body, LEVEL)


def _opened(parcel: bytes, numbers: bool = False) -> tuple[np.ndarray, np.ndarray, bytes]:
    """(places, edges, data) of a parcel."""
    raw = zstandard.decompress(parcel)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    places, size = np.cumsum(_numbers(raw, n, 4), dtype=np.int64), _numbers(raw, n, 4 + 4 * n)
    data = raw[4 + 8 * n :]
    return places, np.concatenate(([0], np.cumsum(size, dtype=np.int64))), _numbers(data, len(data) // 4, 0).tobytes() if numbers else data


def _joined(held: list[tuple]) -> tuple[np.ndarray, pa.Array]:
    """(places, values) of opened parcels together."""
    if not held:
        return np.zeros(0, np.int64), pa.array([], pa.binary())
    sizes = np.concatenate([np.diff(x[1]) for x in held])
    edges = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return np.concatenate([x[0] for x in held]), pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(edges), pa.py_buffer(b"".join(x[2] for x in held))])


def word_ids(rows: DataFrame, path: str) -> DataFrame:
    """(chunk, data): parcels of the ids of each chunk's words, by place."""
    # more of them would leave a few words to a parcel
    buckets = min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), BUCKETS)

    def tell(batches):
        for part in _chunks(batches):
            words, name = cut(path, part.column("text")).words, _name(part.column("text"))
            data, ends = flat(words)
            bucket = (word_hashes(data, ends[:-1], ends[1:]) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(edges))
            parcels = [_parcel(order[a:b], words.take(pa.array(order[a:b]))) for a, b in zip(edges[full].tolist(), edges[full + 1].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array([name] * len(full), pa.binary()), pa.array(parcels, pa.binary())], names=["bucket", "chunk", "data"])

    def encode(batches):
        model, known = _model(path)[0], {}
        for batch in batches:
            out = []
            for parcel in batch.column("data").to_pylist():
                places, edges, data = _opened(parcel)
                words = [data[a:b] for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False)]
                missing = [w for w in words if w not in known]
                if len(known) + len(missing) > REMEMBERED:
                    known, missing = {}, words
                known.update(zip(missing, _ids(model, [w.decode() for w in missing]), strict=True))
                out.append(_parcel(places, pa.array([known[w] for w in words], pa.binary()), numbers=True))
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), pa.array(out, pa.binary())], names=["chunk", "data"])

    # a bucket gets a parcel from each chunk, however common its words are
    told = rows.mapInArrow(lean(tell), "bucket int, chunk binary, data binary").repartition(buckets, "bucket")
    return told.mapInArrow(lean(encode), "chunk binary, data binary")


def _texts(rows: DataFrame) -> DataFrame:
    """(chunk, kind, data): the chunks themselves, compressed."""

    def pack(batches):
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=LEVEL))
        for part in _chunks(batches):
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, part.schema, options=options) as stream:
                stream.write_batch(part)
            yield pa.RecordBatch.from_arrays([pa.array([_name(part.column("text"))], pa.binary()), pa.array([1], pa.int32()), pa.array([out.getvalue().to_pybytes()], pa.binary())], names=["chunk", "kind", "data"])

    return rows.mapInArrow(lean(pack), "chunk binary, kind int, data binary")


def _encoded(rows: DataFrame, path: str, fields: str, work: Callable[[np.ndarray, np.ndarray], list]) -> DataFrame:
    """doc_id and what work makes of each chunk's ids and offsets."""
    words = word_ids(rows, path).select("chunk", F.lit(0).alias("kind"), "data")

    names = ["doc_id", *(x.strip().split(" ")[0] for x in fields.split(","))]

    def meet(batches):
        key, held, ready = None, [], None
        for batch in batches:
            for own, kind, data in zip(batch.column("chunk").to_pylist(), batch.column("kind").to_pylist(), batch.column("data"), strict=True):
                if own != key:
                    key, held, ready = own, [], None
                if kind == 0:
                    held.append(_opened(data.as_py(), numbers=True))
                    continue
                if ready is None:
                    # equal chunks tell their words twice
                    place, ids = _joined(held)
                    place, first = np.unique(place, return_index=True)
                    ready, held = (place, ids.take(pa.array(first))), []
                with pa.ipc.open_stream(data.as_buffer()) as stream:
                    for part in stream:
                        for a, b, ids, offsets in encode_parts(path, part.column("text"), *ready):
                            yield pa.RecordBatch.from_arrays([part.column("doc_id").slice(a, b - a), *work(ids, offsets)], names=names)

    both = words.unionByName(_texts(rows))
    # a chunk is of bounded size, so no task gets more than its share
    return both.repartition("chunk").sortWithinPartitions("chunk", "kind").mapInArrow(lean(meet), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {fields}")


def decode_chunk(path: str, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """UTF-8 of what each run of ids decodes to; broken sequences become U+FFFD."""
    pieces = _model(path)[2].take(pa.array(ids.astype(np.int64)))
    data, ends = flat(pieces)
    data, cut = memoryview(data), ends[offsets]
    out = []
    for a, b in zip(cut, cut[1:], strict=False):
        raw = bytes(data[a:b])
        try:
            raw.decode()
        except UnicodeDecodeError:
            raw = raw.decode("utf-8", "replace").encode()
        out.append(raw)
    return out


def _ids_column(ids: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every whole text."""
    return _encoded(texts(docs, id_col, text_col), model_path, "ids array<int>", lambda ids, offsets: [_ids_column(ids, offsets)])


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text of arrays of ids; a null array is an empty text."""
    bounded(encoded.sparkSession)
    rows = encoded.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{ids_col}`"), F.array().cast("array<int>")).alias("ids"))

    def run(batches):
        for batch in batches:
            column = batch.column("ids")
            ids = column.flatten().to_numpy(zero_copy_only=False)
            offsets = np.concatenate(([0], np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x.decode() for x in decode_chunk(model_path, ids, offsets)], pa.string())], names=["doc_id", "text"])

    return rows.mapInArrow(lean(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")


def digest(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids (little-endian, 32 bits) and of the decoded text; with_ids: the ids too."""

    def work(ids: np.ndarray, offsets: np.ndarray) -> list:
        raw = memoryview(np.ascontiguousarray(ids.astype("<u4")).view(np.uint8))
        shas = [sha256(raw[4 * a : 4 * b]) for a, b in zip(offsets, offsets[1:], strict=False)]
        out = [pa.array(np.diff(offsets)), pa.array(shas, pa.string()), pa.array([sha256(x) for x in decode_chunk(model_path, ids, offsets)], pa.string())]
        return [*out, _ids_column(ids, offsets)] if with_ids else out

    return _encoded(texts(docs, id_col, text_col), model_path, "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids, work)
