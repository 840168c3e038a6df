"""Arrow plumbing shared by the corpus operators: texts as flat byte buffers.

Every operator here reads only an id column and a text column of its input, under fixed
internal names, so further columns (of whatever name) never clash with what it adds.
A null text is the empty text.
"""

from __future__ import annotations

import ctypes
import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a worker looks at in one go; a longer text is a chunk of its own.
CHUNK_BYTES = 2 << 20

#: Bytes of an Arrow batch on its way to a worker, so that memory doesn't depend on the length of texts.
BATCH_BYTES = 4 << 20

#: Odd multiplier of the 64-bit polynomial hashes, and its inverse modulo 2**64. Such hashes only group; what decides a
#: result is compared itself or by the hashes below.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices balanced by bytes of text."""
    for batch in batches:
        sizes = np.diff(flat(batch.column(text))[1])
        at = 0
        while at < len(sizes):
            ends = np.cumsum(sizes[at : at + 65536])
            take = max(1, int(np.searchsorted(ends, limit, side="right")))
            yield batch.slice(at, take)
            at += take


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text) of a table, under these names."""
    bounded(df.sparkSession)
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def lowest(rows: DataFrame, total: int, max_rows: int, *keys: str) -> list:
    """About max_rows of some total rows, at most: those whose hashed keys are lowest, in that order.

    Rows beyond a cutoff, which leaves half as many again as wanted, never leave their tasks.
    """
    share = min(1.0, (1.5 * max_rows + 200) / max(1, total))
    rank = F.xxhash64(*keys)
    return rows.where(rank <= min((1 << 63) - 1, -(1 << 63) + int(share * (1 << 64)))).orderBy(rank, *keys).limit(max_rows).collect()


def bounded(spark: SparkSession) -> SparkSession:
    """The session, with Arrow batches bounded by bytes where it leaves them at Spark's default or above."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("bB")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
    return spark


def lean(run: Callable) -> Callable:
    """run, for mapInArrow; at its end the worker gives memory that it no longer uses back to the system."""

    @functools.wraps(run)
    def outer(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return outer


def give_back() -> None:
    """Memory that this process no longer uses goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def id_type(df: DataFrame) -> str:
    return df.schema["doc_id"].dataType.simpleString()


def per_text(df: DataFrame, fields: str, work: Callable[[pa.RecordBatch], list], limit: int = CHUNK_BYTES, keep: str | None = None) -> DataFrame:
    """A row of doc_id and fields for each row of a (doc_id, text) table; work returns the fields' columns."""
    schema = f"doc_id {keep or id_type(df)}, {fields}"
    names = ["doc_id", *(x.strip().split(" ")[0] for x in fields.split(","))]

    def run(batches):
        for part in chunks(batches, limit=limit):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *work(part)], names=names)

    return df.mapInArrow(lean(run), schema)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.empty(size, np.uint64)
        have[0] = 1
        have[1:] = base
        np.multiply.accumulate(have, out=have)
        _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = sum of values[t] * BASE**t for i <= t < j."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * powers(BASE, len(values)), out=out[1:])
    return out


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans [start, end), alike for like contents wherever they stand."""
    top = powers(INVERSE, int(start.max()) + 1 if len(start) else 1)
    return mix((sums[end] - sums[start]) * top[start] + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


#: Bytes of a word that are hashed side by side with other words'; longer words one by one.
_LONG = 256
_MASK = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
_STEP = np.uint64(0xA24BAED4963EE407)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end): blocks of eight bytes, each mixed into the hash by a non-linear step."""
    length = ends - starts
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    wide = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    out = mix(length.astype(np.uint64) * _STEP ^ wide[starts] & _MASK[np.minimum(length, 8)])
    done, active = 8, np.flatnonzero(length > 8)
    while len(active) and done < _LONG:
        left = length[active] - done
        out[active] = mix(out[active] * _STEP ^ wide[starts[active] + done] & _MASK[np.minimum(left, 8)])
        done += 8
        active = active[left > 8]
    if len(active):
        raw = memoryview(data)
        out[active] = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(starts[active].tolist(), ends[active].tolist(), strict=True)), np.uint64, len(active))
    return out


def gram_hashes(hashed: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n hashes, at each place where one begins: a non-linear step for each."""
    size = max(len(hashed) - n + 1, 0)
    out = mix(hashed[:size] + np.uint64(n))
    for i in range(1, n):
        out = mix(out * _STEP ^ hashed[i : i + size])
    return out


def distinct(values: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, edges): each stretch's distinct values, ascending, and where the stretches begin now."""
    values = values.copy()
    for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False):
        values[a:b].sort()
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    new[edges[:-1][edges[:-1] < len(values)]] = True
    return values[new], np.concatenate(([0], np.cumsum(new)))[edges]


def span_digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XXH3's 64-bit hashes of the byte spans [start, end)."""
    raw = memoryview(np.ascontiguousarray(data))
    return np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts))


#: Lower case of A-Z on bytes; other bytes, UTF-8's among them, stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words [^\x20\x09-\x0D]+ and [^\x00-\x2F\x3A-\x60\x7B-\x7F]+; UTF-8's bytes from 0x80 belong to both.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): spans of the words, and the index of each text's first one (len(texts) + 1 entries)."""
    mask = np.zeros(len(data) + 1, bool)
    mask[:-1] = inside[data]
    begins = mask.copy()
    begins[1:] &= ~mask[:-1]
    cuts = offsets[:-1]
    begins[cuts] = mask[cuts]  # a word never goes on into the next text
    starts = np.flatnonzero(begins)
    # the end of a word: the next byte that is no word byte, or the next text
    stop = np.flatnonzero(mask[:-1] & (~mask[1:] | begins[1:])) + 1
    return starts, stop, np.searchsorted(starts, offsets)


def sha256(data) -> str:
    return hashlib.sha256(data).hexdigest()


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return edge[::2], edge[1::2]


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Flags of 0..n-1 that lie in any [start, end)."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, ends, -1)
    return np.cumsum(depth[:-1]) > 0
