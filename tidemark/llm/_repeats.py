"""Windows that occur more than once, found by content-defined anchors: shared by both substring operators.

A window is ``win`` consecutive symbols (bytes or words) of one text. The k-gram with the least hash in
a window, very common grams last, is its anchor; it depends on the window's content alone, so like windows have like
anchors, and a text has about 2 / (win - k + 2) anchors per symbol. Neighbouring windows with the same
anchor form a context. Only contexts whose anchor occurs more than once go on: copies of a
context (by the anchor's hash and a hash of the context's bytes) are folded into one, its text is fetched through the id, and
contexts of an anchor meet in one task, whose suffix structure decides every window exactly.

Ids must be unique for that; ``identified`` sees to it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._arrow import INVERSE, bounded, chunks, lean, mix, powers, prefix_sums
from ._sketch import heavy, places
from ._tables import stored

#: A gram that occurs fewer times is never hot; a hot anchor's contexts are dealt to so many places.
HOT_LEAST, SALTS = 1000, 256
_SALT = np.uint64(0xC2B2AE3D27D4EB4F)


def identified(docs: DataFrame, id_col: str, text_col: str, carry: bool = False) -> DataFrame:
    """(rid, doc_id, text) with a unique rid: the id itself, or a stored number where ids repeat or are null.

    carry: with a struct ``row`` of all columns but the text.
    """
    bounded(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
        *([F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text_col)).alias("row")] if carry else []),
    )
    if rows.groupBy("doc_id").count().where((F.col("count") > 1) | F.col("doc_id").isNull()).limit(1).count():
        return stored(rows.withColumn("rid", F.monotonically_increasing_id()), "rows").select("rid", *rows.columns)
    return rows.select(F.col("doc_id").alias("rid"), *rows.columns)


def packed(rows: DataFrame) -> DataFrame:
    """The rows with z in place of the text: it, compressed for the shuffle; null stays null."""
    names = ["z" if c == "text" else c for c in rows.columns]
    schema = T.StructType([T.StructField(n, T.BinaryType() if n == "z" else f.dataType) for n, f in zip(names, rows.schema, strict=True)])

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        for part in chunks(batches):
            z = pa.array([None if x is None else squeeze.compress(x) for x in part.column("text").cast(pa.binary()).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([z if n == "z" else part.column(n) for n in names], names=names)

    return rows.mapInArrow(lean(run), schema)


def unpack(z: bytes | None) -> bytes:
    return b"" if z is None else zstandard.decompress(z)


def byte_grams(data: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k bytes from each place on; they only choose anchors, so a polynomial does."""
    sums = prefix_sums(data)
    return mix((sums[k:] - sums[:-k]) * powers(INVERSE, len(sums))[: len(data) - k + 1]) if len(data) >= k else np.zeros(0, np.uint64)


def contexts(gram: np.ndarray, offsets: np.ndarray, k: int, win: int, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key, start, n): contexts of the texts, given the hashes of the k-grams from each symbol on, and which of them are hot.

    key is the anchor's hash, start the first window's first symbol, n the number of windows; a context spans
    n + win - 1 symbols.
    """
    n = len(gram) + k - 1
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if n < win:
        return none
    # hot grams come last, so that a window is anchored by one only where it has no others
    low = ((gram >> np.uint64(33) | hot.astype(np.uint64) << np.uint64(31)) << np.uint64(32)) | np.arange(n - k + 1, dtype=np.uint64)
    width, have = win - k + 1, 1
    while 2 * have <= width:  # least of the next 1, 2, 4 ... grams
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        rest = width - have
        low = np.minimum(low[:-rest], low[rest:])
    inside = np.zeros(len(low) + 1, np.int32)
    size = np.diff(offsets)
    full = size >= win
    np.add.at(inside, offsets[:-1][full], 1)
    np.add.at(inside, offsets[1:][full] - win + 1, -1)
    valid = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    if not len(valid):
        return none
    owner = (low[valid] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (np.diff(owner) != 0) | (np.diff(valid) != 1))))
    start, count = valid[new], np.diff(np.append(new, len(valid)))
    return gram[owner[new]], start, count


def hot_grams(rows: DataFrame, grams, limit: int) -> np.ndarray:
    """Which counters belong to k-grams that may be 1 / 65536 of all or more; grams gives the hashes of a chunk's."""
    return heavy(rows.select("text"), grams, _SALT, limit, 16, HOT_LEAST)


def is_hot(hot: np.ndarray, gram: np.ndarray) -> np.ndarray:
    return hot[places(gram, _SALT)]


def salted(found: DataFrame) -> DataFrame:
    """found with ``salt``: contexts of hot grams alone are spread by their texts; they count as repeated anyway, so no task needs all of one."""
    return found.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("rid"), F.lit(SALTS))).otherwise(0).cast("int"))


def rows_of(part: pa.RecordBatch, found: tuple[np.ndarray, ...], offsets: np.ndarray, hot: np.ndarray) -> pa.RecordBatch:
    """Contexts as rows (key, digest, rid, doc_id, start, n, hot), starts counted from the text's first symbol."""
    key, digest, start, count = found
    doc = np.searchsorted(offsets, start, side="right") - 1
    rid, doc_id = part.column("rid").to_numpy(zero_copy_only=False), part.column("doc_id")
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64)), pa.array(digest.view(np.int64)), pa.array(rid[doc].astype(np.int64)), doc_id.take(pa.array(doc)), pa.array((start - offsets[doc]).astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(is_hot(hot, key))],
        names=["key", "digest", "rid", "doc_id", "start", "n", "hot"],
    )


CONTEXT = "key bigint, digest bigint, rid bigint, doc_id bigint, start int, n int, hot boolean"


def keyed_groups(batches, limit: int):
    """Rows sorted by key, in pieces of whole keys of about limit bytes of text each."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for batch in batches:
        if not len(batch):
            continue
        keys = batch.column("key").to_numpy()
        total = np.concatenate(([0], np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))))
        begins = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))
        at = 0  # rows before this one have been passed on or are held
        for start, end in zip(begins, begins[1:], strict=False):
            if size + total[end] - total[at] > limit and (start > 0 or keys[0] != last):
                if start > at:
                    held.append(batch.slice(at, start - at))
                if held:
                    yield pa.Table.from_batches(held).combine_chunks()
                held, size, at = [], 0, int(start)
        held.append(batch.slice(at))
        size += int(total[-1] - total[at])
        last = keys[-1]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()

