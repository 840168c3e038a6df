"""Fuzzy line dedup by MinHash.

Lines are cut at line feeds; a line that is blank but for white space is layout and stays. Equal lines (by 64-bit digest) fold into
one node with its first place, within chunks of texts before any shuffle. Each distinct line gets a MinHash signature over its character shingles;
bands of it are bucketed (``BANDS`` of ``ROWS`` hashes: at similarity 0.8 a pair meets with probability 0.9998, at
0.75 with 0.998), candidates are verified by the exact Jaccard similarity of their shingle sets, and the links'
connected components (distributed union-find) keep the line that comes first, by id and line number; the others go.

Defined results: null and empty texts have no lines and stay as they are; a line shorter than a shingle is one shingle;
with repeated or null ids, rows count in the table's order. A text that keeps all its lines is returned unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._arrow import INVERSE, chunks, distinct, lean, mix, powers, prefix_sums, sha256
from ._groups import MEMBER, blocked, meet, member_batch
from ._repeats import identified, packed, unpack
from ._tables import stored
from .components import components

#: Characters of a shingle; bands, and hashes of a band.
SHINGLE, BANDS, ROWS = 8, 12, 3
#: Bytes of lines whose shingles are made at once; a longer line is looked at alone.
SLICE = 1 << 17
_BLANK = " \t\r\x0b\x0c"


def shingles(lines: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the k-character shingles of each line, repeats included; a shorter line is one."""
    code = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    start = np.cumsum(size) - size
    sums = prefix_sums(code + np.uint64(1))
    count = np.maximum(size - k + 1, 1)
    first = np.concatenate(([0], np.cumsum(count)))
    at = np.arange(first[-1]) + np.repeat(start - first[:-1], count)
    end = np.minimum(at + k, np.repeat(start + size, count))
    return mix((sums[end] - sums[at]) * powers(INVERSE, len(code) + 1)[at] + (end - at).astype(np.uint64)), first


#: Of each hash of a signature: a number set against a shingle's hash and an odd one that it is multiplied by.
_SALTS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = (_SALTS >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_OFFSETS = _SALTS.astype(np.uint32)
#: Shingles that the functions go over at once: they stay in the processor's cache.
_TILE = 1 << 15


def _short_shingles(lines: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """As shingles(), in 32 bits: enough to choose candidates, which are verified."""
    code = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4")
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    ends = np.cumsum(size)
    hashed = np.zeros(len(code), np.uint32)
    gram = code[: max(len(code) - k + 1, 0)].copy()
    for i in range(1, k):
        gram *= np.uint32(0x01000193)
        gram += code[i : i + len(gram)]
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        gram ^= gram >> np.uint32(shift)
        gram *= np.uint32(factor)
    hashed[: len(gram)] = gram ^ (gram >> np.uint32(16))
    # the last k - 1 characters of a line begin no shingle
    edge = np.zeros(len(code) + 1, np.int8)
    edge[ends - np.minimum(size, k - 1)] += 1
    edge[ends] -= 1
    begins = np.cumsum(edge[:-1], dtype=np.int8) == 0
    tiny = np.flatnonzero(size < k)
    begins[ends[tiny] - size[tiny]] = True
    hashed[ends[tiny] - size[tiny]] = [xxhash.xxh32_intdigest(lines[i].encode("utf-8", "surrogatepass")) for i in tiny]
    return hashed[begins], np.concatenate(([0], np.cumsum(np.maximum(size - k + 1, 1))))


def _bands(hashes: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """A column of hashes for each band, of 32-bit shingle hashes. Each function has an offset and a factor of its own: multiples
    of one hash would not do, as a shingle with a low one is the least under many of them."""
    n = len(first) - 1
    least = np.empty((BANDS * ROWS, n), np.uint32)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(first, first[i] + _TILE, side="right")) - 1)
        own, at = hashes[first[i] : first[j]], first[i:j] - first[i]
        salted = np.empty_like(own)
        for k in range(BANDS * ROWS):
            np.bitwise_xor(own, _OFFSETS[k], out=salted)
            np.multiply(salted, _FACTORS[k], out=salted)
            least[k, i:j] = np.minimum.reduceat(salted, at)
        i = j
    out = []
    for band in range(BANDS):
        key = np.full(n, band + 1, np.uint64)
        for row in range(ROWS):
            key = mix(key ^ least[band * ROWS + row])
        out.append(key)
    return out


def signatures(hashes: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """A column of hashes for each band, of lines whose 64-bit shingle hashes begin at first."""
    return _bands((hashes >> np.uint64(32)).astype(np.uint32), first)


def _digest(lines: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) for x in lines), np.uint64, len(lines)).view(np.int64)


def _distinct(part: pa.RecordBatch) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(lines, rid, number): a chunk's distinct lines that aren't blank, each with its first place by rid."""
    lines = pc.split_pattern(pc.fill_null(part.column("text"), ""), "\n")
    text = pc.list_parent_indices(lines).to_numpy()
    flat = pc.list_flatten(lines)
    folded = flat.dictionary_encode()
    listed, index = folded.dictionary.to_pylist(), folded.indices.to_numpy()
    number = np.arange(len(flat)) - np.searchsorted(text, np.arange(len(lines)))[text] if len(flat) else np.zeros(0, np.int64)
    rid = part.column("rid").to_numpy(zero_copy_only=False).astype(np.int64)[text]
    order = np.lexsort((number, rid, index))
    full = np.array([i for i, x in enumerate(listed) if x.strip(_BLANK)], np.int64)
    where = order[np.searchsorted(index[order], full)] if len(full) else full
    return [listed[i] for i in full], rid[where], number[where]


def _line_sets(lines: list[bytes]) -> list[np.ndarray]:
    """Each line's distinct shingles, ascending; lines of about SLICE bytes in one go."""
    out, ends, at = [], np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines))), 0
    while at < len(lines):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] - len(lines[at]) + SLICE, side="right")))
        hashed, edges = distinct(*shingles([x.decode() for x in lines[at:stop]], SHINGLE))
        out += [hashed[a:b].copy() for a, b in zip(edges, edges[1:], strict=False)]
        at = stop
    return out


def _kept_lines(rows: DataFrame, percent: int) -> DataFrame:
    """(rid, lines): the line numbers that stay, of texts with lines that aren't blank."""
    rows = rows.select("rid", "text")

    def sign(batches):
        for part in chunks(batches, limit=1 << 19):
            lines, rid, number = _distinct(part)
            if lines:
                bands = np.stack(_bands(*_short_shingles(lines, SHINGLE)), axis=1)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, BANDS, dtype=np.int32)), pa.array(bands.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(_digest(lines)), pa.array(rid), pa.array(number.astype(np.int32)), pa.array(np.fromiter(map(len, lines), np.int32, len(lines))), lists], names=["node", "rid", "line", "n", "bands"])

    signed = stored(rows.mapInArrow(lean(sign), "node bigint, rid bigint, line int, n int, bands array<bigint>"), "signed")
    # chunks fold lines, so no text has a node twice
    nodes = stored(signed.groupBy("node").agg(F.min("rid").alias("rid"), F.min_by("line", "rid").alias("line"), F.min("n").alias("n")), "lines")
    # all lines of a bucket are likely to be alike: each bucket is a group around its least node, and the groups of a node are one
    bucket = Window.partitionBy("token")
    postings = signed.select(F.explode("bands").alias("token"), "node").withColumn("lead", F.min("node").over(bucket)).withColumn("last", F.max("node").over(bucket))
    members = postings.where("lead < last").select("lead", F.lit(-2).alias("band"), F.col("node").alias("rid")).distinct()
    members = stored(members.join(nodes.select(F.col("node").alias("rid"), "n"), "rid"), "members", after=(signed,))
    wanted = blocked(members).groupBy("rid").agg(F.collect_list("g").alias("groups")).withColumnRenamed("rid", "node")
    wanted = wanted.join(nodes.select("node", "rid", "line"), "node")
    wanted = wanted.groupBy("rid").agg(F.collect_list(F.struct("node", "line", "groups")).alias("wanted"))

    def fetch(batches):
        for batch in batches:
            out = []
            for z, own in zip(batch.column("z"), batch.column("wanted"), strict=True):
                lines = unpack(z.as_py()).decode().split("\n")
                for w in own.as_py():
                    line = lines[w["line"]].encode()  # shorter than its shingles
                    out += [(g["lead"], g["band"], g["low"], g["high"], g["block"], w["node"], line) for g in w["groups"]]
                if len(out) >= 1024:
                    yield member_batch(out)
                    out = []
            if out:
                yield member_batch(out)

    gathered = packed(rows.select("rid", "text")).join(wanted, "rid").select("z", "wanted").mapInArrow(lean(fetch), MEMBER)
    roots = components(stored(meet(gathered, percent, _line_sets), "links", after=(members,)))
    # of linked lines all but the first place of each component go
    linked = nodes.join(roots, "node").select("node", "root", F.struct("rid", "line").alias("place"))
    gone = linked.join(linked.groupBy("root").agg(F.min("place").alias("first")), "root").where("place != first").select("node")
    return nodes.join(gone, "node", "left_anti").groupBy("rid").agg(F.collect_list("line").alias("lines"))


def _remaining(raw: str, kept) -> tuple[str, int, int]:
    """(text, lines that aren't blank, those removed)."""
    lines = raw.split("\n")
    stays = set(kept or ())
    full = [bool(x.strip(_BLANK)) for x in lines]
    left = [x for i, x in enumerate(lines) if not full[i] or i in stays]
    return "\n".join(left), sum(full), len(lines) - len(left)


def dedup(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines (not blank), n_removed, kept_sha256 and kept of every text."""
    rows = identified(docs, id_col, text_col)

    def finish(batches):
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                out = [_remaining(unpack(z).decode(), own) for z, own in zip(part.column("z").to_pylist(), part.column("lines").to_pylist(), strict=True)]
                columns = [pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.int64()), pa.array([sha256(x[0].encode()) for x in out], pa.string()), pa.array([x[0] for x in out], pa.string())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=["doc_id", "n_lines", "n_removed", "kept_sha256", "kept"])

    joined = packed(rows).join(_kept_lines(rows, percent), "rid", "left").select("doc_id", "z", "lines")
    return joined.mapInArrow(lean(finish), "doc_id bigint, n_lines bigint, n_removed bigint, kept_sha256 string, kept string")


def clean(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the lines that go; one that has lost all its lines goes. Other columns stay as they are."""
    rows = identified(docs, id_col, text_col, carry=True)
    joined = packed(rows.select("rid", "row", "text")).join(_kept_lines(rows, percent), "rid", "left").select("row", "z", "lines")
    schema = T.StructType([joined.schema["row"], T.StructField("kept", T.StringType())])

    def finish(batches):
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                values, keep = [], []
                for z, own in zip(part.column("z").to_pylist(), part.column("lines").to_pylist(), strict=True):
                    text, full, gone = _remaining(unpack(z).decode(), own)
                    values.append(text if z is not None else None)
                    keep.append(not full or gone < full)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(values, pa.string())], names=["row", "kept"]).filter(pa.array(keep, pa.bool_()))

    out = joined.mapInArrow(lean(finish), schema)
    return out.select(*(F.col("kept").cast(docs.schema[c].dataType).alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns))
