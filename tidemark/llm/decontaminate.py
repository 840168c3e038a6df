"""Benchmark decontamination: word n-grams of benchmark items looked up in the windows of all texts.

The items' normalised n-grams, as long as there are at most ``max_windows`` of them, become a sorted set of 64-bit hashes (grams alongside,
for the check of hits), which is broadcast. Each task hashes the words of its texts once, looks up every window's
hash, and verifies each hit by its bytes. A larger benchmark isn't broadcast: its grams and the texts' windows meet by hash
in a shuffle, hits go back to their texts by id, are verified there, and then meet the items that have them.

Normal form: A-Z lowered, words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. An item of fewer than n words, but not
none, is one window of its own length. A document's word inside any occurrence of a window is hit.

Defined results: null and empty texts have no words and are never contaminated; an item without words matches nothing;
repeated items count once by their item_id; null item ids are left out of the lists but their windows hit; repeated rows and ids of
documents give a row each.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._arrow import ALNUM, LOWER, bounded, chunks, covered, flat, gram_hashes, lean, runs, sha256, texts, word_hashes, words
from ._repeats import packed, unpack
from ._tables import stored

#: n-grams that are broadcast at most: some hundred bytes of a worker's memory each.
MAX_WINDOWS = 1 << 20
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_FIELDS = "n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, spans array<struct<start:bigint,stop:bigint>>"
_NAMES = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"]


class Split:
    """A chunk's words: lowered bytes, offsets of texts, and starts, ends, hashes and each text's first of the words."""

    def __init__(self, column: pa.Array):
        data, self.offsets = flat(column)
        self.data = LOWER[data]
        self.starts, self.ends, self.first = words(self.data, self.offsets, ALNUM)
        self.hashed = word_hashes(self.data, self.starts, self.ends)
        self.raw = self.data.tobytes()

    def gram(self, i: int, size: int) -> bytes:
        """The words from i on, joined by spaces, which no word holds."""
        return b" ".join([self.raw[a:b] for a, b in zip(self.starts[i : i + size].tolist(), self.ends[i : i + size].tolist(), strict=True)])

    def text_of(self, i):
        return np.searchsorted(self.first, i, side="right") - 1


def _grams(benchmark: DataFrame, n: int, item_col: str, text_col: str) -> DataFrame:
    """(size, hash, gram, item) of all items' windows; item: the id as text."""
    rows = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text"))
    bounded(rows.sparkSession)

    def run(batches):
        for part in chunks(batches):
            own = Split(part.column("text"))
            count = np.diff(own.first)
            for size in range(1, n + 1):
                some = np.flatnonzero(count >= n if size == n else count == size)
                places = np.concatenate([np.arange(own.first[t], own.first[t + 1] - size + 1) for t in some]) if len(some) else np.zeros(0, np.int64)
                if len(places):
                    hashed = gram_hashes(own.hashed, size)[places].view(np.int64)
                    grams = pa.array([own.gram(i, size) for i in places.tolist()], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(places), size, np.int32)), pa.array(hashed), grams, part.column("item").take(pa.array(own.text_of(places)))], names=["size", "hash", "gram", "item"])

    return rows.mapInArrow(lean(run), "size int, hash bigint, gram binary, item string").distinct()


class Windows:
    """A set of benchmark n-grams, ready for lookup: for each size the sorted hashes, and the grams with their items in that order."""

    def __init__(self, rows: list[tuple]):
        grams: dict[tuple, set] = {}
        for size, hashed, gram, item in rows:
            grams.setdefault((size, hashed & (1 << 64) - 1, bytes(gram)), set()).add(item)
        self.by_size: dict[int, tuple[np.ndarray, list]] = {}
        for size in sorted({x[0] for x in grams}):
            own = sorted(x for x in grams if x[0] == size)
            self.by_size[size] = np.array([x[1] for x in own], np.uint64), [(x[2], sorted(i for i in grams[x] if i is not None)) for x in own]


def find(own: Split, table: Windows) -> tuple[np.ndarray, list[set]]:
    """(hits, items): which words of a chunk are hit, and the items by text."""
    hits = np.zeros(len(own.starts), bool)
    items: list[set] = [set() for _ in range(len(own.offsets) - 1)]
    for size, (known, grams) in table.by_size.items():
        found = gram_hashes(own.hashed, size)
        at = np.searchsorted(known, found)
        at[at == len(known)] = 0
        for i in np.flatnonzero(known[at] == found):
            k, doc = int(at[i]), int(own.text_of(i))
            if i + size > own.first[doc + 1]:
                continue  # it would go on into the next text
            gram = own.gram(int(i), size)
            while k < len(known) and known[k] == found[i]:
                if grams[k][0] == gram:
                    hits[i : i + size] = True
                    items[doc].update(grams[k][1])
                k += 1
    return hits, items


def _spans(own: Split, hits: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Hit words' runs of a text, in bytes from its beginning."""
    a, b = runs(hits[own.first[i] : own.first[i + 1]])
    return own.starts[own.first[i] + a] - own.offsets[i], own.ends[own.first[i] + b - 1] - own.offsets[i]


def _counts(own: Split, hits: np.ndarray) -> tuple[np.ndarray, list]:
    """(hit words, spans) of each text."""
    n_hit = np.diff(np.concatenate(([0], np.cumsum(hits)))[own.first])
    spans: list = [[] for _ in range(len(n_hit))]
    for i in np.flatnonzero(n_hit):
        spans[i] = [{"start": x, "stop": y} for x, y in zip(*(e.tolist() for e in _spans(own, hits, i)), strict=True)]
    return n_hit, spans


def _few(grams: DataFrame, max_windows: int) -> list[tuple] | None:
    """The rows of a set of grams, where there are at most so many."""
    rows = grams.limit(max_windows + 1).collect()
    return None if len(rows) > max_windows else [tuple(r) for r in rows]


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 10, max_windows: int = MAX_WINDOWS, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans (hit words' [start, end) in bytes) of every text.

    A benchmark of more than max_windows different n-grams (of each item) is joined, not broadcast; results are the same.
    """
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    grams = _grams(benchmark, n, item_col, item_text_col)
    few = _few(grams, max_windows)
    if few is None:
        return _joined(rows, stored(grams, "grams"), kind)
    table = rows.sparkSession.sparkContext.broadcast(Windows(few))

    def run(batches):
        for part in chunks(batches):
            own = Split(part.column("text"))
            hits, items = find(own, table.value)
            n_hit, spans = _counts(own, hits)
            listed = [sorted(x) for x in items]
            columns = [pa.array(np.diff(own.first)), pa.array(n_hit), pa.array([len(x) for x in listed], pa.int64()), pa.array([sha256(",".join(x).encode()) for x in listed], pa.string()), pa.array(n_hit > 0), pa.array(spans, _SPAN)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=["doc_id", *_NAMES])

    return rows.mapInArrow(lean(run), f"doc_id {kind}, {_FIELDS}")


def _hits(rows: DataFrame, grams: DataFrame) -> DataFrame:
    """(rid, n_words, n_hit, spans, grams) of (rid, text): by hash in a shuffle, then by bytes in the texts."""
    sizes = [r.size for r in grams.select("size").distinct().collect()]  # at most n

    def windows(batches):
        for part in chunks(batches, limit=1 << 19):
            own = Split(part.column("text"))
            rid = part.column("rid").to_numpy()
            for size in sizes:
                hashed = gram_hashes(own.hashed, size)
                text = own.text_of(np.arange(len(hashed)))
                inside = np.flatnonzero(np.arange(len(hashed)) + size <= own.first[text + 1])
                text = text[inside]
                columns = [pa.array(rid[text]), pa.array((inside - own.first[text]).astype(np.int32)), pa.array(np.full(len(text), size, np.int32)), pa.array(hashed[inside].view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["rid", "place", "size", "hash"])

    met = rows.mapInArrow(lean(windows), "rid bigint, place int, size int, hash bigint").join(grams.select("size", "hash", "gram").distinct(), ["size", "hash"])
    wanted = met.groupBy("rid").agg(F.collect_list(F.struct("place", "size", "gram")).alias("wanted"))

    def verify(batches):
        for batch in batches:
            out = []
            for rid, z, wanted in zip(batch.column("rid").to_pylist(), batch.column("z"), batch.column("wanted").to_pylist(), strict=True):
                own = Split(pa.array([unpack(z.as_py())], pa.binary()))
                hits, seen = np.zeros(len(own.starts), bool), set()
                for w in wanted or ():
                    if own.gram(w["place"], w["size"]) == w["gram"]:
                        hits[w["place"] : w["place"] + w["size"]] = True
                        seen.add((w["size"], w["gram"]))
                n_hit, spans = _counts(own, hits)
                out.append((rid, len(hits), int(n_hit[0]), spans[0], [{"size": s, "gram": g} for s, g in sorted(seen)]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), _SPAN, pa.list_(pa.struct([("size", pa.int32()), ("gram", pa.binary())])))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)], names=["rid", "n_words", "n_hit", "spans", "grams"])

    schema = "rid bigint, n_words bigint, n_hit bigint, spans array<struct<start:bigint,stop:bigint>>, grams array<struct<size:int,gram:binary>>"
    return packed(rows).join(wanted, "rid", "left").select("rid", "z", "wanted").mapInArrow(lean(verify), schema)


def _joined(rows: DataFrame, grams: DataFrame, kind: str) -> DataFrame:
    """As scan(), of any number of grams."""
    rows = stored(rows.withColumn("rid", F.monotonically_increasing_id()), "rows")
    found = stored(_hits(rows.select("rid", "text"), grams), "hits")
    own = found.select("rid", F.explode("grams").alias("g")).select("rid", "g.size", "g.gram").join(grams.where("item is not null"), ["size", "gram"]).select("rid", "item").distinct()
    listed = own.groupBy("rid").agg(F.array_sort(F.collect_list("item")).alias("items"))
    out = rows.select("rid", "doc_id").join(found.drop("grams"), "rid").join(listed, "rid", "left")
    return out.select(
        "doc_id", "n_words", "n_hit", F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "spans",
    )


def clean(docs: DataFrame, benchmark: DataFrame, n: int = 10, max_share: float = 0.5, max_windows: int = MAX_WINDOWS, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents without the hit spans; those of which over max_share of the words are hit, go. All columns stay as they are but the text.

    A text column's name that another column has too is an error, as rows can't be told apart then.
    """
    bounded(docs.sparkSession)
    schema, names = docs.schema, docs.columns
    if len(set(names)) != len(names):
        raise ValueError("column names must differ")
    grams = _grams(benchmark, n, item_col, item_text_col)
    few = _few(grams, max_windows)
    if few is None:
        return _cut_out(docs, stored(grams, "grams"), max_share, text_col)
    table = docs.sparkSession.sparkContext.broadcast(Windows(few))

    def run(batches):
        for part in chunks(batches, text_col):
            own = Split(part.column(text_col))
            hits, _ = find(own, table.value)
            n_hit = np.diff(np.concatenate(([0], np.cumsum(hits)))[own.first])
            keep = n_hit <= max_share * np.diff(own.first)
            column = part.column(text_col).to_pylist()
            raw = flat(part.column(text_col))[0]
            for i in np.flatnonzero(n_hit):
                if keep[i]:
                    column[i] = _without(raw[own.offsets[i] : own.offsets[i + 1]], *_spans(own, hits, i))
            at = part.schema.get_field_index(text_col)
            out = part.set_column(at, part.schema.field(at), pa.array(column, part.schema.field(at).type))
            yield out.filter(pa.array(keep))

    return docs.mapInArrow(lean(run), schema)


def _without(raw: np.ndarray, starts, ends) -> str:
    return raw[~covered(len(raw), starts, ends)].tobytes().decode()


def _cut_out(docs: DataFrame, grams: DataFrame, max_share: float, text_col: str) -> DataFrame:
    """As clean(), of any number of grams."""
    rows = stored(docs.select(F.monotonically_increasing_id().alias("rid"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")), "rows")
    found = _hits(rows.select("rid", F.col("row").getField(text_col).cast("string").alias("text")), grams).drop("grams")
    kept = rows.join(found.where(F.col("n_hit") <= max_share * F.col("n_words")), "rid").select("row", F.col("row").getField(text_col).cast("string").alias("text"), "spans")

    def run(batches):
        for batch in batches:
            values = batch.column("text").to_pylist()
            for i, own in enumerate(batch.column("spans").to_pylist()):
                if own:
                    edges = np.array([(x["start"], x["stop"]) for x in own])
                    values[i] = _without(np.frombuffer(values[i].encode(), np.uint8), edges[:, 0], edges[:, 1])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(values, pa.string())], names=["row", "kept"])

    out = kept.mapInArrow(lean(run), T.StructType([kept.schema["row"], T.StructField("kept", T.StringType())]))
    return out.select(*(F.col("kept").cast(docs.schema[c].dataType).alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns))
