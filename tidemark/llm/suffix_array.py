"""Suffix-array dedup of exact substrings.

Contexts of repeated anchors (see ``_repeats``) are gathered by anchor into shards. Each shard's suffix array is
built by induced sorting: suffixes are classified as S or L, leftmost S suffixes (LMS) are
sorted through their substrings' names, recursively (down to a reduced text of bounded size, whose prefixes are doubled until they differ), and the shard's array is induced from them in two linear scans. The
scans run over whole stretches of settled entries at a time, and one by one over short ones. Permuted common prefixes follow from the
irreducible ones; suffixes whose neighbours share at least ``length`` bytes are repeats.

A byte goes if a string of ``length`` bytes over it starts anywhere else, in the same text or another, judged on the input.
Defined results: null and empty texts have 0 bytes and nothing removed; a repeated row is one more text; texts shorter
than ``length`` keep everything. Cutting inside a character is possible, so what is kept is bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._arrow import chunks, covered, flat, lean, runs, sha256, span_digests
from ._repeats import byte_grams, contexts, hot_grams, identified, is_hot, keyed_groups, packed, rows_of, salted, unpack
from ._tables import stored

#: Bytes of the anchoring grams, and of a shard; an anchor's contexts stay in one shard.
GRAM, SHARD = 50, 2 << 20
#: Symbols of the reduced text that ends the recursion: as many buckets as symbols, one by one, take longer than sorting them.
BASE = 1 << 15
#: Entries of a stretch that are induced one by one.
FEW = 32


def _ordered(values: np.ndarray) -> np.ndarray:
    """The stable order of non-negative integers; wide ones by their halves, as NumPy sorts 16 bits by radix."""
    if values.itemsize <= 2:
        return values.argsort(kind="stable")
    order = (values & 0xFFFF).astype(np.uint16).argsort(kind="stable")
    return order[(values >> 16).astype(np.uint16)[order].argsort(kind="stable")]


def _put(out: np.ndarray, slot: np.ndarray, found: np.ndarray, letter: np.ndarray, step: int) -> None:
    """Each found position takes its letter's next place, in their order; slot is moved on by step for each."""
    order = _ordered(letter)
    ranked = letter[order]
    nth = np.arange(len(ranked))
    first = nth.copy()
    first[1:][ranked[1:] == ranked[:-1]] = 0
    nth -= np.maximum.accumulate(first, out=first)
    place = slot[ranked] + step * nth
    slot[ranked] = place + step  # the last one of each letter counts
    out[place] = found[order]


def _put_few(out: memoryview, slot: memoryview, settled: list[int], wanted: memoryview, keys: memoryview, step: int) -> None:
    """As _put(), one by one, of the wanted positions before the settled ones."""
    for i in settled:
        if wanted[i - 1]:
            letter = keys[i - 1]
            place = slot[letter]
            out[place] = i - 1
            slot[letter] = place + step


def _induce(keys: np.ndarray, s_type: np.ndarray, seeds: np.ndarray, n_l: np.ndarray, n_s: np.ndarray) -> np.ndarray:
    """The order of all suffixes but the last (the sentinel's), induced from the LMS suffixes in seeds' order.

    n_l, n_s: L and S suffixes by letter, the sentinel's left out.
    """
    letters = len(n_l)
    n_m = np.bincount(keys[seeds], minlength=letters)
    # left to right: per letter, places of L suffixes, then its seeds
    begin = np.concatenate(([0], np.cumsum(n_l + n_m)))
    out = np.empty(begin[-1], np.int32)
    out[np.repeat(begin[:-1] + n_l - (np.cumsum(n_m) - n_m), n_m) + np.arange(len(seeds))] = seeds
    slot, stop = begin[:-1].copy(), begin[:-1] + n_l
    letter, at, total = 0, 0, len(out)
    wanted = ~s_type  # position -1 stands for the sentinel, which nothing induces
    views = memoryview(out), memoryview(slot), memoryview(wanted), memoryview(keys), memoryview(stop)
    while at < total:
        while letter < letters and views[1][letter] == views[4][letter]:
            ahead = slot[letter : letter + 512] < stop[letter : letter + 512]
            first = int(ahead.argmax())
            letter = letter + first if ahead[first] else min(letter + 512, letters)
        limit = views[1][letter] if letter < letters else total
        if limit - at <= FEW:
            _put_few(*views[:2], out[at:limit].tolist(), *views[2:4], 1)
        else:
            before = out[at:limit].astype(np.intp) - 1
            before = before[wanted[before]]
            if len(before):
                _put(out, slot, before, keys[before], 1)
        at = limit
    l_sorted = out[wanted[out]]
    # right to left: per letter, its L suffixes, then places of S suffixes
    begin = np.concatenate(([0], np.cumsum(n_l + n_s)))
    out = np.empty(begin[-1], np.int32)
    out[np.repeat(begin[:-1] - (np.cumsum(n_l) - n_l), n_l) + np.arange(len(l_sorted))] = l_sorted
    slot, stop = begin[1:] - 1, begin[:-1] + n_l - 1
    letter, at = letters - 1, len(out) - 1
    wanted = s_type.copy()
    wanted[-1] = False
    views = memoryview(out), memoryview(slot), memoryview(wanted), memoryview(keys), memoryview(stop)
    while at >= 0:
        while letter >= 0 and views[1][letter] == views[4][letter]:
            low = max(0, letter - 511)
            ahead = (slot[low : letter + 1] > stop[low : letter + 1])[::-1]
            first = int(ahead.argmax())
            letter = letter - first if ahead[first] else low - 1
        limit = views[1][letter] if letter >= 0 else -1
        settled = out[limit + 1 : at + 1][::-1]
        if at - limit <= FEW:
            _put_few(*views[:2], settled.tolist(), *views[2:4], -1)
        else:
            before = settled.astype(np.intp) - 1
            before = before[wanted[before]]
            if len(before):
                _put(out, slot, before, keys[before], -1)
        at = limit
    return out


def _words(text: np.ndarray) -> tuple[np.ndarray, int]:
    """Eight bytes from each symbol on, zeros after the last one, as a number whose low end comes first; and the symbols in them."""
    per = 8 // text.itemsize
    padded = np.zeros(len(text) + per, text.dtype)
    padded[: len(text)] = text
    return np.ndarray((len(text) + 1,), "<u8", padded, strides=(text.itemsize,)), per


def _like_before(keys: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether each span of size symbols from start on, but the first, equals the one before it in this list."""
    wide, per = _words(keys)
    bits = 8 * keys.itemsize
    mask = np.array([(1 << bits * k) - 1 for k in range(per + 1)], np.uint64)
    word = wide[start] & mask[np.minimum(size, per)]
    same = (word[1:] == word[:-1]) & (size[1:] == size[:-1])
    done, live = per, np.flatnonzero(same & (size[1:] > per))
    while len(live) and done < 8 * per:
        left = mask[np.minimum(size[live] - done, per)]
        equal = (wide[start[live] + done] ^ wide[start[live + 1] + done]) & left == 0
        same[live[~equal]] = False
        done += per
        live = live[equal & (size[live] > done)]
    if len(live):  # what is left of long ones in one go
        left = size[live] - done
        begin = np.cumsum(left) - left
        at = np.arange(begin[-1] + left[-1]) - np.repeat(begin - done, left)
        equal = keys[np.repeat(start[live], left) + at] == keys[np.repeat(start[live + 1], left) + at]
        same[live] = np.logical_and.reduceat(equal, begin)
    return same


def suffix_array(text: np.ndarray, base: int | None = None) -> np.ndarray:
    """The suffixes' starts in order, of a text of non-negative integers; a shorter suffix comes before a longer like one.

    base: names of at most so many substrings end the recursion (BASE, if none is given).
    """
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    full = np.empty(n + 1, np.int32)
    full[:-1] = text
    full[:-1] += 1
    full[-1] = 0
    return _sorted(full, int(full.max()) + 1, BASE if base is None else base)


def _few(text: np.ndarray) -> np.ndarray:
    """As _sorted(), of a short text: prefixes double until they differ."""
    n, rank, reach = len(text), text.astype(np.int64), 1
    while True:
        key = rank * (int(rank.max()) + 1)
        key[:-reach] += rank[reach:]
        order = key.argsort()
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1])))
        if rank[order[-1]] == n - 1:
            return order[1:]  # without the sentinel
        reach *= 2


def _sorted(text: np.ndarray, letters: int, base: int) -> np.ndarray:
    """As suffix_array, of a text that ends in its only 0, which the result leaves out."""
    n = len(text)
    keys = text.astype(np.uint8 if letters <= 256 else np.uint16 if letters <= 65536 else np.int32, copy=False)
    change = np.flatnonzero(keys[:-1] != keys[1:])
    s_type = np.ones(n, bool)
    s_type[:-1] = np.repeat(keys[change] < keys[change + 1], np.diff(change, prepend=-1))
    n_l = np.bincount(keys[~s_type], minlength=letters)
    n_s = np.bincount(keys[:-1], minlength=letters) - n_l
    lms = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1  # the sentinel among them, last
    inner = lms[:-1]
    first = inner[_ordered(keys[inner])]
    if len(inner) > 1:
        ranked = _induce(keys, s_type, _with_sentinel(first, n), n_l, n_s)
        nth = np.full(n, -1, np.int32)  # of the LMS suffixes, by position
        nth[inner] = np.arange(len(inner))
        which = nth[ranked]
        which = which[which >= 0]
        # names: substrings from one LMS suffix to the next, each compared with the one before it in order
        ranked = inner[which]
        name = np.cumsum(np.concatenate(([True], ~_like_before(keys, ranked, np.diff(lms)[which] + 1))))
        if name[-1] < len(inner):
            reduced = np.zeros(len(inner) + 1, np.int32)
            reduced[which] = name
            order = _few(reduced) if len(reduced) <= base else _sorted(reduced, int(name[-1]) + 1, base)
            ranked = inner[order]
        first = ranked
    return _induce(keys, s_type, _with_sentinel(first, n), n_l, n_s)


def _with_sentinel(seeds: np.ndarray, n: int) -> np.ndarray:
    return np.concatenate(([n - 1], seeds))


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each rank the length shared with the suffix before; from the irreducible entries of the permuted array."""
    n = len(text)
    if n < 2:
        return np.zeros(n, np.int64)
    left = np.empty(n, np.int64)  # the suffix before, by position
    left[order[1:]] = order[:-1]
    left[order[0]] = -1
    reducible = left > 0
    reducible[0] = False
    reducible[1:] &= left[:-1] >= 0
    reducible[1:] &= text[np.maximum(left[1:] - 1, 0)] == text[:-1]
    i = np.flatnonzero(~reducible)
    j = left[i]
    most = np.where(j < 0, 0, n - np.maximum(i, j))
    done = np.zeros(len(i), np.int64)
    wide, per = _words(text)
    bits = 8 * text.itemsize
    live = np.flatnonzero(most)
    while len(live):
        differ = wide[i[live] + done[live]] ^ wide[j[live] + done[live]]
        low = differ & (~differ + np.uint64(1))  # the lowest bit that differs
        done[live] += np.bitwise_count(low - np.uint64(1)) // bits
        live = live[(differ == 0) & (done[live] < most[live])]
    np.minimum(done, most, out=done)
    # one less than the entry before, where it is reducible
    lengths = np.repeat(done + i, np.diff(i, append=n)) - np.arange(n)
    return lengths[order]


def repeated_starts(text: np.ndarray, owned: np.ndarray, weight: np.ndarray, length: int) -> np.ndarray:
    """Flags of positions: owned ones whose next length bytes have, over all owned positions, a weight of 2 or more."""
    order = suffix_array(text)
    linked = common_prefixes(text, order) >= length
    group = np.cumsum(~linked) - 1
    total = np.bincount(group, np.where(owned, weight, 0)[order])
    out = np.zeros(len(text), bool)
    out[order] = total[group] >= 2
    return out & owned


def dedup(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (binary) and spans ([start, end) removed, in bytes)."""
    spark = docs.sparkSession
    rows = identified(docs, id_col, text_col)
    gram = min(GRAM, length)

    hot = spark.sparkContext.broadcast(hot_grams(rows, lambda part: byte_grams(flat(part.column("text"))[0], gram), 1 << 19))

    def find(batches):
        for part in chunks(batches, limit=1 << 19):
            data, offsets = flat(part.column("text"))
            hashed = byte_grams(data, gram)
            key, start, n = contexts(hashed, offsets, gram, length, is_hot(hot.value, hashed))
            yield rows_of(part, (key, span_digests(data, start, start + n + length - 1), start, n), offsets, hot.value).drop_columns(["doc_id"])

    found = salted(rows.mapInArrow(lean(find), "key bigint, digest bigint, rid bigint, start int, n int, hot boolean"))
    by_key, by_context = Window.partitionBy("key", "salt"), Window.partitionBy("key", "salt", "digest").orderBy("rid", "start")
    # repeated anchors only; the first place of each context stands for its copies
    repeated = found.withColumn("place", F.row_number().over(by_context)).withColumn("m", F.count("*").over(by_key)).where("hot or m > 1").drop("m", "salt", "hot")
    repeated = stored(repeated, "contexts")
    copies = repeated.where("place <= 2").groupBy("key", "digest").agg(F.min_by(F.struct("rid", "start", "n"), "rid").alias("x"), F.least(F.count("*"), F.lit(2)).cast("int").alias("weight"))
    wanted = copies.select("key", "digest", "x.*", "weight").groupBy("rid").agg(F.collect_list(F.struct("key", "digest", "start", "n", "weight")).alias("wanted"))
    compressed = packed(rows)

    def cut(batches):
        for batch in batches:
            out: list[tuple] = []
            for z, own in zip(batch.column("z"), batch.column("wanted"), strict=True):
                raw = unpack(z.as_py())
                out += [(w["key"], w["digest"], w["n"], w["weight"], raw[w["start"] : w["start"] + w["n"] + length - 1]) for w in own.as_py()]
                if len(out) > 4096:
                    yield _batch(out)
                    out = []
            if out:
                yield _batch(out)

    pieces = compressed.join(wanted, "rid").select("z", "wanted").mapInArrow(lean(cut), "key bigint, digest bigint, n int, weight int, text binary")

    def shard(batches):
        for group in keyed_groups(batches, SHARD):
            data, offsets = flat(group.column("text"))
            n = group.column("n").to_numpy().astype(np.int64)
            inside = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
            owned = inside < np.repeat(n, np.diff(offsets))
            flags = repeated_starts(data, owned, np.repeat(group.column("weight").to_numpy(), np.diff(offsets)), length)
            a, b = runs(flags)
            # every context ends in length - 1 bytes that aren't owned, so no run reaches into the next
            doc = np.searchsorted(offsets, a, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [group.column("key").combine_chunks().take(pa.array(doc)), group.column("digest").combine_chunks().take(pa.array(doc)), pa.array((a - offsets[doc]).astype(np.int32)), pa.array((b - offsets[doc]).astype(np.int32))],
                names=["key", "digest", "a", "b"],
            )

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hits = pieces.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(lean(shard), "key bigint, digest bigint, a int, b int")
    places = repeated.join(hits, ["key", "digest"]).select("rid", (F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("b") + (length - 1)).alias("b"))
    spans = places.groupBy("rid").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    fields = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary, spans array<struct<start:bigint,stop:bigint>>"

    def finish(batches):
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                out = []
                for z, own in zip(part.column("z"), part.column("spans"), strict=True):
                    raw = unpack(z.as_py())
                    a, b, kept = np.zeros(0, int), np.zeros(0, int), raw
                    if own.is_valid:
                        edges = own.values.flatten()
                        gone = covered(len(raw), edges[0].to_numpy(), edges[1].to_numpy())
                        a, b = runs(gone)
                        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                    out.append((len(raw), len(raw) - len(kept), len(a), sha256(kept), kept, [{"start": x, "stop": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)]))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])

    return compressed.join(spans, "rid", "left").select("doc_id", "z", "spans").mapInArrow(lean(finish), fields)


def _batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)], names=["key", "digest", "n", "weight", "text"])
