"""Substring dedup by prefix-partitioned suffix trees over words.

Suffixes that can't be repeated are left out by content-defined anchors (see ``_repeats``); the rest meet by
anchor, copies of a context folded into one with its least doc_id. A task splits its suffixes by prefixes of variable
length: those with a common first word, two words, and so on, until a group fits ``GROUP`` suffixes. Each group's subtree
grows word by word; a node with one suffix is a leaf and ends there, and the internal nodes at depth
``window`` are the maximal repeats, each with the least doc_id below it.

Words are ``[^\\x20\\x09-\\x0D]+``. A word goes if a window of ``window`` words over it also starts in a text with a smaller
doc_id, judged on the input. Defined results: null and empty texts have no words; texts with equal ids don't
remove from each other; a null id is larger than any other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._arrow import NOT_SPACE, chunks, covered, flat, gram_hashes, lean, runs, sha256, span_digests, word_hashes, words
from ._repeats import CONTEXT, contexts, hot_grams, identified, is_hot, keyed_groups, packed, rows_of, salted, unpack
from ._tables import stored

#: Words of the anchoring grams; bytes of contexts that a task holds; suffixes of a group.
GRAM, SHARD, GROUP = 5, 2 << 20, 1 << 17
#: Stands for a null id: larger than any other.
LAST = (1 << 63) - 1


def _refine(node: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The children of tree nodes: numbers of the distinct (node, next word)."""
    pair = node.astype(np.int64) << 32 | word
    order = np.argsort(pair, kind="stable")
    ranked = pair[order]
    out = np.empty(len(pair), np.int64)
    out[order] = np.cumsum(np.concatenate(([False], ranked[1:] != ranked[:-1])))
    return out


def prefix_groups(text: np.ndarray, suffixes: np.ndarray, limit: int, depth: int):
    """(suffixes, prefix length, node) of groups with a common prefix, of at most limit suffixes or that whole depth long."""
    todo = [(suffixes, 0)]
    while todo:
        own, known = todo.pop()
        if len(own) <= limit or known == depth:
            yield own, known
            continue
        node = _refine(np.zeros(len(own), np.int64), text[own + known])
        order = np.argsort(node, kind="stable")
        sizes = np.bincount(node)
        edges = np.concatenate(([0], np.cumsum(sizes)))
        small: list[np.ndarray] = []
        for a, b in zip(edges, edges[1:], strict=False):
            if b - a == 1:
                continue  # a leaf
            if b - a > limit // 4:
                todo.append((own[order[a:b]], known + 1))
            else:
                small.append(own[order[a:b]])
                if sum(map(len, small)) > limit // 2:
                    yield np.concatenate(small), known
                    small = []
        if small:
            yield np.concatenate(small), known


def deep_nodes(text: np.ndarray, suffixes: np.ndarray, known: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes, node) below the internal nodes at a depth; the suffixes share their first known words, or groups do."""
    node = np.zeros(len(suffixes), np.int64)
    for d in range(known, depth):
        if not len(suffixes):
            break
        node = _refine(node, text[suffixes + d])
        inner = np.bincount(node)[node] > 1
        suffixes, node = suffixes[inner], node[inner]
    return suffixes, node


def least_ids(text: np.ndarray, suffixes: np.ndarray, least: np.ndarray, depth: int, limit: int = GROUP) -> np.ndarray:
    """For each position, the least of the values of suffixes with the same first depth words (its own, if alone)."""
    out = least.copy()
    for own, known in prefix_groups(text, suffixes, limit, depth):
        own, node = deep_nodes(text, own, known, depth)
        if len(own):
            low = np.full(int(node.max()) + 1, np.iinfo(np.int64).max)
            np.minimum.at(low, node, least[own])
            out[own] = low[node]
    return out


def dedup(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept (the words that stay, joined by single spaces)."""
    spark = docs.sparkSession
    rows = identified(docs, id_col, text_col)
    gram = min(GRAM, window)

    def split(part):
        data, offsets = flat(part.column("text"))
        starts, ends, first = words(data, offsets, NOT_SPACE)
        return data, starts, ends, first, gram_hashes(word_hashes(data, starts, ends), gram)

    hot = spark.sparkContext.broadcast(hot_grams(rows, lambda part: split(part)[-1], 1 << 20))

    def find(batches):
        for part in chunks(batches, limit=1 << 20):
            data, starts, ends, first, hashed = split(part)
            key, start, n = contexts(hashed, first, gram, window, is_hot(hot.value, hashed))
            digest = span_digests(data, starts[start], ends[start + n + window - 2])
            yield rows_of(part, (key, digest, start, n), first, hot.value)

    found = salted(rows.mapInArrow(lean(find), CONTEXT).withColumn("doc_id", F.coalesce("doc_id", F.lit(LAST))))
    by_key, by_context = Window.partitionBy("key", "salt"), Window.partitionBy("key", "salt", "digest").orderBy("doc_id", "rid", "start")
    repeated = found.withColumn("place", F.row_number().over(by_context)).withColumn("low", F.min("doc_id").over(by_key)).withColumn("high", F.max("doc_id").over(by_key))
    repeated = stored(repeated.where("hot or low < high").drop("low", "high", "salt", "hot"), "contexts")
    copies = repeated.where("place = 1").groupBy("key", "digest").agg(F.min(F.struct("doc_id", "rid", "start", "n")).alias("x"))
    wanted = copies.select("key", "digest", "x.*").groupBy("rid").agg(F.collect_list(F.struct("key", "digest", "start", "n", "doc_id")).alias("wanted"))
    compressed = packed(rows)

    def cut(batches):
        for batch in batches:
            out: list[tuple] = []
            for z, own in zip(batch.column("z"), batch.column("wanted"), strict=True):
                raw = unpack(z.as_py())
                data = np.frombuffer(raw, np.uint8)
                starts, ends, _ = words(data, np.array([0, len(data)]), NOT_SPACE)
                for w in own.as_py():
                    a, b = w["start"], w["start"] + w["n"] + window - 1
                    out.append((w["key"], w["digest"], w["n"], w["doc_id"], b" ".join([raw[x:y] for x, y in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)])))
                if len(out) > 4096:
                    yield _batch(out)
                    out = []
            if out:
                yield _batch(out)

    pieces = compressed.join(wanted, "rid").select("z", "wanted").mapInArrow(lean(cut), "key bigint, digest bigint, n int, least bigint, text binary")

    def subtrees(batches):
        for group in keyed_groups(batches, SHARD):
            split = pc.split_pattern(group.column("text").combine_chunks().cast(pa.large_string()), " ")
            # a number for each distinct word; contexts are words joined by single spaces
            text = split.flatten().dictionary_encode().indices.to_numpy().astype(np.int64)
            first = split.offsets.to_numpy().astype(np.int64)
            inside = np.arange(len(text)) - np.repeat(first[:-1], np.diff(first))
            owned = np.flatnonzero(inside < np.repeat(group.column("n").to_numpy(), np.diff(first)))
            least = np.repeat(group.column("least").to_numpy(), np.diff(first))
            low = least_ids(text, owned, least, window)[owned]
            # runs of neighbouring windows with the same least id
            new = np.flatnonzero(np.concatenate(([True], (np.diff(owned) != 1) | (np.diff(low) != 0)))) if len(owned) else np.zeros(0, np.int64)
            stop = np.append(new[1:], len(owned)) - 1
            a, b = owned[new], owned[stop] + 1 if len(owned) else owned
            doc = np.searchsorted(first, a, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [group.column("key").combine_chunks().take(pa.array(doc)), group.column("digest").combine_chunks().take(pa.array(doc)), pa.array((a - first[doc]).astype(np.int32)), pa.array((b - first[doc]).astype(np.int32)), pa.array(low[new].astype(np.int64))],
                names=["key", "digest", "a", "b", "least"],
            )

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hits = pieces.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(lean(subtrees), "key bigint, digest bigint, a int, b int, least bigint")
    places = repeated.join(hits, ["key", "digest"]).where("least < doc_id").select("rid", (F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("b") + (window - 1)).alias("b"))
    spans = places.groupBy("rid").agg(F.collect_list(F.struct("a", "b")).alias("spans"))

    def finish(batches):
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                out = []
                for z, own in zip(part.column("z"), part.column("spans"), strict=True):
                    raw = unpack(z.as_py())
                    data = np.frombuffer(raw, np.uint8)
                    starts, ends, _ = words(data, np.array([0, len(data)]), NOT_SPACE)
                    keep = np.ones(len(starts), bool)
                    if own.is_valid:
                        edges = own.values.flatten()
                        keep = ~covered(len(starts), edges[0].to_numpy(), edges[1].to_numpy())
                    kept = b" ".join([raw[x:y] for x, y in zip(starts[keep].tolist(), ends[keep].tolist(), strict=True)])
                    out.append((len(starts), int((~keep).sum()), sha256(kept), kept.decode()))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds))], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return compressed.join(spans, "rid", "left").select("doc_id", "z", "spans").mapInArrow(lean(finish), "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string")


def _batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)], names=["key", "digest", "n", "least", "text"])
