"""Exact top-k search over binary codes by incremental multi-index hashing.

A code's bits are the signs of fixed random projections of its vector. Codes are cut into segments of about log2 of
the number of distinct codes; the index has an entry for each segment's value. Searching every segment to radius t finds all codes
within distance segments * (t + 1) - 1, so t grows, for those queries alone whose kth verified distance isn't
covered yet, until it is. Equal codes are one entry with its least ids (more than k are never needed), equal queries
are one query. A bucket of many codes is split into chunks, and its probes go to each of them; a probe names a bucket, in which all values at
the radius are looked up. Queries whose rounds would look at more than half as many codes as there are, as those for long codes
without clusters would, are held against all codes instead, which is as exact.

Codes can have any number of bits; the order of neighbours is that of the vectors only as far as the codes tell it, and
more bits tell more.

Ties go to the lesser id; a query is not its own neighbour, nor are rows of the same id. Defined results: null
vectors, vectors with nulls or of another length than the commonest (of equally common ones the greatest), and null ids are neither found nor searched for; fewer than
k others give fewer rows; repeated rows count once.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._arrow import bounded, flat, lean
from ._tables import stored

#: Bits that name a bucket of a segment's values, and codes of a bucket's chunk.
BUCKET_BITS, CHUNK = 8, 1 << 16
#: Share of the codes that a query's rounds may look at; pairs that a task compares at once; codes that are worth a chunk of their own.
SHARE, PAIRS, LEAST_CHUNK = 0.5, 1 << 20, 1 << 10


def _binary(words: np.ndarray) -> pa.Array:
    """Rows of 64-bit words as binary values."""
    n, size = words.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * 8 * size).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(words))])


def _words(column: pa.Array, bits: int) -> np.ndarray:
    return np.frombuffer(flat(column)[0].tobytes(), "<u8").reshape(len(column), -(-bits // 64))


def _encoded(vectors: DataFrame, bits: int, id_col: str, vector_col: str, seed: int, number: bool) -> DataFrame:
    """(id, code) of the rows that have both; code: a number or a binary value."""
    bounded(vectors.sparkSession)
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x)))
    # the commonest length, and of equally common ones the greatest
    common = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = common["size"] if common else 0
    rows = rows.where(F.size("v") == size)
    planes = np.random.default_rng(seed).normal(size=(max(size, 0), bits))
    kind = "bigint" if number else "binary"

    def run(batches):
        for batch in batches:
            values = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            code = np.zeros((len(batch), -(-bits // 64) * 8), np.uint8)
            code[:, : -(-bits // 8)] = np.packbits(values @ planes > 0, axis=1, bitorder="little")
            words = code.view("<u8")
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(words[:, 0].view(np.int64)) if number else _binary(words)], names=["id", "code"])

    return rows.mapInArrow(lean(run), f"id bigint, code {kind}").distinct() if size > 0 else rows.select("id", F.lit(None).cast(kind).alias("code")).limit(0)


def encode(vectors: DataFrame, bits: int = 32, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 17) -> DataFrame:
    """(id, code) of the rows that have both; a code is a number up to 64 bits, and beyond them the bytes of little-endian 64-bit words."""
    return _encoded(vectors, bits, id_col, vector_col, seed, bits <= 64)


def cuts(bits: int, n: int) -> list[tuple[int, int]]:
    """(shift, width) of segments of about log2(n) bits."""
    count = max(1, round(bits / max(1.0, math.log2(max(2, n)))))
    edges = [round(i * bits / count) for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def masks(width: int, radius: int) -> list[int]:
    """All values of that many bits set among width."""
    return [sum(1 << i for i in chosen) for chosen in itertools.combinations(range(width), radius)]


def furthest(segments: list[tuple[int, int]]) -> int:
    """The last radius up to which a query's rounds look at no more than SHARE of evenly spread codes; -1: none."""
    radius, share = -1, 0.0
    while radius < max(c[1] for c in segments):
        share += sum(math.comb(w, radius + 1) / 2**w for _, w in segments)
        if share > SHARE:
            break
        radius += 1
    return radius


def _segment(words: np.ndarray, cut: tuple[int, int]) -> np.ndarray:
    """Each code's value in a segment, wherever it lies in the words."""
    shift, width = cut
    at, off = divmod(shift, 64)
    value = words[:, at] >> np.uint64(off)
    if off + width > 64:
        value = value | words[:, at + 1] << np.uint64(64 - off)
    return (value & np.uint64((1 << width) - 1)).astype(np.int64)


def _low(cut: tuple[int, int]) -> int:
    """The bits of a segment that don't name its bucket."""
    return max(0, cut[1] - BUCKET_BITS)


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int32)


def _best(query: np.ndarray, at: np.ndarray, distance: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k + 1 best of each query number's pairs."""
    order = np.lexsort((least[at], distance, query))
    at, query, distance = at[order], query[order], distance[order]
    begin = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1]))) if len(query) else np.zeros(0, np.int64)
    rank = np.arange(len(query)) - np.repeat(begin, np.diff(np.append(begin, len(query))))
    return query[rank <= k], at[rank <= k], distance[rank <= k]


def nearest(places: np.ndarray, codes: np.ndarray, least: np.ndarray, values: np.ndarray, numbers: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int):
    """(query number, code number, distance): the best k + 1 codes at each query's places, none beyond its bound, in parts of bounded size.

    places are ascending; values holds the places looked up, numbers whose they are.
    """
    a, b = np.searchsorted(places, values, side="left"), np.searchsorted(places, values, side="right")
    hit = np.flatnonzero(b > a)
    a, size, numbers = a[hit], (b - a)[hit], numbers[hit]
    part = (np.cumsum(size) - 1) // PAIRS
    for i, j in itertools.pairwise(np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [len(part)])) if len(part) else []):
        n = size[i:j]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a[i:j], n)
        query = np.repeat(numbers[i:j], n)
        distance = _distance(queries[query], codes[at])
        near = distance <= bounds[query]
        yield _best(query[near], at[near], distance[near], least, k)


def scanned(codes: np.ndarray, least: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int):
    """As nearest(), of all codes."""
    step = max(1, PAIRS // len(codes))
    for i in range(0, len(queries), step):
        distance = np.zeros((len(queries[i : i + step]), len(codes)), np.int32)
        for word in range(codes.shape[1]):
            distance += np.bitwise_count(queries[i : i + step, word, None] ^ codes[None, :, word])
        edge = bounds[i : i + step]
        if len(codes) > k:
            edge = np.minimum(edge, np.partition(distance, k, axis=1)[:, k])
        query, at = np.nonzero(distance <= edge[:, None])
        yield _best(query + i, at, distance[query, at], least, k)


PLACE = ("segment", "bucket", "chunk")
_FOUND = "query binary, code binary, distance int, least bigint, count int"


def _meeting(segments: list[tuple[int, int]], bits: int, k: int, radius: int):
    """Rows come by place, its codes first; then its probes stream by. Segment -1 holds all codes."""

    def probe(own, held, queries, bounds):
        codes, least, values = held
        if own[0] < 0:
            yield from scanned(codes, least, queries, bounds, k)
            return
        cut = segments[own[0]]
        low = _low(cut)
        asked = _segment(queries, cut)
        apart = np.bitwise_count((asked >> low) ^ own[1])
        for d in np.unique(apart):
            flips = np.array(masks(low, radius - int(d)), np.int64)
            some = np.flatnonzero(apart == d)
            looked = (own[1] << low) | ((asked[some] & ((1 << low) - 1))[:, None] ^ flips[None])
            yield from nearest(values, codes, least, looked.ravel(), np.repeat(some, len(flips)), queries, bounds, k)

    def meet(batches):
        key, held, ready, counts = None, [], None, None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in (*PLACE, "kind")])
            codes, least, count = _words(batch.column("code"), bits), *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("least", "count"))
            edges = np.concatenate(([0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, [len(batch)]))
            for a, b in itertools.pairwise(edges):
                own = tuple(int(x) for x in keys[:3, a])
                if own != key:
                    key, held, ready = own, [], None
                if keys[3, a] == 0:
                    held.append((codes[a:b], least[a:b], count[a:b]))
                    continue
                if ready is None and held:
                    joined = [np.concatenate(c) for c in zip(*held, strict=True)]
                    values = _segment(joined[0], segments[own[0]]) if own[0] >= 0 else np.zeros(len(joined[0]), np.int64)
                    order = np.argsort(values, kind="stable")
                    ready, counts = (joined[0][order], joined[1][order], values[order]), joined[2][order]
                if ready is not None:
                    for query, at, distance in probe(own, ready, codes[a:b], least[a:b]):
                        columns = [_binary(codes[a:b][query]), _binary(ready[0][at]), pa.array(distance.astype(np.int32)), pa.array(ready[1][at]), pa.array(counts[at].astype(np.int32))]
                        yield pa.RecordBatch.from_arrays(columns, names=["query", "code", "distance", "least", "count"])

    return meet


def _entries(index: DataFrame, segments: list[tuple[int, int]], bits: int) -> DataFrame:
    """(segment, bucket, code, least, count): each code in each segment."""

    def run(batches):
        for batch in batches:
            words = _words(batch.column("code"), bits)
            for i, cut in enumerate(segments):
                columns = [pa.array(np.full(len(batch), i, np.int32)), pa.array((_segment(words, cut) >> _low(cut)).astype(np.int32)), *(batch.column(c) for c in ("code", "least", "count"))]
                yield pa.RecordBatch.from_arrays(columns, names=["segment", "bucket", "code", "least", "count"])

    return index.select("code", "least", "count").mapInArrow(lean(run), "segment int, bucket int, code binary, least bigint, count int")


def _probes(state: DataFrame, segments: list[tuple[int, int]], bits: int, radius: int) -> DataFrame:
    """(segment, bucket, code, least) of (query, bound): the buckets that have values at the radius; least is the bound."""

    def run(batches):
        for batch in batches:
            words = _words(batch.column("query"), bits)
            for i, cut in enumerate(segments):
                low = _low(cut)
                own = _segment(words, cut) >> low
                for flip in (m for d in range(max(0, radius - low), min(radius, cut[1] - low) + 1) for m in masks(cut[1] - low, d)):
                    columns = [pa.array(np.full(len(batch), i, np.int32)), pa.array((own ^ flip).astype(np.int32)), batch.column("query"), batch.column("bound").cast(pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["segment", "bucket", "code", "least"])

    return state.select("query", "bound").mapInArrow(lean(run), "segment int, bucket int, code binary, least bigint")


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, bits: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, neighbor_id, distance and rank (from 1) of every query's k nearest others; queries: (id_col) or any table with it."""
    spark = vectors.sparkSession
    rows = stored(_encoded(vectors, bits, id_col, vector_col, 17, False), "codes")
    # of each code the k + 1 least ids are enough, and Spark drops the others before the shuffle
    first = rows.withColumn("place", F.row_number().over(Window.partitionBy("code").orderBy("id"))).where(F.col("place") <= k + 1)
    index = stored(first.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")).select("code", "ids", F.col("ids")[0].alias("least"), F.size("ids").alias("count")), "index")
    total = index.count()
    segments = cuts(bits, total)
    last = furthest(segments)
    asked = rows.join(queries.select(F.col(f"`{id_col}`").cast("bigint").alias("id")).distinct(), "id")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def met(placed, probes, radius):
        both = placed.unionByName(probes.select(*PLACE, F.lit(1).alias("kind"), "code", "least", F.lit(0).alias("count")))
        return both.repartition(parts, *PLACE).sortWithinPartitions(*PLACE, "kind").mapInArrow(lean(_meeting(segments, bits, k, radius)), _FOUND)

    def top(found, name):
        ranked = found.distinct().withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy("distance", "least"))).where(F.col("place") <= k + 1)
        return stored(ranked.drop("place"), name)

    # state: (query, best, bound); best: the k + 1 best codes so far, bound: no code beyond it can matter
    state = stored(asked.select(F.col("code").alias("query")).distinct().select("query", F.lit(bits).alias("bound")), "queries")
    best, done, left = None, None, [state] if last < 0 else []
    if last >= 0:
        entries = _entries(index, segments, bits)
        sizes = stored(entries.groupBy("segment", "bucket").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")), "buckets")
        placed = entries.join(sizes, ["segment", "bucket"]).select("segment", "bucket", F.pmod(F.xxhash64("code"), F.col("chunks")).cast("int").alias("chunk"), F.lit(0).alias("kind"), "code", "least", "count")
    for radius in range(last + 1):
        # probes of empty buckets end here; those of split ones go to every chunk; sizes has at most 2 ** BUCKET_BITS rows a segment
        probes = _probes(state, segments, bits, radius).join(F.broadcast(sizes), ["segment", "bucket"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        found = met(placed, probes, radius)
        best = top(found if best is None else found.unionByName(best), "best")
        covered = len(segments) * (radius + 1) - 1
        over = radius >= max(c[1] for c in segments)
        # the distance at which the verified codes have k + 1 ids, the query's own among them
        reached = best.withColumn("have", F.sum("count").over(Window.partitionBy("query").orderBy("distance", "least"))).where(F.col("have") > k).groupBy("query").agg(F.min("distance").alias("kth"))
        status = state.join(reached, "query", "left").select("query", F.coalesce("kth", F.lit(bits)).alias("bound"), (F.lit(over) | F.coalesce(F.col("kth") <= covered, F.lit(False))).alias("settled"), F.col("kth").isNotNull().alias("known"))
        status = stored(status, "status")
        settled = best.join(status.where("settled").select("query"), "query", "left_semi")
        done = settled if done is None else done.unionByName(settled)
        # the rounds still to come can't pay for those whose distance needs a radius beyond the last one
        far = F.lit(radius == last) | (F.col("known") & (F.col("bound") > len(segments) * (last + 1) - 1))
        left.append(status.where(~F.col("settled") & far).select("query", "bound"))
        state = status.where(~F.col("settled") & ~far).select("query", "bound")
        if state.limit(1).count() == 0:
            break
        best = best.join(state.select("query"), "query", "left_semi")
    rest = left[0]
    for more in left[1:]:
        rest = rest.unionByName(more)
    if rest.limit(1).count():
        chunks = max(1, -(-total // CHUNK), min(parts, -(-total // LEAST_CHUNK)))
        place = (F.lit(-1).alias("segment"), F.lit(0).alias("bucket"))
        codes = index.select(*place, F.pmod(F.xxhash64("code"), F.lit(chunks)).cast("int").alias("chunk"), F.lit(0).alias("kind"), "code", "least", "count")
        probes = rest.select(*place, F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), F.col("query").alias("code"), F.col("bound").cast("bigint").alias("least"))
        found = top(met(codes, probes, 0), "scanned")
        done = found if done is None else done.unionByName(found)
    if done is None:
        return asked.select(F.col("id").alias("vec_id"), F.col("id").alias("neighbor_id"), F.lit(0).alias("distance"), F.lit(1).alias("rank")).limit(0)
    listed = done.join(index.select("code", "ids"), "code").select("query", "distance", F.explode("ids").alias("neighbor_id"))
    # of equal queries each one leaves out itself
    listed = asked.select("id", F.col("code").alias("query")).join(listed, "query").where("neighbor_id != id").groupBy("id", "neighbor_id").agg(F.min("distance").alias("distance"))
    ranked = listed.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy("distance", "neighbor_id"))).where(F.col("rank") <= k)
    return ranked.select(F.col("id").alias("vec_id"), "neighbor_id", "distance", "rank")
