"""Exact similarity links from buckets of sets, without pairs of large buckets.

A small bucket becomes pairs; the sets of a larger one become the group of its least member. The members of a group meet in
one task, or, where a group is large, in blocks of bounded size, every block against every other;
there an inverted index counts overlaps, and links come out as each set's link to the least one that it is connected with.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._arrow import lean
from ._tables import stored

#: Sets of a bucket that still becomes pairs; tokens of a block.
SMALL, BLOCK = 8, 1 << 22
MEMBER = "lead bigint, band int, low int, high int, block int, rid bigint, tokens binary"


def buckets(postings: DataFrame) -> DataFrame:
    """(token, rid, n, m) of (token, rid, n): those of tokens that m > 1 sets have."""
    # counts are summed before the shuffle, and the join splits hot tokens
    counts = postings.groupBy("token").agg(F.count("*").alias("m")).where("m > 1")
    return stored(postings.join(counts, "token"), "postings")


def small_pairs(postings: DataFrame, percent: int = 0) -> DataFrame:
    """Distinct (a, b), a < b, of small buckets; with percent, those whose sizes allow a link."""
    few = postings.where(F.col("m") <= SMALL).groupBy("token").agg(F.array_sort(F.collect_list(F.struct("rid", "n"))).alias("x"))
    pairs = few.select(F.explode(F.flatten(F.transform("x", lambda p, i: F.transform(F.slice("x", i + 2, SMALL), lambda q: F.struct(p["rid"].alias("a"), q["rid"].alias("b"), p["n"].alias("na"), q["n"].alias("nb")))))).alias("p")).select("p.*")
    return pairs.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b").distinct()


def pair_members(pairs: DataFrame) -> DataFrame:
    """(lead, band, rid): pairs as groups of their lesser members."""
    return pairs.select(F.col("a").alias("lead"), F.lit(-1).alias("band"), F.col("b").alias("rid")).union(pairs.select("a", F.lit(-1), "a"))


def blocked(members: DataFrame) -> DataFrame:
    """(rid, g) of (lead, band, rid, n): each place at which a set meets others of its group."""
    blocks = members.groupBy("lead", "band").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"))
    members = members.join(blocks, ["lead", "band"]).withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    members = members.select("lead", "band", "rid", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    return members.select("rid", F.struct("lead", "band", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block").alias("g"))


PLACE = ("lead", "band", "low", "high")
#: Rows of a batch that goes back from a task.
_OUT = 8192


def _groups(batches, columns):
    """(place, rows) of sorted batches; columns gives a batch's other columns, row by row. A group is done when the next begins."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in PLACE), *columns(batch), strict=True):
            if row[:4] != key and held:
                yield key, held
                held = []
            key = row[:4]
            held.append(row[4:])
    if held:
        yield key, held


def _batched(rows, kinds: dict):
    """Batches of many rows each, of an iterator of lists of rows."""
    out: list[tuple] = []
    for more in itertools.chain(rows, [None]):
        out += more or ()
        if len(out) >= _OUT or more is None and out:
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds.values())], names=list(kinds))
            out = []


def screen(gathered: DataFrame, percent: int) -> DataFrame:
    """(rid, g) of the places at which a set may have a link, of rows with n, both orders' prefixes (first, second; tokens that no other set has
    may be left out), and the number of tokens after them (rest).

    Tokens before the last one of the prefix that ends earlier in the order can only meet in both prefixes. So a link needs as many
    common prefix tokens as the rest of the larger set can't make up for, under either order.
    """
    def columns(batch):
        lists = []
        for c in ("first", "second"):
            column = batch.column(c)
            ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            lists.append([np.sort(values[a:b].view(np.uint64)) for a, b in zip(ends, ends[1:], strict=False)])
        return *(batch.column(c).to_pylist() for c in ("block", "rid", "n", "rest")), *lists

    def run(batches):
        yield from _batched((_screened(held, key, percent) for key, held in _groups(batches, columns)), dict.fromkeys(PLACE, pa.int32()) | {"lead": pa.int64(), "block": pa.int32(), "rid": pa.int64()})

    parts = int(gathered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = gathered.repartition(parts, *PLACE).sortWithinPartitions(*PLACE, "rid").mapInArrow(lean(run), "lead bigint, band int, low int, high int, block int, rid bigint")
    return rows.select("rid", F.struct(*PLACE, "block").alias("g"))


def _screened(held: list[tuple], key: tuple, percent: int) -> list[tuple]:
    """Rows (place, block, rid) of a group's sets that may have a link."""
    inner = key[2] == key[3]
    probes = [i for i, x in enumerate(held) if inner or x[0] == key[2]]
    members = probes if inner else [i for i, x in enumerate(held) if x[0] == key[3]]
    size = np.array([x[2] for x in held])
    rest = np.array([x[3] for x in held])
    alive = np.zeros(len(held), bool)
    # the second order is asked only for sets that the first one leaves
    for p, common in zip(probes, overlaps([held[i][4] for i in members], [held[i][4] for i in probes]), strict=True):
        need = -(-percent * (size[p] + size[members]) // (100 + percent)) - np.maximum(rest[p], rest[members])
        near = np.flatnonzero(common >= np.maximum(need, 1))
        for j in near:
            m = members[j]
            if m != p and not (alive[p] and alive[m]):
                both = len(np.intersect1d(held[p][5], held[m][5], assume_unique=True))
                if both >= max(1, need[j]):
                    alive[[p, m]] = True
    return [(*key, held[i][0], held[i][1]) for i in np.flatnonzero(alive).tolist()]


def meet(gathered: DataFrame, percent: int, read) -> DataFrame:
    """(a, b): links of MEMBER rows whose sets share percent of their union or more; read makes sets of what ``tokens`` holds."""

    def columns(batch):
        return *(batch.column(c).to_pylist() for c in ("block", "rid")), read(batch.column("tokens").to_pylist())

    def run(batches):
        yield from _batched((_linked(held, key, percent) for key, held in _groups(batches, columns)), {"a": pa.int64(), "b": pa.int64()})

    parts = int(gathered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return gathered.repartition(parts, *PLACE).sortWithinPartitions(*PLACE, "rid").mapInArrow(lean(run), "a bigint, b bigint")


def overlaps(members: list[np.ndarray], probes: list[np.ndarray]):
    """For each probe, its numbers of common tokens with all members (both: distinct tokens, ascending)."""
    if len(members) <= 6:
        for probe in probes:
            yield np.array([len(probe) if m is probe else len(np.intersect1d(probe, m, assume_unique=True)) for m in members])
        return
    tokens = np.concatenate(members) if members else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(members)), [len(m) for m in members])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    for probe in probes:
        a, b = np.searchsorted(tokens, probe, side="left"), np.searchsorted(tokens, probe, side="right")
        size = b - a
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(a, size)
        yield np.bincount(owner[at], minlength=len(members))


def _linked(held: list[tuple], key: tuple, percent: int) -> list[tuple]:
    """Links of a group's sets, as each one's link to the least set that it is connected with here."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    def probe(members, some):
        """Links members with those of some that are near; says which of them had one."""
        sizes, linked = np.array([len(t) for _, t in members]), set()
        for (rid, tokens), common in zip(some, overlaps([t for _, t in members], [t for _, t in some]), strict=True):
            for i in np.flatnonzero(100 * common >= percent * (sizes + len(tokens) - common)):
                other = members[i][0]
                linked.add(other)
                a, b = root(rid), root(other)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        return linked

    sets = [(r, t) for _, r, t in held]
    if key[2] != key[3]:
        probe([(r, t) for block, r, t in held if block == key[3]], [(r, t) for block, r, t in held if block == key[2]])
    else:
        # one set against all: those that it links with are one component; every other one is held against all as well
        near = probe(sets, sets[:1])
        if rest := [x for x in sets[1:] if x[0] not in near]:
            probe(sets, rest)
    return [(x, root(x)) for x in sorted(parent) if root(x) != x]


def member_batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)], names=["lead", "band", "low", "high", "block", "rid", "tokens"])
