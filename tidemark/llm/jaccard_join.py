"""N-gram Jaccard join: sets of word shingles, filtered under several global token orders.

Two sets with 100 * intersection >= percent * union share a token among each one's first n - ceil(n * percent / 100) + 1
tokens, under any order that all sets have in common. Two such orders are used, both rare tokens first. A share of all tokens, chosen by hash and
some times the share that a prefix takes, is counted exactly, over different sets; these come first in both orders, by their counts, and
the others after them, those last of which a sketch shows that they are very common (they would gather too many
sets in one task). The orders differ in how finely they take counts and in how ties go. Tokens that one set alone has fill prefixes but are
never sent on. A pair of the first order's small buckets must turn up under the second one as well before it is verified.

A bucket of more than a few sets never becomes pairs: its sets, by bands of like size, form a group around its
least member. A group's sets are first screened by their prefixes: a link takes as many common prefix tokens, under
either order, as the rests of the sets can't make up for. Those that may have a link meet in one task (in blocks, every block against every other, where a group is large), where
exact overlaps are counted through an inverted index, and come out as links to the group's least connected
member. Equal sets are one node. Components are the links' connected components.

Defined results: a text without words has 0 shingles and is its own component; one with fewer words than n has its whole
sequence as its only shingle; a null id counts as larger than any other, and is the component of
null ids only; repeated rows and ids are documents of their own.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._arrow import LOWER, NOT_SPACE, chunks, distinct, flat, gram_hashes, lean, mix, word_hashes, words
from ._groups import MEMBER, SMALL, blocked, buckets, meet, member_batch, pair_members, screen, small_pairs
from ._repeats import identified, packed, unpack
from ._sketch import heavy, places
from ._tables import free, stored
from .components import components

#: Make the orders, and the digests of sets, independent of each other.
_SALTS = (np.uint64(0x8EBC6AF09C88C6E3), np.uint64(0x589965CC75374CC3))
#: Choose the tokens that are counted, and the counters of very common ones.
_CHOICE, _COMMON = np.uint64(0x1D8E4E27C47D124F), np.uint64(0xEB44ACCAB455D165)
#: The share of tokens that are counted, by the share that a prefix takes; 1 / 2**COMMON of all counted ones is very common.
CHOSEN, COMMON = 2.5, 16


def shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the n-word shingles of every text, repeats included, and where each text's begin."""
    data = LOWER[data]
    starts, ends, first = words(data, offsets, NOT_SPACE)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    hashed = word_hashes(data, starts, ends)
    size = np.diff(first)
    count = np.where(size >= n, size - n + 1, np.minimum(size, 1))
    edges = np.concatenate(([0], np.cumsum(count)))
    begin = np.arange(edges[-1]) + np.repeat(first[:-1] - edges[:-1], count)
    grams = gram_hashes(hashed, n)
    out = grams[np.minimum(begin, len(grams) - 1)] if len(grams) else np.zeros(len(begin), np.uint64)
    for few in range(1, n):  # texts of fewer words are one shingle
        some = np.flatnonzero(size == few)
        if len(some):
            out[edges[some]] = gram_hashes(hashed, few)[first[some]]
    return out, edges


def sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): each text's distinct shingles, ascending, and where they begin."""
    return distinct(*shingles(data, offsets, n))


def _chosen(hashed: np.ndarray, percent: int) -> np.ndarray:
    """Which tokens are counted: a share of all, by their hashes."""
    share = min(1.0, max(1 / 64, CHOSEN * (100 - percent) / 100))
    return mix(hashed ^ _CHOICE) <= np.uint64(min((1 << 64) - 1, int(share * (1 << 64))))


def _least(keys: tuple, text: np.ndarray, take: np.ndarray) -> np.ndarray:
    """The indexes of each text's first take items by keys (the last one counts most), by text; text is ascending."""
    order = np.lexsort((*keys, text))
    edges = np.searchsorted(text, np.arange(len(take) + 1))
    return order[np.arange(len(text)) - edges[text] < take[text]]


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(values.view(np.int64)))


def _prefix(size: np.ndarray, percent: int) -> np.ndarray:
    """How many tokens of a set of that size hold one of any linked set's."""
    return np.where(size > 0, size - -(-size * percent // 100) + 1, 0)


def _heads(rows: DataFrame, common, n: int, percent: int) -> DataFrame:
    """(rid, doc_id, n, d1, d2, counted, tokens, first, second): size and digests of each set, the tokens that are to be counted, and
    those after them in both orders that a prefix may still need. Equal sets tell their tokens once for each task."""

    def run(batches):
        told: set[int] = set()
        for part in chunks(batches, limit=1 << 20):
            hashed, first = sets(*flat(part.column("text")), n)
            size = np.diff(first)
            text = np.repeat(np.arange(len(size)), size)
            full = np.flatnonzero(size)
            digests = []
            for salt in _SALTS:  # digests that don't depend on order
                sums = np.zeros(len(size), np.uint64)
                if len(full):
                    sums[full] = np.add.reduceat(mix(hashed + salt), first[full])
                digests.append(sums)
            often = common.value[places(hashed, _COMMON)]
            counted = _chosen(hashed, percent) & ~often
            n_counted = np.bincount(text[counted], minlength=len(size))
            new = np.zeros(len(size), bool)
            for i in full.tolist():
                d = int(digests[0][i])
                new[i] = d not in told
                told.add(d)
            tell = counted & new[text]
            short = np.maximum(_prefix(size, percent) - n_counted, 0)
            rest = np.flatnonzero(~counted & (short > 0)[text])
            others = [hashed[rest[_least((mix(hashed[rest] ^ salt), often[rest]), text[rest], short)]] for salt in _SALTS]
            have = np.minimum(short, size - n_counted)
            columns = [pa.array(size.astype(np.int32)), *(pa.array(x.view(np.int64)) for x in digests), pa.array(n_counted.astype(np.int32)), _lists(hashed[tell], np.bincount(text[tell], minlength=len(size))), *(_lists(x, have) for x in others)]
            yield pa.RecordBatch.from_arrays([part.column("rid"), part.column("doc_id"), *columns], names=["rid", "doc_id", "n", "d1", "d2", "counted", "tokens", "first", "second"])

    return rows.mapInArrow(lean(run), "rid bigint, doc_id bigint, n int, d1 bigint, d2 bigint, counted int, tokens array<bigint>, first array<bigint>, second array<bigint>")


def _prefixes(heads: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(rid, n, rest, first, second): of each set that may have a link, the size, the tokens after the prefix, and both orders' prefixes
    without those tokens that no other set has."""
    # no token that is counted holds more than a bounded share of all, so each one's sets meet in one task
    told = heads.select(F.explode("tokens").alias("token"), "d1").repartition("token").distinct()
    repeated = told.withColumn("m", F.count("*").over(Window.partitionBy("token"))).where("m > 1")
    # a number for both: the token's upper 56 bits, and its count by eighths of powers of two
    level = F.least(F.floor(F.log2("m") * 8), F.lit(255)).cast("bigint")
    lists = repeated.select("d1", F.col("token").bitwiseAND(F.lit(-256)).bitwiseOR(level).alias("token")).groupBy("d1").agg(F.collect_list("token").alias("found"))

    def run(batches):
        for batch in batches:
            size = batch.column("n").to_numpy().astype(np.int64)
            found = batch.column("found")
            own = pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            text = np.repeat(np.arange(len(size)), own)
            token = found.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            level = token & np.uint64(255)
            take = np.clip(_prefix(size, percent) - (batch.column("counted").to_numpy() - own), 0, own)
            lists = []
            for i, (salt, c) in enumerate(zip(_SALTS, ("first", "second"), strict=True)):
                rare = level if i == 0 else level >> np.uint64(3)  # the second order takes frequencies by powers of two
                chosen = token[_least((mix(token ^ salt), rare), text, take)]
                more = batch.column(c)
                size_of = pc.list_value_length(more).to_numpy(zero_copy_only=False).astype(np.int64)
                both = np.concatenate((chosen, more.flatten().to_numpy(zero_copy_only=False).view(np.uint64)))
                of = np.concatenate((np.repeat(np.arange(len(size)), take), np.repeat(np.arange(len(size)), size_of)))
                lists.append(_lists(both[np.argsort(of, kind="stable")], take + size_of))
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("n"), pa.array((size - _prefix(size, percent)).astype(np.int32)), *lists], names=["rid", "n", "rest", "first", "second"])

    joined = reps.join(lists, "d1", "left").select("rid", "n", "counted", "first", "second", "found")
    return joined.mapInArrow(lean(run), "rid bigint, n int, rest int, first array<bigint>, second array<bigint>").where((F.size("first") > 0) & (F.size("second") > 0))


def _components(rows: DataFrame, n: int, percent: int) -> DataFrame:
    """(rid, doc_id, n, root, links) of (rid, doc_id, text); root: the same for all of a component."""
    spark = rows.sparkSession

    def counted(part):
        hashed = shingles(*flat(part.column("text")), n)[0]
        return hashed[_chosen(hashed, percent)]

    common = spark.sparkContext.broadcast(heavy(rows.select("text"), counted, _COMMON, 1 << 20, COMMON))
    heads = stored(_heads(rows, common, n, percent), "sets")
    # equal sets are one node: their least rid (aggregated before the shuffle, joined back with hot classes split)
    classes = heads.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("rid").alias("rep"))
    own = heads.where("n > 0").select("rid", "doc_id", "n", "d1", "d2").join(classes, ["n", "d1", "d2"]).select("rid", "doc_id", "n", "rep")
    nodes = stored(own.unionByName(heads.where("n = 0").select("rid", "doc_id", "n", F.col("rid").alias("rep"))), "nodes")
    reps = heads.where("n > 0").drop("tokens").join(nodes.where("rep = rid").select("rid"), "rid", "left_semi")
    prefixes = stored(_prefixes(heads, reps, percent), "prefixes", after=(heads,))
    common.destroy()
    first, second = (buckets(prefixes.select(F.explode(c).alias("token"), "rid", "n")) for c in ("first", "second"))
    # small buckets: pairs that both orders admit; a pair may meet in a large bucket of the second order instead
    crowd = second.where(F.col("m") > SMALL).select("rid").distinct()
    admitted = small_pairs(second, percent).withColumn("seen", F.lit(True))
    pairs = small_pairs(first, percent).join(admitted, ["a", "b"], "left")
    pairs = pairs.join(crowd.select(F.col("rid").alias("a"), F.lit(True).alias("ca")), "a", "left").join(crowd.select(F.col("rid").alias("b"), F.lit(True).alias("cb")), "b", "left")
    pairs = pairs.where("seen or (ca and cb)").select("a", "b")
    near = pair_members(pairs)
    # large buckets: sets of like size around the least one
    width = math.log(100 / percent) * 1.0001
    # where links need equal sizes, the size is the band
    band = F.floor(F.log("n") / F.lit(width)).cast("int") if percent < 100 else F.col("n")
    large = first.where(F.col("m") > SMALL).select("token", "rid", F.explode(F.array(band, band + 1)).alias("band"))
    large = large.join(large.groupBy("token", "band").agg(F.min("rid").alias("lead"), F.count("*").alias("own")).where("own > 1"), ["token", "band"])
    members = near.union(large.select("lead", "band", "rid")).distinct()
    members = stored(members.join(prefixes.select("rid", "n"), "rid"), "members", after=(first, second))
    screened = blocked(members).join(prefixes, "rid").select("g.*", "rid", "n", "rest", "first", "second")
    members = stored(screen(screened, percent), "screened", after=(members, prefixes))
    wanted = members.groupBy("rid").agg(F.collect_list("g").alias("groups"))

    def fetch(batches):
        for batch in batches:
            out = []
            for rid, z, groups in zip(batch.column("rid").to_pylist(), batch.column("z").to_pylist(), batch.column("groups").to_pylist(), strict=True):
                for g in groups:
                    out.append((g["lead"], g["band"], g["low"], g["high"], g["block"], rid, z))  # shorter than its tokens
                    if len(out) >= 512:
                        yield member_batch(out)
                        out = []
            if out:
                yield member_batch(out)

    def read(raw: list[bytes]) -> list[np.ndarray]:
        hashed, first = sets(*flat(pa.array([unpack(z) for z in raw], pa.large_binary())), n)
        return [hashed[a:b].copy() for a, b in zip(first, first[1:], strict=False)]

    # both sides grow with the corpus, so neither is ever broadcast
    gathered = packed(rows).join(wanted.hint("merge"), "rid").select("rid", "z", "groups").mapInArrow(lean(fetch), MEMBER)

    links = stored(meet(gathered, percent, read), "links", after=(members,))
    roots = components(links)
    degree = links.select("a").union(links.select("b")).groupBy("a").agg(F.count("*").alias("links")).withColumnRenamed("a", "node")
    found = nodes.join(roots.join(degree, "node").withColumnRenamed("node", "rep"), "rep", "left")
    return found.select("rid", "doc_id", "n", F.coalesce("root", "rep").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))


def link(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and n_links of every text.

    component_id is the least doc_id that links lead to; n_links counts the links found to other sets of the
    component (a spanning set of them, not each one) and is at least 1 exactly where there is any.
    """
    found = _components(identified(docs, id_col, text_col), n, percent)
    least = found.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("size"))
    # components of one document need no join
    found = found.join(least.where("size > 1"), "root", "left")
    component = F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), component.alias("component_id"), F.col("links").alias("n_links"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns as they are, of which each component's first (by id) stays."""
    rows = identified(docs, id_col, text_col, carry=True)
    found = _components(rows.select("rid", "doc_id", "text"), n, percent)
    first = found.groupBy("root").agg(F.min("rid").alias("rid")).select("rid")
    kept = packed(rows.select("rid", "row", "text")).join(first, "rid", "left_semi").select("row", "z")

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                values = [None if z is None else unpack(z).decode() for z in part.column("z").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(values, pa.string())], names=["row", "kept"])

    out = kept.mapInArrow(lean(run), T.StructType([kept.schema["row"], T.StructField("kept", T.StringType())]))
    return out.select(*(F.col("kept").cast(docs.schema[c].dataType).alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns))
