"""Which hashed items hold a large share of a whole table, by counters of a fixed number."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._arrow import chunks, lean, mix
from ._tables import free, stored

#: Counters, and the count below which no item is heavy.
SIZE, LEAST = 1 << 20, 1000


def places(hashed: np.ndarray, salt: np.uint64) -> np.ndarray:
    """Each hash's counter."""
    return (mix(hashed ^ salt) >> np.uint64(44)).astype(np.int64)


def heavy(rows: DataFrame, items: Callable[[pa.RecordBatch], np.ndarray], salt: np.uint64, limit: int, shift: int, least: int = LEAST) -> np.ndarray:
    """Flags of the counters whose items are 1 / 2**shift of all, and least, or more; items gives the hashes of chunks of a table with a text column.

    A task tells only those of its counters that hold half that share of what it has seen, and a few items at least: few counters, and of
    an item with the full share about half of its count. So half a share is enough to be flagged. Which are flagged settles no result.
    """

    few = max(1, least // 125)

    def count(batches):
        total = np.zeros(SIZE, np.int64)
        for part in chunks(batches, limit=limit):
            total += np.bincount(places(items(part), salt), minlength=SIZE)
        own = np.flatnonzero(total >= max(few, int(total.sum()) >> (shift + 1)))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(own, -1).astype(np.int32)), pa.array(np.append(total[own], total.sum()))], names=["place", "n"])

    found = stored(rows.mapInArrow(lean(count), "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n")), "heavy")
    total = found.where("place = -1").first()
    out = np.zeros(SIZE, bool)
    if total:
        # of all counters no more than 2 ** (shift + 1) can hold so much
        out[[r.place for r in found.where((F.col("place") >= 0) & (F.col("n") >= max(least, total.n >> shift) // 2)).collect()]] = True
    free(found)
    return out
