"""Comparing the members of buckets with bounded tasks, however large a bucket is."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one side of a comparison that a task holds at once.
BLOCK = 1024


def blocked(rows: DataFrame, sizes: DataFrame, key: str, member: Column, block: int = BLOCK) -> DataFrame:
    """Deal the rows of large buckets to pairs of blocks, so that any two meet exactly once
    or, if they share a block, in the meeting of that block with itself.

    ``sizes`` has (key, n) for buckets of more than ``block`` rows. Adds ``block_a`` <=
    ``block_b`` and ``block``, the row's own; the other buckets keep one block.
    """
    parts = F.coalesce(F.ceil(F.col("n") / block).cast("int"), F.lit(1))
    own = F.pmod(F.xxhash64(member, F.lit(77)), F.col("parts")).cast("int")
    return (
        rows.join(sizes, key, "left").withColumn("parts", parts).withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("block_a", F.least("block", "other"))
        .withColumn("block_b", F.greatest("block", "other"))
        .drop("n", "parts", "other")
    )


def gathered(rows: DataFrame, key: str) -> DataFrame:
    """Bring the rows of each pair of blocks together, in order."""
    at = [key, "block_a", "block_b"]
    return rows.repartition(*at).sortWithinPartitions(*at)


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Cut a stream of ``gathered`` rows into tables of whole runs; a table holds many
    small runs or one large one."""
    at, held, weight = [key, "block_a", "block_b"], [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        weight += batch.num_rows
        if weight < 4 * BLOCK:
            continue
        table = pa.Table.from_batches(held)
        last = [table[c][-1].as_py() for c in at]
        first = [table[c][0].as_py() for c in at]
        if first == last:
            continue
        cut = table.num_rows
        low, high = 0, table.num_rows - 1      # the first row of the last run
        while low < high:
            mid = (low + high) // 2
            if [table[c][mid].as_py() for c in at] == last:
                high = mid
            else:
                low = mid + 1
        cut = low
        yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
        weight = table.num_rows - cut
    if held:
        yield pa.Table.from_batches(held)


def run_bounds(table: pa.Table, key: str):
    """Row numbers at which runs begin, and the end."""
    import numpy as np

    change = np.zeros(table.num_rows + 1, bool)
    change[[0, -1]] = True
    for c in (key, "block_a", "block_b"):
        v = table[c].to_numpy()
        change[1:-1] |= v[1:] != v[:-1]
    return np.flatnonzero(change)
