"""Near-duplicate embeddings by p-stable hashing and exact cosine checks.

Normalised vectors are projected on Gaussian directions, shifted and quantised; a cell
of ``FOLDS`` quantised projections is a bucket, and every vector lies in one bucket of
each of ``TABLES`` tables. Cosine 0.98 is a distance of 0.2: two such vectors share a
projection's cell with probability 0.90, a bucket with 0.35, and some bucket with
1 - 1e-6 at the threshold itself, more above it. Pairs of a bucket are checked exactly,
each in the first table that brings it together, and only counts and spanning edges
leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transqa.llm.buckets import BLOCK, blocked, gathered, run_bounds, runs
from transqa.llm.common import read, stored
from transqa.llm.graph import components

FOLDS, TABLES, CELL = 10, 32, 1.6
SMALL = 32      # runs up to this size are compared together


def near_embeddings(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Link vectors of one label whose cosine, in double precision, is at least ``threshold``.

    Returns one row per input row: id, n_links (other vectors linked directly),
    component_id (smallest id reachable, its own included) and kept (id =
    component_id). Vectors that are null, empty or zero, or hold a null or non-finite
    component, vectors without a label or an id, and vectors of different length
    link with nothing; a row without an id has a null component and is not kept.
    Rows that share an id stay separate vectors and count as each other's links.
    Extra columns are ignored; an empty table gives no rows.
    """
    e = F.col("v")
    usable = (
        F.col("id").isNotNull() & F.col("label").isNotNull() & e.isNotNull()
        & F.coalesce(F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
        & F.coalesce(F.exists(e, lambda x: x != 0), F.lit(False))
    )
    rows = stored(vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"),
        F.col(vector_col).cast("array<double>").alias("v")).withColumn("usable", usable), "vectors")
    # Equal vectors first: one stands for its copies, with their number as its weight.
    one = rows.where("usable").groupBy("label", "v").agg(
        F.min("id").alias("rep"), F.count("*").alias("weight"))
    hashed = stored(one.mapInArrow(
        _hash, one.schema.simpleString()[7:-1] + ", cells array<int>, key array<long>"), "hashed")
    keyed = hashed.withColumn("key", F.explode("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    sizes = stored(sizes, "sizes")
    dealt = blocked(
        keyed.join(sizes.select("key"), "key", "left_semi").select("key", "rep", "weight", "v", "cells"),
        sizes.where(F.col("n") > BLOCK), "key", F.xxhash64("rep", "v"))
    compare = _compare(threshold)
    found = stored(gathered(dealt, "key").select(
        "key", "block_a", "block_b", "block", "rep", "weight", "v", "cells").mapInArrow(
        compare, "id long, hub long, v array<double>, n long"), "found")
    counts = found.groupBy("id", "v").agg(F.sum("n").alias("n"))
    label = components(found.select(F.col("id").alias("a"), F.col("hub").alias("b")))
    classes = (
        one.join(counts.withColumnRenamed("id", "rep"), ["rep", "v"], "left")
        .join(label.withColumnRenamed("id", "rep"), "rep", "left")
        .select("label", "v", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("links"),
                F.coalesce("component", "rep").alias("component"))
    )
    return (
        rows.withColumn("v", F.when(F.col("usable"), F.col("v")))
        .join(classes, ["label", "v"], "left")
        .select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                F.coalesce("component", "id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
    )


def _directions(size: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.Generator(np.random.PCG64([11, size]))
    return random.normal(size=(size, FOLDS * TABLES)), random.uniform(0, CELL, FOLDS * TABLES)


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add each vector's cell per table, and the same cells keyed by table, label and length."""
    fold = np.random.Generator(np.random.PCG64(12)).integers(
        1, 2**62, (FOLDS, TABLES), dtype=np.int64) * 2 + 1
    for batch in batches:
        v, n = batch["v"], batch.num_rows
        length = v.value_lengths().to_numpy(zero_copy_only=False)
        cells = np.zeros((n, TABLES), np.int64)
        for size in np.unique(length):
            at = np.flatnonzero(length == size)
            unit = _unit(v.take(pa.array(at)), int(size))
            directions, shift = _directions(int(size))
            quantised = np.floor((unit @ directions + shift) / CELL).astype(np.int64)
            with np.errstate(over="ignore"):
                cells[at] = (quantised.reshape(len(at), FOLDS, TABLES) * fold).sum(1)
        cells = (cells >> 24).astype(np.int32)
        label = np.array([_text_hash(x) for x in batch["label"].to_pylist()], np.uint64)
        with np.errstate(over="ignore"):
            salt = (label * np.uint64(0x9E3779B97F4A7C15) + length.astype(np.uint64))[:, None] * np.uint64(
                0xBF58476D1CE4E5B9) + np.arange(TABLES, dtype=np.uint64)[None, :]
            salt = (salt ^ (salt >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            key = (salt + cells.astype(np.uint32).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)
        key = key // TABLES * TABLES + np.arange(TABLES)     # the table can be read off the key
        bounds = pa.array(np.arange(n + 1, dtype=np.int32) * TABLES)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.ListArray.from_arrays(bounds, pa.array(cells.ravel())),
             pa.ListArray.from_arrays(bounds, pa.array(key.ravel()))],
            [*batch.schema.names, "cells", "key"])


def _text_hash(value: object) -> int:
    import zlib

    text = str(value).encode()
    return zlib.crc32(text) | zlib.adler32(text) << 32


def _unit(v: pa.Array, size: int) -> np.ndarray:
    x = v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), size)
    # Scaling by the largest component first keeps very large and small vectors finite.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _compare(threshold: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "key"):
            table = table.combine_chunks()
            at = run_bounds(table, "key")
            v = table["v"].combine_chunks()
            length = v.value_lengths().to_numpy(zero_copy_only=False)
            rep, weight, block = (table[c].to_numpy() for c in ("rep", "weight", "block"))
            own = table["block_a"].to_numpy() == table["block_b"].to_numpy()
            first = table["key"].to_numpy() % TABLES
            cells = table["cells"].combine_chunks().flatten().to_numpy().reshape(-1, TABLES)
            pairs: list[tuple[np.ndarray, np.ndarray]] = []
            sizes = np.diff(at)
            unit = np.zeros((len(rep), int(length.max())))
            for size in np.unique(length):
                rows = np.flatnonzero(length == size)
                unit[rows, :size] = _unit(v.take(pa.array(rows)), int(size))
            end = np.repeat(at[1:], sizes)
            small = np.repeat(sizes <= SMALL, sizes)
            for step in range(1, min(SMALL, int(sizes.max()))):
                i = np.flatnonzero(small[:-step] & (np.arange(len(rep) - step) + step < end[:-step]))
                if not len(i):
                    break
                i = i[(own[i] | (block[i] != block[i + step])) & (length[i] == length[i + step])]
                near = np.einsum("ij,ij->i", unit[i], unit[i + step]) >= threshold
                pairs.append((i[near], i[near] + step))
            for lo, hi in zip(at[:-1][sizes > SMALL], at[1:][sizes > SMALL], strict=True):
                near = np.triu(unit[lo:hi] @ unit[lo:hi].T >= threshold, 1)
                near &= length[lo:hi, None] == length[None, lo:hi]
                if not own[lo]:
                    near &= block[lo:hi, None] != block[None, lo:hi]
                i, j = np.nonzero(near)
                pairs.append((i + lo, j + lo))
            i = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, np.int64)
            j = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, np.int64)
            if not len(i):
                continue
            hub = _hubs(i, j, rep)
            count = np.zeros(len(rep), np.int64)
            for lo in range(0, len(i), 1 << 18):
                a, b = i[lo:lo + (1 << 18)], j[lo:lo + (1 << 18)]
                # A pair counts in the first table that brings it together.
                new = (cells[a] == cells[b]).argmax(1) == first[a]
                np.add.at(count, a[new], weight[b[new]])
                np.add.at(count, b[new], weight[a[new]])
            out = np.unique(np.concatenate([i, j]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rep[out]), pa.array(hub[out]), v.take(pa.array(out)), pa.array(count[out])],
                ["id", "hub", "v", "n"])

    return compare


def _hubs(i: np.ndarray, j: np.ndarray, rep: np.ndarray) -> np.ndarray:
    """For each row the smallest id it reaches over the pairs (i, j)."""
    hub = rep.copy()
    while True:
        before = hub.copy()
        least = np.minimum(hub[i], hub[j])
        np.minimum.at(hub, i, least)
        np.minimum.at(hub, j, least)
        if (hub == before).all():
            return hub


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(read(spark, sf_dir, "embeddings"))


OP2_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98
), r AS (
  SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), c AS (SELECT a, min(b) AS b FROM r GROUP BY a), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(vec_id, coalesce(c.b, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(c.b, vec_id)) AS kept
FROM embeddings LEFT JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""
