"""Near-duplicate documents by MinHash signatures and a multi-index Hamming join.

A signature is ``SYMBOLS`` minima of 16 bits each; the share of places in which two
signatures differ estimates 1 - Jaccard. The signature is split into ``CHUNKS`` of
four. Two signatures that differ in at most ``DISTANCE`` = 2 * CHUNKS - 1 places must,
by the pigeonhole principle, have a chunk with at most one error, so they share a
chunk with one place left out: the index holds every chunk with each of its places
left out, and finds *all* pairs within that distance. At Jaccard 0.8 a pair lies
beyond it with probability about 1e-6. Where groups stay apart in a shared bucket, pairs must
also agree in a sketch of ``BITS`` one-bit minima, which a pair at the limit fails with
probability about 1e-6. Pairs found are confirmed on full shingle sets: those with a bucket's
smallest member by join, those between groups that stay apart where clusters of near groups meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transqa.llm import shingles as sh
from transqa.llm.buckets import BLOCK, blocked, gathered, run_bounds, runs
from transqa.llm.common import read, stored
from transqa.llm.graph import components

CHUNKS, WIDTH = 12, 4
SYMBOLS = CHUNKS * WIDTH
DISTANCE = 2 * CHUNKS - 1
SIMILARITY = 80     # per cent
BITS = 2048
NUMBER = 48         # a key's bits above this number its bucket


def near_duplicates(docs: DataFrame, words: int = 5, per_cent: int = SIMILARITY,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Group documents whose shingle sets are similar, directly or through others.

    A document's set holds its distinct windows of ``words`` words, A-Z lower-cased, of
    the whole text; a shorter text is one window. Two documents link when
    100 * |A and B| >= per_cent * |A or B|.

    Returns one row per input row: id, n_shingles, component_id (smallest id reachable,
    its own included) and kept (id = component_id). Null and wordless texts have
    an empty set and link with nothing. Rows without an id are returned with a null
    component and kept false, and link nothing. Rows that share an id count as one
    document. Copies, ties and extra columns make no difference; an empty table gives
    no rows.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = stored(_signatures(source, words), "signatures")
    one = ["n_shingles", "sum_a", "sum_b"]
    real = rows.where("id IS NOT NULL AND n_shingles > 0")
    # Equal sets first: one row stands for all its copies.
    classes = stored(
        real.groupBy(*one).agg(F.min("id").alias("rep"), F.min_by("symbols", "id").alias("symbols")),
        "classes")
    member = rows.join(classes.select(*one, "rep"), one, "left").select(
        "id", "n_shingles", F.when(F.col("id").isNotNull(), F.col("rep")).alias("rep"))
    member = stored(member, "members")
    shared = member.where("rep IS NOT NULL").groupBy("id").agg(
        F.min("rep").alias("a"), F.max("rep").alias("z")).where("a <> z").select("id", "a")
    same = member.join(shared, "id").where("rep <> a").select("a", F.col("rep").alias("b"))

    keys = classes.select(F.col("rep").alias("id"), F.explode(_keys(F.col("symbols"))).alias("key"))
    used = stored(
        keys.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("hub"), F.max("id").alias("z"))
        .where("hub < z").select("key", "n", "hub"), "index")
    hits = stored(keys.join(used, "key").select("key", "id", "hub", "n"), "hits")
    # First every member against its bucket's smallest: linear, and joins nearly all groups.
    first = hits.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    # One pass over the texts of all documents that share a bucket. Shuffled at any size, so
    # that cost follows the input and no list of ids is broadcast.
    sharing = hits.select("id").distinct().hint("merge")
    sets = stored(_full_sets(source.join(sharing, "id", "left_semi"), words), "sets")
    links = confirmed(_near(first, classes), sets, per_cent).unionByName(same)
    links = stored(links, "links")
    label = components(links)
    # Then all members of different groups, in the buckets that still hold several.
    told = hits.join(label, "id", "left").select(
        "key", "id", "hub", "n", F.coalesce("component", "id").alias("label"))
    mixed = told.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where(
        "x < y").select("key")
    open_ = stored(told.where("n > 2").join(mixed, "key").select("key", "id", "hub", "label"), "open")
    sketches = stored(_sketches(sets.join(open_.select("id").distinct(), "id", "left_semi")), "sketches")
    sizes = used.where(F.col("n") > BLOCK).select("key", "n")
    # A run gives fewer pairs of near groups than it has groups, not its pairs of near members.
    near = (
        gathered(blocked(open_.join(sketches, "id"), sizes, "key", F.col("id")), "key")
        .select("key", "block_a", "block_b", "block", "id", "hub", "label", "symbols", "sketch")
        .mapInArrow(near_pairs(most_apart(per_cent), np.uint16, _first_key, groups=True), "a long, b long")
    )
    cluster = components(near).select(F.col("id").alias("label"), F.col("component").alias("cluster"))
    # All links between groups lie within a cluster of near groups; they are found there on full sets.
    close = stored(open_.select("id", "label").distinct().join(cluster, "label"), "close")
    sizes = close.groupBy("cluster").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    more = (
        gathered(blocked(close.join(sketches, "id").join(sets, "id"), sizes, "cluster", F.col("id")), "cluster")
        .select("cluster", "block_a", "block_b", "block", "id", "label", "sketch", "full")
        .mapInArrow(_links(per_cent), "a long, b long")
    )
    final = components(links.unionByName(more))
    return (
        member.join(final.withColumnRenamed("id", "rep"), "rep", "left")
        .select(F.col("id").alias(id_col), "n_shingles",
                F.when(F.col("id").isNotNull(), F.coalesce("component", "rep", "id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
    )


def _signatures(source: DataFrame, words: int) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minima = sh.MinHash(SYMBOLS)
        for batch in batches:
            for first, data, bounds in sh.slices(batch["text"]):
                sets, at = _sets(data, bounds, words)
                n = np.diff(at)
                full = np.concatenate([[np.uint64(0)], np.cumsum(sets, dtype=np.uint64)])
                turned = np.concatenate([[np.uint64(0)], np.cumsum(sh.mix(sets), dtype=np.uint64)])
                symbols = (sh.mix(minima.minima(sets, at)) & np.uint64(0xFFFF)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch["id"].slice(first, len(n)), pa.array(n),
                    sh.signed(full[at[1:]] - full[at[:-1]]), sh.signed(turned[at[1:]] - turned[at[:-1]]),
                    pa.FixedSizeListArray.from_arrays(pa.array(symbols.ravel()), SYMBOLS).cast(pa.list_(pa.int32())),
                ], ["id", "n_shingles", "sum_a", "sum_b", "symbols"])

    return source.mapInArrow(
        sign, "id long, n_shingles long, sum_a long, sum_b long, symbols array<int>")


def _full_sets(source: DataFrame, words: int) -> DataFrame:
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, bounds in sh.slices(batch["text"]):
                sets, at = _sets(data, bounds, words)
                yield pa.RecordBatch.from_arrays(
                    [batch["id"].slice(first, len(at) - 1), sh.lists(sets, at)], ["id", "full"])

    return source.mapInArrow(collect, "id long, full array<long>")


def _sketches(sets: DataFrame) -> DataFrame:
    """Signature and one-bit sketch as bytes."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minima, more = sh.MinHash(SYMBOLS), sh.MinHash(BITS, seed=8)
        for ids, values, at in sh.flat(batches):
            symbols = (sh.mix(minima.minima(values, at)) & np.uint64(0xFFFF)).astype(np.uint16)
            yield pa.RecordBatch.from_arrays([
                ids, pa.array([x.tobytes() for x in symbols], pa.binary()), bits(more.minima(values, at))],
                ["id", "symbols", "sketch"])

    return sets.mapInArrow(sketch, "id long, symbols binary, sketch binary")


def most_apart(per_cent: int) -> int:
    """Sketch bits in which a pair at the limit may differ: its mean and 4.75 deviations."""
    rate = (1 - per_cent / 100) / 2
    return int(BITS * rate + 4.75 * (BITS * rate * (1 - rate)) ** 0.5)


def _sets(data: np.ndarray, bounds: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    hashes, _, _, rows = sh.words(data, bounds)
    return sh.distinct(*sh.shingles(hashes, rows, words))


def _keys(symbols: Column) -> Column:
    """Every chunk with each of its places left out, packed into a long."""
    keys = []
    for chunk in range(CHUNKS):
        for gap in range(WIDTH):
            key = F.lit(chunk * WIDTH + gap).cast("long")
            for place in range(WIDTH):
                if place != gap:
                    key = F.shiftleft(key, 16) + symbols[chunk * WIDTH + place]
            keys.append(key)
    return F.array(*keys)


def _near(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose signatures lie within the distance."""
    left = classes.select(F.col("rep").alias("a"), F.col("symbols").alias("sa"))
    right = classes.select(F.col("rep").alias("b"), F.col("symbols").alias("sb"))
    apart = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x != y), lambda x: x))
    return pairs.join(left, "a").join(right, "b").where(apart <= DISTANCE).select("a", "b")


def near_pairs(most: int, kind: type, first, groups: bool = False):
    """Pairs of a run whose sketches are near, of different groups and not yet tried.

    With ``groups`` the pairs are of groups: near groups are one within the run from then on, so
    that a run gives fewer pairs than it has groups, which join the same groups as all pairs.

    ``first`` gives, for signatures against one, the number of the first bucket that they
    share, or -1 to leave the pair out: each pair is taken up in that bucket alone. A
    key's high bits are the number of its bucket.
    """
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "key"):
            at = run_bounds(table, "key")
            ids, group, hub, block = (table[c].to_numpy() for c in ("id", "label", "hub", "block"))
            label = group.copy()
            own = table["block_a"].to_numpy() == table["block_b"].to_numpy()
            symbols = np.frombuffer(b"".join(table["symbols"].to_pylist()), kind).reshape(table.num_rows, -1)
            sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint64).reshape(-1, BITS // 64)
            number = table["key"].to_numpy() >> NUMBER
            found: list[np.ndarray] = []
            for lo, hi in zip(at[:-1], at[1:], strict=True):
                for i in range(lo, hi - 1):
                    if ids[i] == hub[i]:
                        continue
                    j = np.arange(i + 1, hi)
                    j = j[(label[j] != label[i]) & (ids[j] != hub[j])]
                    if not own[i]:
                        j = j[block[j] != block[i]]
                    j = j[np.bitwise_count(sketch[j] ^ sketch[i]).sum(1, dtype=np.int64) <= most]
                    j = j[first(symbols[j], symbols[i]) == number[i]] if len(j) else j
                    if len(j) and groups:
                        joined, one = np.unique(label[j], return_index=True)
                        j = group[j[one]]
                        found.append(np.stack([np.minimum(group[i], j), np.maximum(group[i], j)]))
                        run = label[lo:hi]
                        run[np.isin(run, joined)] = label[i]
                    elif len(j):
                        found.append(np.stack([np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])]))
            if found:
                out = np.unique(np.concatenate(found, 1), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1])], ["a", "b"])

    return pairs


def _links(per_cent: int):
    """Links within each run between documents of different groups, checked on their full sets.

    Linked groups are one within the run, nearest first, so that a run gives fewer links than it
    has groups and no list of pairs leaves the task.
    """
    most = most_apart(per_cent)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "cluster"):
            bounds = run_bounds(table, "cluster")
            ids, label, block = (table[c].to_numpy() for c in ("id", "label", "block"))
            label = label.copy()
            own = table["block_a"].to_numpy() == table["block_b"].to_numpy()
            sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint64).reshape(-1, BITS // 64)
            full = table["full"].combine_chunks()
            at = np.concatenate([[0], np.cumsum(full.value_lengths().to_numpy(zero_copy_only=False))])
            sets = np.split(full.flatten().to_numpy().view(np.uint64), at[1:-1])
            found: list[tuple[int, int]] = []
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                for i in range(lo, hi - 1):
                    j = np.arange(i + 1, hi)
                    j = j[label[j] != label[i]]
                    if not own[i]:
                        j = j[block[j] != block[i]]
                    apart = np.bitwise_count(sketch[j] ^ sketch[i]).sum(1, dtype=np.int64)
                    for k in j[np.argsort(apart, kind="stable")][:np.count_nonzero(apart <= most)]:
                        if label[k] == label[i]:
                            continue
                        few, many = sorted((sets[i], sets[k]), key=len)
                        both = np.count_nonzero(many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few)
                        if 100 * both >= per_cent * (len(few) + len(many) - both):
                            found.append((ids[i], ids[k]))
                            run = label[lo:hi]
                            run[run == label[k]] = label[i]
            if found:
                out = np.array(found).T
                yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1])], ["a", "b"])

    return link


def _first_key(some: np.ndarray, one: np.ndarray) -> np.ndarray:
    """The first chunk with at most one error, and the place to leave out."""
    wrong = some != one
    chunks = wrong.reshape(len(wrong), CHUNKS, WIDTH)
    chunk = (chunks.sum(2) <= 1).argmax(1)
    number = chunk * WIDTH + chunks[np.arange(len(wrong)), chunk].argmax(1)
    return np.where(wrong.sum(1) <= DISTANCE, number, -1)


def bits(minima: np.ndarray) -> pa.Array:
    """One bit of each minimum, as bytes per row."""
    packed = np.packbits((sh.mix(minima) & np.uint64(1)).astype(bool), axis=1)
    return pa.array([x.tobytes() for x in packed], pa.binary())


def confirmed(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """The pairs whose full sets, from (id, full), are similar enough."""
    both = F.size(F.array_intersect("fa", "fb"))
    return (
        pairs.join(sets.select(F.col("id").alias("a"), F.col("full").alias("fa")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("full").alias("fb")), "b")
        .where(100 * both >= per_cent * (F.size("fa") + F.size("fb") - both))
        .select("a", "b").distinct()
    )


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), words=4)
