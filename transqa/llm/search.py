"""Ranked lexical search by per-term geometric blocking.

Index. Every document (a row; rows may repeat an id) gets a private key. A task cuts its documents' texts
into terms, sorts them by the MinHash of their term sets (their two least term hashes) and stores blocks of
up to ``block`` neighbours, one row each: the documents, their distinct terms as 64-bit hashes and the counts.

Postings. The blocks' postings of the terms that the items ask for are stored, one row a block; document
frequencies are counted over them. A posting's impact is the document's exact integer contribution for
that term (weight times saturated frequency). A block's summary is the coordinatewise maximum of
its documents' impact vectors on the asked terms.

Search, per query item. The sum of a block's maxima over the item's terms bounds the score of every
document in the block. The ``seeds`` blocks of highest bound are scored exactly; the 50th best score
found there (1 if fewer than 50 documents score) is a threshold no true top-50 document falls below.
A block is skipped only when its exact bound is below that threshold; all other blocks are scored
exactly, and the top 50 are taken from them. The result is exact.

Scale: texts are read once and stay in their tasks; a block is bounded in documents and in terms, so no
common term gathers them. Of an item a task gives its k best documents. The asked terms and their
weights are broadcast; items of more than ``BROADCAST_TERMS`` terms together are searched in several turns.

Odd rows: null or empty texts have no terms and are not counted in N or L; rows repeating a doc_id are
separate documents; a null doc_id ranks after all ids of equal score. Items without an id, with null text or
no term return nothing. Empty tables give an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transqa.llm import shingles as sh
from transqa.llm.common import read, stored

# Fixed values of the contract: a term is a run of bytes that are none of these, A-Z lower-cased.
GAP = np.zeros(256, bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    GAP[_low:_high + 1] = True
TOP = 50

BLOCK = 64          # documents per block
POSTINGS = 1 << 16  # postings of a block, unless one document has more
HELD = 1 << 21      # postings that a task holds while it sorts documents into blocks
SEEDS = 4           # blocks per item scored first to set its threshold
BROADCAST_TERMS = 2_000_000  # query (item, term) rows broadcast at most


@dataclass(frozen=True)
class Index:
    blocks: DataFrame     # block, key, doc_id, n, ends (of the documents' postings), terms (hashes), tfs
    count: int            # N
    length: int           # L


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> Index:
    """One stored row per block of documents with terms."""
    rows = stored(docs.select(
        F.monotonically_increasing_id().alias("key"), F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
    ).mapInArrow(_blocks(block), "block long, key array<long>, doc_id array<long>, n array<long>, "
                                 "ends array<int>, terms array<long>, tfs array<int>"), "search_index")
    totals = rows.agg(F.sum(F.size("key")).alias("N"), F.sum(
        F.aggregate("n", F.lit(0).cast("long"), lambda s, n: s + n)).alias("L")).first()
    return Index(rows, int(totals["N"] or 0), int(totals["L"] or 0))


def _counted(batch: pa.RecordBatch, first: int, data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple]:
    """Key, id, number of terms, distinct term hashes and counts of every document with terms."""
    hashes, _, _, rows = sh.words(data, bounds, GAP)
    keys, ids = (batch[c].slice(first, len(bounds) - 1).to_pylist() for c in ("key", "doc_id"))
    for i in np.flatnonzero(np.diff(rows)):
        some, tf = np.unique(hashes[rows[i]:rows[i + 1]], return_counts=True)
        yield keys[i], ids[i], int(rows[i + 1] - rows[i]), some, tf


def _blocks(block: int):
    def cut(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        held.sort(key=lambda d: (*d[3][:2].tolist(), d[0]))
        lo = 0
        while lo < len(held):
            hi, size = lo + 1, len(held[lo][3])
            while hi < len(held) and hi - lo < block and size + len(held[hi][3]) <= POSTINGS:
                size += len(held[hi][3])
                hi += 1
            keys, ids, n, some, tfs = zip(*held[lo:hi], strict=True)
            yield pa.RecordBatch.from_arrays([
                pa.array([keys[0]], pa.int64()), pa.array([keys], pa.list_(pa.int64())),
                pa.array([ids], pa.list_(pa.int64())), pa.array([n], pa.list_(pa.int64())),
                _row(np.cumsum([len(x) for x in some]).astype(np.int32)),
                _row(np.concatenate(some).view(np.int64)), _row(np.concatenate(tfs).astype(np.int32))],
                ["block", "key", "doc_id", "n", "ends", "terms", "tfs"])
            lo = hi

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in sh.slices(batch["text"]):
                for doc in _counted(batch, *part):
                    held.append(doc)
                    size += len(doc[3])
                if size >= HELD:
                    yield from cut(held)
                    held, size = [], 0
        yield from cut(held)

    return blocks


def _row(values: np.ndarray) -> pa.Array:
    """One row that holds all the values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, data, bounds in sh.slices(batch["text"]):
            hashes, _, _, rows = sh.words(data, bounds, GAP)
            ids = batch["item_id"].slice(first, len(bounds) - 1).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, np.diff(rows))), sh.signed(hashes)], ["item_id", "term"])


def _hits(shared):
    """The blocks' postings of asked terms: the document's place in the block, the term's number and its count."""
    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value["terms"]
        for batch in batches:
            for i in range(batch.num_rows):
                terms, tfs, ends = (batch[c][i].values.to_numpy() for c in ("terms", "tfs", "ends"))
                tid = np.minimum(np.searchsorted(asked, terms), len(asked) - 1)
                at = np.flatnonzero(asked[tid] == terms)
                if len(at):
                    yield pa.RecordBatch.from_arrays([
                        *(batch[c].slice(i, 1) for c in ("block", "key", "doc_id", "n")),
                        _row(np.searchsorted(ends, at, "right").astype(np.int32)),
                        _row(tid[at].astype(np.int32)), _row(tfs[at])],
                        ["block", "key", "doc_id", "n", "doc", "tid", "tf"])

    return hits


class _Scorer:
    """Impacts, bounds and scores of one block at a time."""

    CHUNK = 1 << 15     # (item, term) rows looked at together

    def __init__(self, shared, weights, n_docs: int, length: int):
        self.__dict__.update(shared.value)
        self.weights, self.n_docs, self.total = weights.value, n_docs, length
        self.place = np.zeros(len(self.terms), np.int64)     # a term's row in the block, 0 if it has none

    def impacts(self, batch: pa.RecordBatch, i: int) -> np.ndarray:
        """A row per asked term of the block, after one of zeros, and a column per document."""
        doc, tid, tf, n = (batch[c][i].values.to_numpy().astype(np.int64) for c in ("doc", "tid", "tf", "n"))
        m = 50 + (50 * n * self.n_docs) // self.total
        found, row = np.unique(tid, return_inverse=True)
        table = np.zeros((len(found) + 1, len(n)), np.int64)
        table[row + 1, doc] = self.weights[tid] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        self.place[found] = np.arange(1, len(found) + 1)
        self.found = found
        return table

    def sums(self, table: np.ndarray, items: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Items and the sums of their terms' rows, some items at a time."""
        size = self.ends[items] - self.starts[items]
        group = np.cumsum(size) // self.CHUNK
        for g in np.unique(group):
            some = items[group == g]
            n = size[group == g]
            stop = np.cumsum(n)
            at = np.repeat(self.starts[some] - stop + n, n) + np.arange(stop[-1])
            yield some, np.add.reduceat(table[self.place[self.asked[at]]], stop - n, axis=0)
        self.place[self.found] = 0


def _bounds(*given):
    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(*given)
        every = np.arange(len(scorer.starts))
        for batch in batches:
            for i in range(batch.num_rows):
                most = scorer.impacts(batch, i).max(axis=1)
                for items, sums in scorer.sums(most, every):
                    live = sums > 0
                    yield pa.RecordBatch.from_arrays([
                        pa.array(items[live].astype(np.int32)),
                        pa.array(np.full(live.sum(), batch["block"][i].as_py(), np.int64)), pa.array(sums[live])],
                        ["item", "block", "ub"])

    return bounds


def _best_of_task(k: int, *given):
    """Exact scores of the documents of the blocks' candidate items; the task's k best of each item."""
    def cut(held: list[tuple]) -> tuple:
        item, score, none, ids, keys = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((keys, ids, none, -score, item))
        item = item[order]
        new = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
        rank = np.arange(len(item)) - np.repeat(new, np.diff([*new, len(item)]))
        order = order[rank < k]
        last = np.flatnonzero(rank == k - 1)
        return [x[order] for x in (np.concatenate(y) for y in zip(*held, strict=True))], item[last], last

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(*given)
        least = np.ones(len(scorer.starts), np.int64)        # what a document must score
        held: list[list[np.ndarray]] = []
        size = 0
        for batch in batches:
            for i in range(batch.num_rows):
                items = np.sort(batch["items"][i].values.to_numpy().astype(np.int64))
                ids = batch["doc_id"][i].values
                none = ids.is_null().to_numpy(zero_copy_only=False)
                ids, keys = ids.fill_null(0).to_numpy(), batch["key"][i].values.to_numpy()
                for some, sums in scorer.sums(scorer.impacts(batch, i), items):
                    item, doc = np.nonzero(sums >= least[some][:, None])
                    held.append([some[item], sums[item, doc], none[doc], ids[doc], keys[doc]])
                    size += len(item)
                if size > 1 << 19:
                    kept, full, _ = cut(held)
                    held, size = [kept], 0
                    low = np.full(len(least), np.iinfo(np.int64).max)
                    np.minimum.at(low, kept[0], kept[1])
                    least[full] = low[full]
        if held:
            item, score, none, ids, keys = cut(held)[0]
            yield pa.RecordBatch.from_arrays([
                pa.array(scorer.item_ids[item]), pa.array(item.astype(np.int32)), pa.array(keys),
                pa.array(ids, mask=none), pa.array(score)], ["item_id", "item", "key", "doc_id", "score"])

    return best


def _top(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "key")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: Index, items: DataFrame, k: int = TOP, seeds: int = SEEDS,
           id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The k best documents of every item: item_id, rank, doc_id, score (positive scores only)."""
    asked = stored(items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
                   .where("item_id IS NOT NULL").mapInArrow(_asked, "item_id long, term long").distinct(),
                   "search_items")
    turns = max(1, -(-asked.count() // BROADCAST_TERMS))
    found = [_turn(index, asked.where(F.pmod(F.xxhash64("item_id"), F.lit(turns)) == t), k, seeds)
             for t in range(turns)]
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    return best


def _turn(index: Index, asked: DataFrame, k: int, seeds: int) -> DataFrame:
    spark = asked.sparkSession
    pairs = asked.sort("item_id", "term").toArrow()          # at most about BROADCAST_TERMS rows
    if not pairs.num_rows or not index.count:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    item_ids, starts = np.unique(pairs["item_id"].to_numpy(), return_index=True)
    terms, tids = np.unique(pairs["term"].to_numpy(), return_inverse=True)
    share = spark.sparkContext.broadcast({
        "item_ids": item_ids, "starts": starts, "ends": np.append(starts[1:], len(tids)), "terms": terms, "asked": tids})
    hits = stored(index.blocks.mapInArrow(
        _hits(share), "block long, key array<long>, doc_id array<long>, n array<long>, "
                      "doc array<int>, tid array<int>, tf array<int>"), "search_hits")
    counts = hits.select(F.explode("tid").alias("tid")).groupBy("tid").agg(F.count("*").alias("df")).select(
        "tid", F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * index.count + 2)) / (2 * F.col("df") + 1)))
        .cast("long").alias("w")).toArrow()
    weights = np.zeros(len(terms), np.int64)
    weights[counts["tid"].to_numpy()] = counts["w"].to_numpy()
    given = (share, spark.sparkContext.broadcast(weights), index.count, index.length)
    bounds = stored(hits.mapInArrow(_bounds(*given), "item int, block long, ub long"), "search_bounds")

    def best(candidates: DataFrame) -> DataFrame:
        few = candidates.count() <= BROADCAST_TERMS
        chosen = candidates.groupBy("block").agg(F.collect_list("item").alias("items"))
        return _top(hits.join(F.broadcast(chosen) if few else chosen, "block").mapInArrow(
            _best_of_task(k, *given), "item_id long, item int, key long, doc_id long, score long"), k)

    first = Window.partitionBy("item").orderBy(F.desc("ub"), "block")
    seeded = bounds.withColumn("r", F.row_number().over(first)).where(F.col("r") <= seeds).select("item", "block")
    threshold = stored(best(seeded).where(F.col("rank") == k).select(
        "item", F.col("score").alias("threshold")), "search_thresholds")
    candidates = stored(bounds.join(F.broadcast(threshold), "item", "left").where(
        F.col("ub") >= F.coalesce("threshold", F.lit(1))).select("item", "block"), "search_candidates")
    return best(candidates).select("item_id", F.col("rank").cast("int"), "doc_id", F.col("score").cast("long"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(read(spark, sf_dir, "documents"))
    return search(index, read(spark, sf_dir, "benchmark"))


# Expected rows: every document scored for every item, by brute force.
OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS key, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
), live AS (SELECT * FROM d WHERE len(t) > 0),
totals AS (SELECT count(*) AS nn, sum(len(t)) AS ll FROM live),
tf AS (SELECT key, doc_id, len(t) AS n, term, count(*) AS tf FROM (SELECT key, doc_id, t, unnest(t) AS term FROM live) GROUP BY key, doc_id, len(t), term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
imp AS (
  SELECT tf.key, tf.doc_id, tf.term,
         CAST(floor(1000.0 * ln((2.0 * nn + 2) / (2.0 * df + 1))) AS BIGINT)
         * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (50 + (50 * tf.n * nn) // ll)))::BIGINT AS impact
  FROM tf JOIN df USING (term), totals
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), s AS (
  SELECT q.item_id, imp.key, imp.doc_id, sum(imp.impact) AS score FROM q JOIN imp USING (term) GROUP BY q.item_id, imp.key, imp.doc_id
), r AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST, key) AS rank
  FROM s WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 50
"""
