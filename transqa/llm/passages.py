"""Repeated passages: paragraphs that recur across documents, exactly or nearly.

Paragraphs are of two kinds. The lines of a text with ``LINE`` words and more; and, as
passages may begin anywhere, floating paragraphs of ``FLOAT`` words, begun where a
hash of the next five words is the smallest among ``REACH`` neighbouring starts. Any passage
of ``FLOAT + REACH - 1`` = 51 words holds such a start together with its paragraph whatever surrounds
it, so equal passages of over 50 words always share one. Equal paragraphs meet by hash. Floating ones
that met are then extended to both sides as far as any other document goes along: the first and the last start
of a passage, and any two between, lie so close that ``REACH - 1`` words a side reach its ends. Similar lines
meet by MinHash of their five-word shingles in ``BANDS`` bands of ``ROWS`` minima, tuned to
find a pair at Jaccard 0.8 with probability 0.998; every pair of a bucket is then checked
exactly, unless its two lines are joined already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transqa.llm import shingles as sh
from transqa.llm.buckets import BLOCK, blocked, gathered, run_bounds, runs
from transqa.llm.common import read, stored
from transqa.llm.graph import components
from transqa.llm.minhash import NUMBER, confirmed

LINE, FLOAT, REACH = 10, 24, 28
BANDS, ROWS = 8, 3
SHINGLE = 5
SIMILARITY = 80


def repeated_passages(docs: DataFrame, per_cent: int = SIMILARITY, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Find the paragraphs of every document that other documents hold too.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Lines are alike when
    their sets of five-word windows have a Jaccard similarity of ``per_cent`` or more.

    Returns one row per id: id, n_words (of the document), n_shared (its words in paragraphs that
    another document holds, floating ones extended to the ends of the equal run), n_removed (those
    of them that a document of a smaller id holds, likewise), removed (word ranges start:end, merged, comma-joined), kept_in (the ids of the
    documents that hold the first copies). The first copy stays. Repeats within one
    document alone are no finding. Rows without an id are left out; rows of one
    id count as one document and give one row. Null, empty and short texts have no finding.
    Extra columns are ignored; an empty table gives no rows.
    """
    source = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = stored(source.mapInArrow(
        _paragraphs, "id long, words long, start int, stop int, h long, line boolean"), "paragraphs")
    alike = _alike_lines(source, found.where("line"), per_cent)
    classes = found.where("h IS NOT NULL").groupBy("h").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    told = classes.join(alike.select(F.col("id").alias("h"), "component"), "h", "left")
    grouped = told.where("component IS NOT NULL").groupBy("component").agg(
        F.min("first").alias("lo"), F.max("last").alias("hi"))
    shared = told.join(grouped, "component", "left").select(
        "h", F.coalesce("lo", "first").alias("lo"), F.coalesce("hi", "last").alias("hi")).where("lo < hi")
    hits = stored(found.where("h IS NOT NULL").join(shared.hint("merge"), "h").select(
        "id", "start", "stop", "lo", "h", "line"), "hits")
    longer = _extended(source, hits.where("NOT line").select("id", "start", "h"))
    hits = hits.select("id", "start", "stop", "lo").unionByName(longer)
    # Equal ids of a document fold into one row of fixed size per range before ranges are merged.
    per = hits.groupBy("id").agg(
        F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("all_"),
        F.sort_array(F.collect_set(F.when(F.col("lo") < F.col("id"), F.struct("start", "stop")))).alias("cut"),
        F.sort_array(F.collect_set(F.when(F.col("lo") < F.col("id"), F.col("lo")))).alias("kept_in"))
    empty = F.array().cast("array<struct<a:int,b:int>>")

    def merged(spans):
        return F.aggregate(spans, empty, lambda s, x: F.when(
            (F.size(s) > 0) & (F.element_at(s, -1)["b"] >= x["start"]),
            F.concat(F.slice(s, 1, F.size(s) - 1), F.array(F.struct(
                F.element_at(s, -1)["a"].alias("a"),
                F.greatest(F.element_at(s, -1)["b"], x["stop"]).alias("b"))))
        ).otherwise(F.concat(s, F.array(F.struct(x["start"].alias("a"), x["stop"].alias("b"))))))

    def length(spans):
        return F.aggregate(spans, F.lit(0).cast("long"), lambda s, x: s + x["b"] - x["a"])

    spans = per.select("id", merged(F.col("all_")).alias("all_"), merged(F.col("cut")).alias("cut"), "kept_in")
    total = found.groupBy("id").agg(F.max("words").alias("n_words"))
    return total.join(spans, "id", "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce(length(F.col("all_")), F.lit(0)).alias("n_shared"),
        F.coalesce(length(F.col("cut")), F.lit(0)).alias("n_removed"),
        F.coalesce(F.array_join(F.transform("cut", lambda x: F.concat_ws(
            ":", x["a"].cast("string"), x["b"].cast("string"))), ","), F.lit("")).alias("removed"),
        F.coalesce("kept_in", F.array().cast("array<bigint>")).alias("kept_in"))


def _range_hashes(hashes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hashes of word ranges, from one running sum."""
    up, down = sh._power(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:len(hashes)], out=total[1:])
    return sh.mix((total[stop] - total[start]) * down[start] + (stop - start).astype(np.uint64))


def _lines(data: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word ranges of the lines of enough words."""
    n = len(starts)
    if not n:
        return starts, starts
    breaks = np.cumsum(data == 10)[starts]
    new = np.ones(n + 1, bool)
    new[1:n] = breaks[1:] != breaks[:-1]
    new[rows] = True
    at = np.flatnonzero(new)
    first, last = at[:-1], at[1:]
    enough = last - first >= LINE
    return first[enough], last[enough]


def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """The best of each ``width`` neighbours, in steps that double."""
    step = 1
    while 2 * step <= width:
        x = best(x[:-step], x[step:])
        step *= 2
    return best(x[:len(x) - (width - step)], x[width - step:]) if width > step else x


def _floating(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Starts of the floating paragraphs."""
    n = len(hashes)
    if n < FLOAT:
        return np.zeros(0, np.int64)
    near = np.arange(n - SHINGLE + 1)
    value = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    value[near] = _range_hashes(hashes, near, near + SHINGLE)
    left = np.repeat(rows[1:], np.diff(rows)) - np.arange(n)
    value[left < FLOAT] = np.iinfo(np.uint64).max
    worst = np.full(REACH - 1, np.iinfo(np.uint64).max, np.uint64)
    least = _slide(np.concatenate([worst, value, worst]), REACH, np.minimum)
    # A start is taken if it is the smallest of some stretch that lies within starts.
    inside = _slide(np.concatenate([worst * 0, left >= FLOAT, worst * 0]).astype(np.uint64), REACH, np.minimum)
    least = np.where(inside > 0, least, 0)
    chosen = _slide(least, REACH, np.maximum)
    taken = (chosen == value) & (left >= FLOAT)
    # Of equal neighbours, as in one word said over and over, every FLOAT-th is taken.
    again = np.zeros(n, bool)
    again[1:] = (value[1:] == value[:-1]) & taken[1:] & taken[:-1]
    place = np.arange(n)
    return np.flatnonzero(taken & ((place - np.maximum.accumulate(np.where(again, 0, place))) % FLOAT == 0))


def _paragraphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, data, bounds in sh.slices(batch["text"]):
            hashes, starts, _, rows = sh.words(data, bounds)
            a, b = _lines(data, starts, rows)
            f = _floating(hashes, rows)
            start, stop = np.concatenate([a, f]), np.concatenate([b, f + FLOAT])
            line = np.arange(len(start)) < len(a)
            doc = np.searchsorted(rows, start, "right") - 1
            ids = batch["id"].slice(first, len(bounds) - 1).to_numpy()
            words = np.diff(rows)
            h = pa.concat_arrays([sh.signed(_range_hashes(hashes, start, stop)), pa.nulls(len(ids), pa.int64())])
            none = np.zeros(len(ids), np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([ids[doc], ids])), pa.array(np.concatenate([words[doc], words])),
                pa.array(np.concatenate([start - rows[doc], none]).astype(np.int32)),
                pa.array(np.concatenate([stop - rows[doc], none]).astype(np.int32)), h,
                pa.array(np.concatenate([line, none > 0]))],
                ["id", "words", "start", "stop", "h", "line"])


def _extended(source: DataFrame, floats: DataFrame) -> DataFrame:
    """(id, start, stop, lo): the shared floating paragraphs with the words to their left or right
    that another document, and that one of a smaller id, has there too; lo is the smallest such id.

    The hash of a longer range is met like that of a paragraph. Where all occurrences have
    the same surroundings, one look at the longest range is enough. Else each different
    longest range, not each occurrence, looks up the lengths below it; only for these are the hashes
    of all lengths made, from one text that holds the range.
    """
    wanted = floats.groupBy("id").agg(F.collect_set(F.struct("start", "h")).alias("at"))
    around = stored(source.join(wanted.hint("merge"), "id").mapInArrow(
        _surroundings, "id long, start int, h long, right boolean, k int, full long"), "around")
    seen = around.groupBy("h", "right").agg(
        F.min("id").alias("lo"), F.max("id").alias("hi"), F.min("full").alias("x"), F.max("full").alias("y")).where("lo < hi")
    plain = around.join(seen.where("x = y").hint("merge"), ["h", "right"]).select("id", "start", "right", "k", "lo")
    open_ = stored(around.drop("k").join(
        seen.where("x < y").select("h", "right").hint("merge"), ["h", "right"], "left_semi"), "open_floats")
    kinds = open_.groupBy("right", "full").agg(
        F.min("id").alias("lo"), F.max("id").alias("hi"), F.min(F.struct("id", "start")).alias("at"))
    asked = kinds.groupBy("at.id").agg(F.collect_list(F.struct("at.start", "right", "full", "lo", "hi")).alias("at"))
    known = stored(source.join(asked.hint("merge"), "id").mapInArrow(
        _lengths, "right boolean, full long, lo long, hi long, keys array<long>"), "surroundings")
    steps = known.select("right", "full", "lo", "hi", F.posexplode("keys").alias("k", "key"))
    met = steps.groupBy("right", "key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo < hi")
    reach = steps.select("right", "full", "k", "key").join(met.hint("merge"), ["right", "key"]).groupBy("right", "full").agg(
        F.collect_list(F.struct((F.col("k") + 1).alias("k"), "lo")).alias("reach"))
    best = open_.select("id", "start", "right", "full").join(reach.hint("merge"), ["right", "full"]).select(
        "id", "start", "right", F.explode(F.array(
            F.array_max("reach"), F.array_max(F.filter("reach", lambda x: x["lo"] < F.col("id"))))).alias("r")
    ).where("r IS NOT NULL").select("id", "start", "right", "r.k", "r.lo")
    return plain.unionByName(best).select(
        "id", F.when(F.col("right"), F.col("start")).otherwise(F.col("start") - F.col("k")).alias("start"),
        (F.col("start") + FLOAT + F.when(F.col("right"), F.col("k")).otherwise(0)).alias("stop"), "lo")


def _asked(batch: pa.RecordBatch):
    """Per run of texts: first row, hashes, the rows' bounds, and of the asked places text and columns."""
    for first, data, bounds in sh.slices(batch["text"]):
        hashes, _, _, rows = sh.words(data, bounds)
        at = batch["at"].slice(first, len(bounds) - 1)
        doc = np.repeat(np.arange(len(at)), at.value_lengths().to_numpy(zero_copy_only=False))
        columns = [x.to_numpy(zero_copy_only=False) for x in at.flatten().flatten()]
        # Another text of the same id may be too short for the place.
        fits = np.flatnonzero(rows[doc] + columns[0] + FLOAT <= rows[doc + 1])
        yield first, hashes, rows, doc[fits], [x[fits] for x in columns]


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per paragraph and side the words, up to ``REACH - 1``, by which a range may be longer, and the hash of the longest."""
    for batch in batches:
        for first, hashes, rows, doc, (own, h) in _asked(batch):
            ids = batch["id"].slice(first, len(rows) - 1).to_numpy()
            start = rows[doc] + own
            # Another text of the same id need not hold the paragraph there.
            fits = np.flatnonzero(_range_hashes(hashes, start, start + FLOAT).view(np.int64) == h)
            start, doc, own, h = start[fits], doc[fits], own[fits], h[fits]
            for right in (False, True):
                room = np.minimum(rows[doc + 1] - start - FLOAT if right else start - rows[doc], REACH - 1)
                some = np.flatnonzero(room)
                full = _range_hashes(hashes, start[some] - (0 if right else room[some]),
                                     start[some] + FLOAT + (room[some] if right else 0))
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[doc[some]]), pa.array(own[some].astype(np.int32)), pa.array(h[some]),
                    pa.array(np.full(len(some), right)), pa.array(room[some].astype(np.int32)), sh.signed(full)],
                    ["id", "start", "h", "right", "k", "full"])


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each asked longest range the hashes of the ranges that are longer than the paragraph by 1, 2 ... words."""
    steps = np.arange(1, REACH)
    for batch in batches:
        for _, hashes, rows, doc, (own, right, full, lo, hi) in _asked(batch):
            start, right = rows[doc] + own, right.astype(bool)
            room = np.minimum(np.where(right, rows[doc + 1] - start - FLOAT, start - rows[doc]), REACH - 1)
            # Another text of the same id may have other surroundings there.
            some = np.flatnonzero((room > 0) & (full == _range_hashes(
                hashes, start - np.where(right, 0, room), start + FLOAT + np.where(right, room, 0)).view(np.int64)))
            start, room, side = start[some, None], room[some], right[some, None]
            inside = steps <= room[:, None]
            keys = _range_hashes(hashes, (start - np.where(side, 0, steps))[inside],
                                 (start + FLOAT + np.where(side, steps, 0))[inside])
            yield pa.RecordBatch.from_arrays([
                pa.array(right[some]), pa.array(full[some]), pa.array(lo[some]), pa.array(hi[some]),
                sh.lists(keys, np.concatenate([[0], np.cumsum(room)]))], ["right", "full", "lo", "hi", "keys"])


def _line_sets(data: np.ndarray, bounds: np.ndarray):
    """Hash and distinct shingles of every line."""
    hashes, starts, _, rows = sh.words(data, bounds)
    a, b = _lines(data, starts, rows)
    size = b - a
    at = np.zeros(len(a) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    word = np.repeat(a, size) + np.arange(at[-1]) - np.repeat(at[:-1], size)
    return _range_hashes(hashes, a, b), *sh.distinct(*sh.shingles(hashes[word], at, SHINGLE))


def _keys(minima: np.ndarray) -> np.ndarray:
    """A key per band: its number in the high bits, a hash of its minima in the others."""
    folded = np.zeros((len(minima), BANDS), np.uint64)
    for r in range(ROWS):
        folded = sh.mix(folded + minima[:, r::ROWS])
    number = np.arange(BANDS, dtype=np.uint64) << np.uint64(NUMBER)
    return (folded >> np.uint64(64 - NUMBER) | number).view(np.int64)


def _alike_lines(source: DataFrame, lines: DataFrame, per_cent: int) -> DataFrame:
    """(id, component) of line hashes that are similar to another line's, directly or not."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minima = sh.MinHash(BANDS * ROWS)
        for batch in batches:
            for _, data, bounds in sh.slices(batch["text"]):
                h, sets, at = _line_sets(data, bounds)
                keys = _keys(minima.minima(sets, at))
                yield pa.RecordBatch.from_arrays(
                    [sh.signed(h), sh.lists(keys.ravel(), np.arange(len(h) + 1) * BANDS)], ["id", "keys"])

    keyed = stored(source.mapInArrow(sign, "id long, keys array<long>"), "bands")
    keys = keyed.select("id", F.explode("keys").alias("key"))
    used = stored(keys.groupBy("key").agg(
        F.min("id").alias("hub"), F.max("id").alias("z"), F.count("*").alias("n")).where("hub < z").select(
        "key", "hub", "n"), "used")
    hits = stored(keys.join(used, "key").select("key", "id", "hub", "n").distinct(), "band_hits")
    star = hits.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    sets = stored(_full_sets(source, lines, hits.select("id").distinct()), "line_sets")
    links = stored(confirmed(star, sets, per_cent), "line_links")
    label = components(links)
    told = hits.join(label, "id", "left").select(
        "key", "id", "hub", "n", F.coalesce("component", "id").alias("label"))
    mixed = told.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where(
        "x < y").select("key")
    open_ = stored(told.where("n > 2").join(mixed, "key").select("key", "id", "hub", "label"), "open_lines")
    dealt = blocked(open_.join(sets, "id"), used.where(F.col("n") > BLOCK).select("key", "n"), "key", F.col("id"))
    rest = gathered(dealt, "key").select(
        "key", "block_a", "block_b", "block", "id", "hub", "label", "full").mapInArrow(
        _links(per_cent), "a long, b long").distinct()
    return components(links.unionByName(rest))


def _links(per_cent: int):
    """Links within each run between lines of different groups, checked on their full sets.

    A line is linked to one member of each group that it belongs to, and from then on
    these groups are one within the run: they hold together already, so a run gives fewer
    links than it has groups and no list of pairs leaves the task.
    """
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "key"):
            bounds = run_bounds(table, "key")
            ids, label, hub, block = (table[c].to_numpy() for c in ("id", "label", "hub", "block"))
            label = label.copy()
            own = table["block_a"].to_numpy() == table["block_b"].to_numpy()
            full = table["full"].combine_chunks()
            size = full.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.concatenate([[0], np.cumsum(size)])
            values = full.flatten().to_numpy().view(np.uint64)
            found: list[np.ndarray] = []
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                for i in range(lo, hi - 1):
                    mine = values[at[i]:at[i + 1]]
                    if ids[i] == hub[i] or not len(mine) or (label[i + 1:hi] == label[i]).all():
                        continue
                    theirs = values[at[i + 1]:at[hi]]
                    place = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
                    same = np.concatenate([[0], np.cumsum(mine[place] == theirs)])
                    j = np.arange(i + 1, hi)
                    both = same[at[j + 1] - at[i + 1]] - same[at[j] - at[i + 1]]
                    near = (100 * both >= per_cent * (size[i] + size[j] - both)) & (label[j] != label[i])
                    if not own[i]:
                        near &= block[j] != block[i]
                    if near.any():
                        j = j[near]
                        joined, one = np.unique(label[j], return_index=True)
                        j = j[one]
                        found.append(np.stack([np.full(len(j), ids[i]), ids[j]]))
                        run = label[lo:hi]
                        run[np.isin(run, joined)] = label[i]
            if found:
                out = np.concatenate(found, 1)
                yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1])], ["a", "b"])

    return link


def _full_sets(source: DataFrame, lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """The shingle sets of the wanted lines, each from one document that holds it.

    Texts are shuffled once and at any size, so that cost follows the input and no list
    of ids is broadcast.
    """
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, bounds in sh.slices(batch["text"]):
                h, sets, at = _line_sets(data, bounds)
                yield pa.RecordBatch.from_arrays([sh.signed(h), sh.lists(sets, at)], ["id", "full"])

    wanted = stored(wanted, "wanted_lines")
    at = lines.join(wanted.select(F.col("id").alias("h")).hint("merge"), "h", "left_semi").groupBy("h").agg(
        F.min("id").alias("id"))
    holders = source.join(at.select("id").distinct().hint("merge"), "id", "left_semi")
    return holders.mapInArrow(collect, "id long, full array<long>").join(
        wanted.hint("merge"), "id", "left_semi").dropDuplicates(["id"])


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read(spark, sf_dir, "documents"))
