"""Mixing sources to target weights by weighted fair queueing.

The documents of each source stand in a queue in shuffled order. A document's virtual
finish time is the number of words its queue has served once it is through, divided
by the source's target. Serving all queues by virtual time up to the total budget
gives every source its target; sources that the budget exceeds are read a second time.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transqa.llm.common import WORD, read, stored

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
REPEATS = 2
ROWS_PER_BUCKET = 20_000


def targets(sources: DataFrame, budget: float = BUDGET, repeats: int = REPEATS) -> DataFrame:
    """Share ``budget`` times all words by weight; no source above ``repeats`` times its size.

    ``sources`` has (source, source_size, weight), one row per source. The excess of capped
    sources is shared by weight among the others until none is above: those with the
    smallest cap per weight fill first, and the rest share one level.
    """
    cap, w = F.col("cap"), F.col("weight")
    order = Window.orderBy("fill", "weight", F.col("source").isNull(), "source")
    filled = (
        sources.withColumn("cap", (repeats * F.col("source_size")).cast("double"))
        .withColumn("fill", cap / w)
        .withColumn("total", F.sum("source_size").over(Window.partitionBy()) * F.lit(float(budget)))
        .withColumn("before", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("turn", F.row_number().over(order))
        .withColumn("level", (F.col("total") - F.col("before")) / F.col("open"))
    )
    level = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("turn", "level"))).over(
        Window.partitionBy())
    return filled.withColumn("water", level["level"]).select(
        "source", "source_size", "weight", F.coalesce(F.least(cap, w * F.col("water")), cap).alias("target"))


def cyclic_weights(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Give the sources, in code point order with null last, the weights in turn."""
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    return sizes.withColumn("weight", F.element_at(
        F.array(*[F.lit(x) for x in weights]), (turn % len(weights) + 1).cast("int")))


def mix(docs: DataFrame, seed: str = "mix", weigh=cyclic_weights, budget: float = BUDGET,
        repeats: int = REPEATS, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """How many words the mix takes of every document.

    Size is the number of words of the whole text (null: 0). Returns one row per input
    row: id, size, source_size, target (its source's), taken (words, repeats
    counted; the last document of a source is taken in part, so a source's sum is its target
    rounded down), virtual_finish (of the first pass; null where nothing is served) and
    source. No document exceeds ``repeats`` times its size.
    Null sources are one source. The shuffled order hangs on seed, id and text alone, so
    reruns agree under any partitioning; equal rows are interchangeable. Extra columns
    are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit(""))
    rows = stored(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), key.alias("key"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.md5(F.concat_ws("|", F.lit(seed), F.col(id_col).cast("string"))).alias("place"),
        F.xxhash64(text_col).alias("tie")), "sizes")
    digits = _digits(rows.count())
    rows = rows.withColumn("bucket", F.substring("place", 1, digits))
    per = stored(rows.groupBy("key", "source", "bucket").agg(F.sum("size").alias("words")), "bucket_sums")
    shares = targets(weigh(per.groupBy("key", "source").agg(F.sum("words").alias("source_size")).select(
        "source", "source_size")), budget, repeats)
    shares = shares.withColumn("key", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")))
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = per.select("key", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("ahead"))
    ahead = ahead.join(shares.drop("source"), "key")
    inside = Window.partitionBy("key", "bucket").orderBy("place", "id", "tie", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    before = F.col("ahead") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    whole = F.floor("target").cast("long")
    return rows.join(ahead, ["key", "bucket"]).withColumn("before", before).select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        sum((_served(whole - p * F.col("source_size") - F.col("before")) for p in range(repeats)),
            F.lit(0)).cast("long").alias("taken"),
        F.when(F.col("target") > 0, (F.col("before") + F.col("size")) / F.col("target")).alias("virtual_finish"),
        F.col("source").alias(source_col), "tie")


def _served(rest: Column) -> Column:
    return F.greatest(F.lit(0), F.least(F.col("size"), rest))


def _digits(rows: int) -> int:
    digits = 0
    while rows > ROWS_PER_BUCKET * 16 ** digits:
        digits += 1
    return digits


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, in the order in which the queues serve them.

    A document comes as often as its taken words fill its size, rounded: whole texts, up
    to twice. A document without words is kept once, as it costs nothing.
    """
    share = mix(docs, **options)
    copies = F.when(F.col("size") == 0, 1).otherwise(F.floor(F.sum("taken") / F.count("*") / F.col("size") + 0.5))
    plan = share.groupBy("doc_id", "tie", "size", "source_size", "target").agg(
        F.sum("taken"), copies.cast("int").alias("copies"), F.min("virtual_finish").alias("finish")
    ).where("copies > 0").select(
        F.col("doc_id").alias("plan_id"), F.col("tie").alias("plan_tie"), "copies", "finish",
        (F.col("source_size") / F.col("target")).alias("round"))
    joined = docs.join(
        plan, F.col("doc_id").eqNullSafe(F.col("plan_id")) & (F.xxhash64("text") == F.col("plan_tie")))
    served = joined.withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    return served.sort(F.col("finish") + F.col("pass") * F.col("round"), "plan_id").select(
        *[docs[c] for c in docs.columns])


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix|' || doc_id::VARCHAR) AS place FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM d GROUP BY source
), f AS (
  SELECT *, (2 * source_size)::DOUBLE AS cap, (2 * source_size)::DOUBLE / weight AS fill,
         (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS total FROM s
), g AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY fill, weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / (sum(weight) OVER (ORDER BY fill, weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level,
         row_number() OVER (ORDER BY fill, weight, source NULLS LAST) AS turn FROM f
), t AS (
  SELECT source, source_size, coalesce(least(cap, weight * (SELECT level FROM g WHERE level <= fill ORDER BY turn LIMIT 1)), cap)::DOUBLE AS target FROM g
), b AS (
  SELECT d.*, source_size, target, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, floor(target)::BIGINT - before)) + greatest(0, least(size, floor(target)::BIGINT - source_size - before)))::BIGINT AS taken
FROM b
"""
