"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered from 0 in the order of id. A Feistel network permutes the smallest
power of two that holds all numbers; values outside are permuted again until
they fall inside (cycle walking), which permutes the row numbers themselves. Row i
goes to shard p(i) mod shards and slot p(i) div shards: shard sizes differ by one row at
most, and ``place`` computes a row's shard from its number, without data. DataFrame
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transqa.llm.common import let, read, stored

ROUNDS, WALK = 6, 80
_STEP = 0x9E3779B1
_LOW = 33       # a partition's rows are numbered in the low bits of Spark's increasing ids


def _round_keys(seed: int) -> list[int]:
    keys, x = [], seed & 0xFFFFFFFF
    for _ in range(ROUNDS):
        x = (x * 1664525 + 1013904223) & 0xFFFFFFFF
        keys.append(x)
    return keys


def _halves(rows: int) -> tuple[int, int]:
    bits = max(2, (rows - 1).bit_length())
    return bits // 2, bits - bits // 2


def place(row: int, rows: int, shards: int, seed: int = 1) -> tuple[int, int]:
    """Shard and slot of one row number, as plain arithmetic."""
    left, right = _halves(rows)
    x = row
    while True:
        hi, lo = x >> right, x & ((1 << right) - 1)
        for turn, key in enumerate(_round_keys(seed)):
            if turn % 2 == 0:
                hi ^= _scramble(lo, key) & ((1 << left) - 1)
            else:
                lo ^= _scramble(hi, key) & ((1 << right) - 1)
        x = hi << right | lo
        if x < rows:
            return x % shards, x // shards


def _scramble(half: int, key: int) -> int:
    x = (half + key) % (1 << 31) * _STEP % (1 << 61)
    x = x ^ x >> 15
    x = x % (1 << 31) * 0x85EBCA6B % (1 << 61)
    return x ^ x >> 13


def _scrambled(half: Column, key: int) -> Column:
    low, high = F.lit((1 << 31) - 1), F.lit((1 << 61) - 1)
    x = (half + F.lit(key).cast("long")).bitwiseAND(low) * F.lit(_STEP)
    x = x.bitwiseAND(high)
    return let(x, lambda v: let(
        (v.bitwiseXOR(F.shiftright(v, 15)).bitwiseAND(low) * F.lit(0x85EBCA6B)).bitwiseAND(high),
        lambda u: u.bitwiseXOR(F.shiftright(u, 13))))


def permuted(row: Column, rows: int, seed: int = 1) -> Column:
    """The permuted row number, as a column."""
    left, right = _halves(rows)
    masks = [F.lit((1 << left) - 1).cast("long"), F.lit((1 << right) - 1).cast("long")]
    keys = _round_keys(seed)

    def network(x: Column) -> Column:
        def turn(n: int, hi: Column, lo: Column) -> Column:
            if n == ROUNDS:
                return F.shiftleft(hi, right).bitwiseOR(lo)
            if n % 2 == 0:
                return let(hi.bitwiseXOR(_scrambled(lo, keys[n]).bitwiseAND(masks[0])), lambda h: turn(n + 1, h, lo))
            return let(lo.bitwiseXOR(_scrambled(hi, keys[n]).bitwiseAND(masks[1])), lambda w: turn(n + 1, hi, w))

        return turn(0, F.shiftright(x, right), x.bitwiseAND(masks[1]))

    # At least half of the values lie inside, so a walk of WALK steps has odds of 2**-WALK;
    # one that is longer stops the job rather than placing a row wrongly.
    steps = F.sequence(F.lit(1), F.lit(WALK))
    outside = F.lit(-1).cast("long")
    walked = F.aggregate(
        steps, F.struct(row.alias("x"), outside.alias("y")),
        lambda s, _: F.when(s["y"] >= 0, s).otherwise(let(
            network(s["x"]), lambda v: F.struct(v.alias("x"), F.when(v < rows, v).otherwise(outside).alias("y")))),
        lambda s: s["y"])
    return let(walked, lambda y: F.when(y >= 0, y).otherwise(
        F.raise_error(F.lit("cycle walk too long: choose another seed")).cast("long")))


def sharded(docs: DataFrame, shards: int = 24, seed: int = 1, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Put all documents into ``shards`` shards of equal row counts, in reproducible random order.

    Returns one row per input row: id, size (UTF-8 bytes of the text, null: none, plus 8),
    text_crc32, law ('rows'), shard, slot (from 0 without gaps in each shard),
    grown_shard (null: this law moves rows everywhere when a shard is added) and row_number.
    Rows are numbered by id (null first), then by checksum, size and a hash of the text;
    equal rows are interchangeable. Extra columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    session = docs.sparkSession
    narrow = docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text_col).alias("tie"))
    order = ["id", "text_crc32", "size", "tie"]
    parts = max(1, int(session.conf.get("spark.sql.shuffle.partitions")))
    # Written once: the numbering must not change between counting and reading.
    ordered = stored(
        stored(narrow, "narrow").repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("at", _LOW)
    counts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    rows = ordered.count()
    number = (F.col("start") + F.col("at").bitwiseAND(F.lit((1 << _LOW) - 1))).cast("long")
    placed = (
        ordered.withColumn("part", part).join(starts, "part").withColumn("row_number", number)
        .withColumn("p", permuted(F.col("row_number"), max(1, rows), seed))
    )
    return placed.select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("p") % shards).cast("int").alias("shard"), F.floor(F.col("p") / shards).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "row_number")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(read(spark, sf_dir, "documents"))
