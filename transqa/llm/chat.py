"""Chat formatting by columnar byte assembly.

A conversation becomes one text of turns ``### {role}:\\n{text}</turn>\\n``. Texts and roles are
escaped reversibly on the JVM first: a backslash doubles, ``</turn>`` becomes ``<\\/turn>``, ``###``
becomes ``\\###`` and, in roles only, a line break gets a backslash before it. Unescaping drops the
first backslash of every pair, so any text, the template's own markers included, comes back as it was.

Assembly needs no string operation per row. Rows come range-partitioned by (conversation, turn) and
sorted; for each Arrow batch numpy computes the length of every segment (header, role, separator, text,
closer), their cumulative offsets and the gather and scatter indices, and copies all headers and contents
into one preallocated byte buffer that becomes the Arrow string column as it is. The loss mask (each
assistant text, as code-point spans of the formatted text) comes from the same offsets.

A very long conversation is split by the range partitioning: its output is then several chunks, each a
run of whole turns, ordered by ``chunk``; their texts joined in that order are the conversation.

Odd rows: null text formats as '' and a null role as ''; null turns sort first, rows of one turn by
role and text (repeated rows are kept, one turn each); rows without conv_id form one conversation with
a null id. An empty table gives no chunk. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transqa.llm.common import new_folder, read

# Fixed values of the template.
HEAD = b"### "
SEP = b":\n"
CLOSE = b"</turn>\n"
ASSISTANT = "assistant"

CHUNKS = "conv_id long, chunk long, n_turns long, text string, loss_starts array<long>, loss_ends array<long>"


def escaped(text: Column, role: bool = False) -> Column:
    out = F.regexp_replace(text, r"\\", r"\\\\")
    out = F.regexp_replace(out, "</turn>", r"<\\/turn>")
    out = F.regexp_replace(out, "###", r"\\###")
    if role:
        out = F.regexp_replace(out, "\n", "\\\\\n")
    return out


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _flat(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column without nulls."""
    array = array.cast(pa.large_string())
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64)[array.offset:array.offset + len(array) + 1]
    data = array.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets, data


def _positions(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ..., start + length - 1 of every row, concatenated."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()), dtype=np.int64)


def _put(out: np.ndarray, row_start: np.ndarray, at: int, constant: bytes) -> None:
    n, k = len(row_start), len(constant)
    where = np.repeat(row_start + at, k) + np.tile(np.arange(k, dtype=np.int64), n)
    out[where] = np.tile(np.frombuffer(constant, np.uint8), n)


def assemble(batch: pa.RecordBatch, chunk_base: int) -> pa.RecordBatch:
    """Format the sorted rows of one batch: one output row per run of equal conversation."""
    n = batch.num_rows
    missing = batch.column("missing").to_numpy(zero_copy_only=False)
    key = batch.column("key").to_numpy(zero_copy_only=False)
    assistant = batch.column("assistant").to_numpy(zero_copy_only=False)
    role_off, role_data = _flat(batch.column("role_e"))
    text_off, text_data = _flat(batch.column("text_e"))
    role_len, text_len = np.diff(role_off), np.diff(text_off)

    row_len = len(HEAD) + role_len + len(SEP) + text_len + len(CLOSE)
    row_start = np.cumsum(row_len) - row_len
    out = np.empty(int(row_len.sum()), dtype=np.uint8)
    _put(out, row_start, 0, HEAD)
    out[_positions(row_start + len(HEAD), role_len)] = role_data[_positions(role_off[:-1], role_len)]
    text_at = row_start + len(HEAD) + role_len + len(SEP)
    _put(out, text_at - len(SEP), 0, SEP)
    out[_positions(text_at, text_len)] = text_data[_positions(text_off[:-1], text_len)]
    _put(out, text_at + text_len, 0, CLOSE)

    new = np.ones(n, dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (missing[1:] != missing[:-1])
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    bounds = np.append(row_start[first], len(out))

    # Code points before every byte: the loss mask is kept in characters.
    chars = np.zeros(len(out) + 1, dtype=np.int64)
    np.cumsum((out & 0xC0) != 0x80, out=chars[1:])
    group_chars = chars[row_start[first]]
    loss = np.flatnonzero(assistant)
    loss_start = chars[text_at[loss]] - group_chars[group[loss]]
    loss_end = chars[text_at[loss] + text_len[loss]] - group_chars[group[loss]]
    list_off = np.zeros(len(first) + 1, dtype=np.int32)
    np.cumsum(np.bincount(group[loss], minlength=len(first)), out=list_off[1:])

    conv = pa.array(key[first], pa.int64(), mask=missing[first])
    turns = np.diff(np.append(first, n))
    text = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(out))
    return pa.RecordBatch.from_arrays([
        conv,
        pa.array(chunk_base + np.arange(len(first), dtype=np.int64)),
        pa.array(turns.astype(np.int64)),
        text.cast(pa.string()) if len(out) < 2**31 else text,
        pa.ListArray.from_arrays(pa.array(list_off), pa.array(loss_start, pa.int64())),
        pa.ListArray.from_arrays(pa.array(list_off), pa.array(loss_end, pa.int64())),
    ], names=["conv_id", "chunk", "n_turns", "text", "loss_starts", "loss_ends"])


def _format_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task = TaskContext.get()
    base = (task.partitionId() if task else 0) << 32
    made = 0
    pending: pa.Table | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        table = pa.Table.from_batches([batch]) if pending is None else pa.concat_tables([pending, pa.Table.from_batches([batch])])
        table = table.combine_chunks()
        key = table.column("key").to_numpy()
        missing = table.column("missing").to_numpy()
        same = (key == key[-1]) & (missing == missing[-1])
        # The trailing conversation may go on in the next batch; a batch that is all one
        # conversation is a chunk of its own, so nothing is carried more than once.
        tail = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        if tail == 0:
            pending = None
            ready = table
        else:
            pending, ready = table.slice(tail), table.slice(0, tail)
        for part in ready.to_batches():
            result = assemble(part, base + made)
            made += result.num_rows
            yield result
    if pending is not None and pending.num_rows:
        for part in pending.combine_chunks().to_batches():
            result = assemble(part, base + made)
            made += result.num_rows
            yield result


def formatted_chats(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                    role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Chunks of formatted conversations: conv_id, chunk, n_turns, text, loss_starts, loss_ends.

    Loss spans are code points of ``text``, end exclusive, one per assistant turn.
    """
    prepared = rows.select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).select(
        F.col("conv").isNull().alias("missing"),
        F.coalesce("conv", F.lit(0)).alias("key"),
        "turn",
        (F.col("role") == ASSISTANT).alias("assistant"),
        escaped(F.col("role"), role=True).alias("role_e"),
        escaped(F.col("text")).alias("text_e"),
    )
    order = ["missing", "key", F.col("turn").asc_nulls_first(), "role_e", "text_e"]
    return (prepared.repartitionByRange("missing", "key", F.col("turn").asc_nulls_first())
            .sortWithinPartitions(*order)
            .select("missing", "key", "assistant", "role_e", "text_e")
            .mapInArrow(_format_partition, CHUNKS))


def write_chats(rows: DataFrame, place: str, **columns: str) -> None:
    formatted_chats(rows, **columns).write.parquet(place)


def read_turns(chunks: DataFrame) -> DataFrame:
    """The turns of formatted chunks, unescaped: conv_id, chunk, position, role, text."""
    pattern = r"(?s)^### ((?:[^\\\n]|\\.)*):\n(.*)$"
    split = chunks.select("conv_id", "chunk", F.split("text", "</turn>\n", -1).alias("pieces"))
    pieces = split.select("conv_id", "chunk", F.size("pieces").alias("n"),
                          F.posexplode("pieces").alias("position", "piece"))
    # The text ends with a closer, so the last piece is empty.
    return pieces.where(F.col("position") < F.col("n") - 1).select(
        "conv_id", "chunk", "position",
        unescaped(F.regexp_extract("piece", pattern, 1)).alias("role"),
        unescaped(F.regexp_extract("piece", pattern, 2)).alias("text"),
    )


def _ordered_join(parts: Column, order: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), parts.alias("p")))),
                                    lambda s: s["p"]), "")


# The conversation the contract adds: its text holds the template's own markers.
PROBE_ID = -7
PROBE_TEXT = "\\### Assistant: </turn> ok"


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(PROBE_ID, 0, "user", PROBE_TEXT), (PROBE_ID, 1, ASSISTANT, PROBE_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    place = new_folder(spark, "chats")
    write_chats(convs.unionByName(probe), place)
    chunks = spark.read.schema(CHUNKS).parquet(place)

    turns = read_turns(chunks).groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.sha2(_ordered_join(F.concat("role", F.lit("\n"), "text", F.lit("\n")),
                             F.struct("chunk", "position")), 256).alias("turns_sha256"))
    loss = chunks.select(
        "conv_id", "chunk", F.char_length("text").alias("chars"),
        F.array_join(F.transform(F.arrays_zip("loss_starts", "loss_ends"),
                                 lambda z: unescaped(F.substring("text", z["loss_starts"] + 1,
                                                                 z["loss_ends"] - z["loss_starts"]))), "").alias("loss"),
        F.aggregate(F.arrays_zip("loss_starts", "loss_ends"), F.lit(0).cast("long"),
                    lambda acc, z: acc + z["loss_ends"] - z["loss_starts"]).alias("loss_chars"),
    ).groupBy("conv_id").agg(
        F.sum("loss_chars").alias("loss_chars"),
        F.sha2(_ordered_join(F.col("loss"), F.col("chunk")), 256).alias("loss_sha256"),
        F.sum("chars").alias("formatted_chars"),
    )
    return turns.join(loss, turns.conv_id.eqNullSafe(loss.conv_id)).select(
        turns.conv_id, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


# Expected rows: the same template and escaping by string functions, digests by ordered aggregation.
OP11_SQL = r"""
WITH c AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn,
         coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *,
         replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '###', '\###') AS te,
         replace(replace(replace(replace(role, '\', '\\'), '</turn>', '<\/turn>'), '###', '\###'), chr(10), '\' || chr(10)) AS re
  FROM c
)
SELECT conv_id,
       CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, re, te)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(te) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, re, te), '')) AS loss_sha256,
       CAST(sum(4 + length(re) + 2 + length(te) + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
