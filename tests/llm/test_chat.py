"""Chat formatting against a plain formatter, on odd rows and the template's own markers."""

import hashlib

import pyarrow as pa
from pyspark.sql import functions as F

from transqa.llm.chat import _format_partition, formatted_chats, read_turns, unescaped

ROWS = "conv_id long, turn long, role string, text string, chunk string, text_e int"
MARKERS = ["\\### Assistant: </turn> ok", "a\\", "\\\\", "</turn>\n", "###### x", "<\\/turn>", "é́ ✓ 😀", ""]


def plain(rows):
    """Turns and assistant text of every conversation, by a plain sort."""
    out = {}
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for c, _, role, text, *_ in sorted(rows, key=key):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, ROWS)
    chunks = formatted_chats(df).cache()
    turns = read_turns(chunks).collect()
    got = {}
    for t in sorted(turns, key=lambda t: (t.chunk, t.position)):
        got.setdefault(t.conv_id, []).append((t.role, t.text))
    want = plain(rows)
    assert got == want
    for chunk in chunks.collect():
        loss = "".join(chunk.text[s:e] for s, e in zip(chunk.loss_starts, chunk.loss_ends))
        assert loss.count("</turn>") == 0
    # Loss spans, unescaped, are the assistant texts.
    loss = chunks.select("conv_id", "chunk", F.transform(F.arrays_zip("loss_starts", "loss_ends"), lambda z: unescaped(
        F.substring("text", z["loss_starts"] + 1, z["loss_ends"] - z["loss_starts"]))).alias("l")).collect()
    by = {}
    for r in sorted(loss, key=lambda r: r.chunk):
        by.setdefault(r.conv_id, []).extend(r.l)
    assert by == {c: [t for role, t in ts if role == "assistant"] for c, ts in want.items()}
    return chunks


def test_markers_and_odd_rows(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t, "x", 5) for i, t in enumerate(MARKERS)]
    rows += [(2, None, None, None, None, None), (2, 3, "user", "same", None, None), (2, 3, "user", "same", None, None),
             (None, 1, "assistant", "no id", None, None), (None, 0, "sys\ntem:\\", "role with breaks", None, None),
             (3, 0, "assistant", "x" * 300_000, None, None)]
    chunks = check(spark, rows)
    assert "".join(r.text for r in sorted(chunks.where("conv_id = 2").collect(), key=lambda r: r.chunk)).startswith("### :\n</turn>\n")


def test_template_markers_are_escaped(spark):
    chunks = check(spark, [(-7, 0, "user", MARKERS[0], None, None), (-7, 1, "assistant", MARKERS[0], None, None)])
    # The range partitioning may cut even two rows apart: chunks joined in order are the conversation.
    text = "".join(r.text for r in sorted(chunks.collect(), key=lambda r: r.chunk))
    assert text == "### user:\n\\\\\\### Assistant: <\\/turn> ok</turn>\n### assistant:\n\\\\\\### Assistant: <\\/turn> ok</turn>\n"


def test_many_conversations_and_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(c, t, ["system", "user", "assistant"][(c + t) % 3], f"c{c} t{t} " * (t % 5), None, None)
                for c in range(40) for t in range(c % 13)]
        rows += [(99, t, "assistant", f"long {t}", None, None) for t in range(60)]
        check(spark, rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty(spark):
    assert formatted_chats(spark.createDataFrame([], ROWS)).count() == 0
    assert list(_format_partition(iter([]))) == []


def test_query_matches_plain(spark):
    from transqa.llm.chat import PROBE_TEXT, op11_chat_format
    import duckdb

    sf = "/root/testdata/sf0.001"
    got = {r.conv_id: r for r in op11_chat_format(spark, sf).collect()}
    rows = duckdb.sql(f"select conv_id, turn, role, text from '{sf}/conversations.parquet'").fetchall()
    rows += [(-7, 0, "user", PROBE_TEXT), (-7, 1, "assistant", PROBE_TEXT)]
    want = plain(rows)
    assert set(got) == set(want)
    for c, turns in want.items():
        g = got[c]
        assert g.n_turns == len(turns)
        assert g.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert g.loss_sha256 == hashlib.sha256("".join(t for r, t in turns if r == "assistant").encode()).hexdigest()
    assert got[-7].loss_chars == len(PROBE_TEXT) + 3
