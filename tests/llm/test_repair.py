"""Conversation repair against a plain suffix DP over rows, with damage recomputed in Python."""

import hashlib
import itertools
import random
import re
import zlib

import pandas as pd

from transqa.llm.repair import repair_one, repaired

ROWS = "conv_id long, turn long, role string, text string, uid string"
ALLOWED = {"su", "ua", "au"}


def nxt(q, r):
    return {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}.get((q, r))


def plain_dp(roles, symbols):
    """best[i][q]: cheapest (cost, audit) for rows i.. from state q, by relaxation; symbols: 'X' or (initial, cut)."""
    n, inf = len(roles), (10**9, "")
    best = [dict() for _ in range(n + 1)]
    best[n] = {q: ((0, "") if q in "0A" else inf) for q in "0SUA"}
    for i in range(n, -1, -1):
        if i < n:
            for q in "0SUA":
                opts = [(4 + best[i + 1][q][0], "D" + best[i + 1][q][1])]
                if symbols[i] != "X":
                    initial, cut = symbols[i]
                    q2 = nxt(q, initial)
                    if q2:
                        opts.append((3 * cut + best[i + 1][q2][0], "K" + best[i + 1][q2][1]))
                    for r in "ua":
                        q2 = nxt(q, r)
                        if q2:
                            opts.append((3 + 3 * cut + best[i + 1][q2][0], "R" + best[i + 1][q2][1]))
                best[i][q] = min(opts)
        for _ in range(6):
            for q in "0SUA":
                for r in "ua":
                    q2 = nxt(q, r)
                    if q2 and best[i][q2][0] < 10**9:
                        best[i][q] = min(best[i][q], (3 + best[i][q2][0], "I" + best[i][q2][1]))
    return best[0]["0"]


def plain(rows):
    out = {}
    for conv, group in itertools.groupby(sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)), key=lambda r: r[0]):
        damaged = []
        for c, t, role, text, *_ in group:
            h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
            role, text = role if role is not None else " ", text if text is not None else " "
            if h == 0:
                continue
            text = "" if h == 1 else re.sub(r"[.!?]", "", text) if h == 2 else text
            role = "user" if h == 4 else role
            damaged += [(t, role, text)] * (2 if h == 3 else 1)
        damaged.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        roles, texts = [r[1] for r in damaged], [r[2] for r in damaged]
        seen, symbols, counts = set(), [], [0, 0, 0]
        for role, text in zip(roles, texts):
            if not re.search(r"[^\x20\x09-\x0D]", text):
                counts[0] += 1
                symbols.append("X")
            elif (role, text) in seen:
                counts[1] += 1
                symbols.append("X")
            else:
                cut = not re.search(r"[.!?][\x20\x09-\x0D]*\Z", text)
                counts[2] += cut
                symbols.append((role[:1], int(cut)))
            seen.add((role, text))
        turns = [r[0] for r in damaged if r[0] is not None]
        cost, audit = plain_dp(roles, symbols)
        out[conv] = (conv, (max(turns) - min(turns) + 1 - len(set(turns))) if turns else 0, *counts,
                     sum(1 for a, b in zip(roles, roles[1:]) if a[:1] + b[:1] not in ALLOWED), cost, audit)
    return out


def test_against_plain_dp(spark):
    rnd = random.Random(3)
    rows = []
    for c in range(120):
        for t in range(rnd.randint(1, 14)):
            role = rnd.choice(["system", "user", "assistant", "assistant", "user", "tool", None])
            text = rnd.choice(["Hello there.", "ok", "   ", None, "Same!", "Same!", "what?", "line\n.", "é ✓"])
            rows.append((c, rnd.choice([t, t, t, None, t + 3]), role, text, "x"))
    rows += [(None, 1, "user", "no id.", None), (None, None, None, None, None), (500, 1, "user", "hi.", None)]
    rows += [(c, t, "user", "drop me", None) for c, t in [(7001, 0)] if zlib.crc32(b"7001:0") % 20 == 0] or []
    got = {r.conv_id: tuple(r)[:8] for r in repaired(spark.createDataFrame(rows, ROWS)).collect()}
    want = plain(rows)
    assert set(got) == set(want)
    for conv, w in want.items():
        assert got[conv] == w, conv


def test_all_rows_dropped_and_digest():
    empty = repair_one(pd.DataFrame({"role": [], "text": [], "turn": []}))
    assert (empty["cost"], empty["audit"], empty["gaps"]) == (0, "", 0)
    assert empty["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    one = repair_one(pd.DataFrame({"role": ["user"], "text": ["hi."], "turn": [1]}))
    assert (one["cost"], one["audit"]) == (3, "KI")
    assert one["repaired_sha256"] == hashlib.sha256(b"user:hi.\nassistant:").hexdigest()


def test_long_conversation():
    n = 3000
    rows = pd.DataFrame({"role": ["user", "assistant"] * (n // 2), "text": [f"t{i}." for i in range(n)], "turn": range(n)})
    out = repair_one(rows)
    assert (out["cost"], out["audit"]) == (0, "K" * n)


def test_empty_table(spark):
    assert repaired(spark.createDataFrame([], ROWS)).count() == 0


def test_query_matches_plain(spark):
    import duckdb

    from transqa.llm.repair import op13_conversation_repair

    sf = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"select conv_id, turn, role, text from '{sf}/conversations.parquet'").fetchall()
    got = {r.conv_id: tuple(r)[:8] for r in op13_conversation_repair(spark, sf).collect()}
    assert got == plain(rows)
