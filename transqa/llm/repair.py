"""Conversation structure repair by a grammar-compressed min-plus DP.

A conversation is a sequence of rows; each row becomes one of nine symbols: forced deletion (blank or
duplicate), or its role initial (s, u, a, other) with or without a truncation. Every symbol has a 4 x 4
transfer matrix over the states of the target grammar ``(s?(ua)+)?`` (start, after s, after u, after a),
whose entries are (cost, audit): the cheapest edits, inserts before the row included, and their
initials. Matrices multiply in the (min, +) sense, ties broken by the ASCII-least audit; as no two
cheapest audits of one entry are prefixes of each other (extra letters would be inserts, which cost),
the product keeps the exact ASCII-least audit.

Symbol sequences are compressed by Re-Pair (the most frequent adjacent pair becomes a rule, repeatedly);
each rule's matrix is the product of its children's, made once bottom-up and shared by all
conversations a Python worker sees. A conversation's matrix is the product over its compressed sequence,
followed by the closure of inserts at the end; the answer is its cheapest entry from the start state to
an accepting one.

Odd rows: null conv_id, turn, role or text count as one space in the damage key and as values (so a
null text is blank and a null role has initial ' '); rows sort by turn (nulls first), then role, text;
repeated rows stay rows. Conversations whose rows are all dropped by damage give zeros, an empty audit
and the hash of the empty string. Extra columns are ignored; an empty table gives no row.

Scale: damage, faults and ordering keys are JVM expressions; the DP runs per conversation in
``applyInPandas``, so one conversation is held by one task.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transqa.llm.common import read

# Fixed values of the contract.
SPACE = r"[\x20\x09-\x0D]"
ENDS = "[.!?]"
ALLOWED = {"su", "ua", "au"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

START, AFTER_S, AFTER_U, AFTER_A = range(4)
ACCEPTING = (START, AFTER_A)
INF = float("inf")

OUT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
       "audit string, repaired_sha256 string")


def damaged(convs: DataFrame) -> DataFrame:
    """Rows after damage: conv_id, turn, role, text, uid (copies of a repeated row differ only in uid)."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = convs.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        (F.crc32(F.encode(key, "UTF-8")) % 20).alias("h"),
        F.monotonically_increasing_id().alias("uid"),
    ).where("h != 0").withColumn(
        "copy", F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("h") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("h") == 1, F.lit("")).when(F.col("h") == 2, F.regexp_replace("text", ENDS, ""))
         .otherwise(F.col("text")).alias("text"),
        (F.col("uid") * 2 + F.col("copy")).alias("uid"),
    )


def step(state: int, initial: str) -> int | None:
    if initial == "s":
        return AFTER_S if state == START else None
    if initial == "u":
        return AFTER_U if state in (START, AFTER_S, AFTER_A) else None
    if initial == "a":
        return AFTER_A if state == AFTER_U else None
    return None


Matrix = list  # 4 x 4 of (cost, audit)


def _better(x, y):
    return x if (x[0], x[1]) <= (y[0], y[1]) else y


def multiply(a: Matrix, b: Matrix) -> Matrix:
    out = []
    for i in range(4):
        row = []
        for j in range(4):
            best = (INF, "")
            for k in range(4):
                if a[i][k][0] < INF and b[k][j][0] < INF:
                    best = _better(best, (a[i][k][0] + b[k][j][0], a[i][k][1] + b[k][j][1])) if best[0] < INF else \
                        (a[i][k][0] + b[k][j][0], a[i][k][1] + b[k][j][1])
            row.append(best)
        out.append(row)
    return out


def _inserts() -> Matrix:
    """Cheapest runs of inserted user or assistant rows between two states."""
    m = [[(0, "") if i == j else (INF, "") for j in range(4)] for i in range(4)]
    for _ in range(3):
        grown = [row[:] for row in m]
        for i in range(4):
            for k in range(4):
                if m[i][k][0] == INF:
                    continue
                for role in "ua":
                    j = step(k, role)
                    if j is not None:
                        cand = (m[i][k][0] + INSERT, m[i][k][1] + "I")
                        grown[i][j] = cand if grown[i][j][0] == INF else _better(grown[i][j], cand)
        m = grown
    return m


CLOSURE = _inserts()


def _symbol_matrix(symbol: int) -> Matrix:
    """Symbol 0: forced delete; 1 + 2 * initial + truncated for initial in s, u, a, other."""
    row = [[(INF, "")] * 4 for _ in range(4)]
    for p in range(4):
        row[p][p] = (DELETE, "D")
    if symbol:
        initial, truncated = "suao"[(symbol - 1) // 2], (symbol - 1) % 2
        extra = TRUNCATED * truncated
        for p in range(4):
            q = step(p, initial)
            if q is not None:
                row[p][q] = _better(row[p][q], (KEEP + extra, "K")) if row[p][q][0] < INF else (KEEP + extra, "K")
            for role in "ua":
                q = step(p, role)
                if q is not None:
                    cand = (REROLE + extra, "R")
                    row[p][q] = _better(row[p][q], cand) if row[p][q][0] < INF else cand
    return multiply(CLOSURE, row)


class Grammar:
    """Re-Pair rules and their matrices, shared by the conversations of one worker."""

    #: Solved sequences kept per worker; conversations of one shape are solved once.
    MEMO = 50_000

    def __init__(self):
        self.matrices: dict[int, Matrix] = {s: _symbol_matrix(s) for s in range(9)}
        self.rules: dict[tuple[int, int], int] = {}
        self.solved: dict[tuple[int, ...], tuple[int, str]] = {}

    def rule(self, pair: tuple[int, int]) -> int:
        found = self.rules.get(pair)
        if found is None:
            found = len(self.matrices)
            self.rules[pair] = found
            self.matrices[found] = multiply(self.matrices[pair[0]], self.matrices[pair[1]])
        return found

    def compress(self, seq: list[int], rounds: int = 64) -> list[int]:
        for _ in range(rounds):
            if len(seq) < 3:
                break
            pair, count = Counter(zip(seq, seq[1:])).most_common(1)[0]
            if count < 2:
                break
            symbol, out, i = self.rule(pair), [], 0
            while i < len(seq):
                if i + 1 < len(seq) and (seq[i], seq[i + 1]) == pair:
                    out.append(symbol)
                    i += 2
                else:
                    out.append(seq[i])
                    i += 1
            seq = out
        return seq

    def solve(self, seq: list[int]) -> tuple[int, str]:
        shape = tuple(seq)
        found = self.solved.get(shape)
        if found is None:
            if len(self.solved) >= self.MEMO:
                self.solved.clear()
            found = self.solved[shape] = self._solve(seq)
        return found

    def _solve(self, seq: list[int]) -> tuple[int, str]:
        m = CLOSURE
        for s in self.compress(seq):
            m = multiply(m, self.matrices[s])
        m = multiply(m, CLOSURE)
        best = (INF, "")
        for q in ACCEPTING:
            if m[START][q][0] < INF:
                best = m[START][q] if best[0] == INF else _better(best, m[START][q])
        return int(best[0]), best[1]


_GRAMMAR: Grammar | None = None


def repaired_lines(roles: list[str], texts: list[str], audit: str) -> list[str]:
    lines, state, row = [], START, 0
    for letter in audit:
        if letter == "D":
            row += 1
            continue
        if letter == "K":
            role, text = roles[row], texts[row]
            row += 1
        else:
            role = "assistant" if state == AFTER_U else "user"
            text = "" if letter == "I" else texts[row]
            row += 0 if letter == "I" else 1
        state = step(state, role[:1])
        lines.append(f"{role}:{text}")
    return lines


def repair_one(rows) -> dict:
    """Counts, cheapest repair and its digest for the damaged rows of one conversation, in order."""
    global _GRAMMAR
    if _GRAMMAR is None:
        _GRAMMAR = Grammar()
    roles, texts = list(rows["role"]), list(rows["text"])
    turns = [int(t) for t in rows["turn"] if not pd.isna(t)]
    seen, symbols = set(), []
    blank = duplicate = truncated = 0
    import re

    word, ending = re.compile(r"[^\x20\x09-\x0D]"), re.compile(r"[.!?][\x20\x09-\x0D]*\Z")
    for role, text in zip(roles, texts):
        initial = role[:1]
        if not word.search(text):
            blank += 1
            symbols.append(0)
        elif (role, text) in seen:
            duplicate += 1
            symbols.append(0)
        else:
            cut = ending.search(text) is None
            truncated += cut
            symbols.append(1 + 2 * "suao".index(initial if initial in "sua" else "o") + cut)
        seen.add((role, text))
    illegal = sum(1 for a, b in zip(roles, roles[1:]) if a[:1] + b[:1] not in ALLOWED)
    gaps = (int(max(turns)) - int(min(turns)) + 1 - len(set(turns))) if turns else 0
    cost, audit = _GRAMMAR.solve(symbols)
    digest = hashlib.sha256("\n".join(repaired_lines(roles, texts, audit)).encode()).hexdigest()
    return dict(gaps=gaps, blank=blank, duplicate=duplicate, truncated=truncated, illegal=illegal,
                cost=cost, audit=audit, repaired_sha256=digest)


def _repair_group(key, rows: pd.DataFrame) -> pd.DataFrame:
    present = rows["present"].tolist()
    turn, role, text, uid = (rows[c].tolist() for c in ("turn", "role", "text", "uid"))
    keep = [i for i in range(len(present)) if present[i]]
    # Turn (nulls first), role, text, then the copy: a plain sort, cheaper than a frame's.
    keep.sort(key=lambda i: (not pd.isna(turn[i]), 0 if pd.isna(turn[i]) else turn[i], role[i], text[i], uid[i]))
    out = repair_one({"turn": [turn[i] for i in keep], "role": [role[i] for i in keep], "text": [text[i] for i in keep]})
    return pd.DataFrame([dict(conv_id=key[0], **out)])


def repaired(convs: DataFrame) -> DataFrame:
    """One row per original conversation (conv_id): gaps, faults, illegal pairs, cost, audit, digest."""
    ids = convs.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    rows = damaged(convs).withColumn("present", F.lit(True))
    # Conversations whose rows were all dropped still answer, with no row.
    holders = ids.join(rows.select("conv_id").distinct(), ids.conv_id.eqNullSafe(rows.conv_id), "left_anti").select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit(" ").alias("role"), F.lit(" ").alias("text"),
        F.lit(None).cast("long").alias("uid"), F.lit(False).alias("present"))
    return rows.unionByName(holders).groupBy("conv_id").applyInPandas(_repair_group, OUT)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(read(spark, sf_dir, "conversations"))
