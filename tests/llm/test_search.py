"""Ranked lexical search against a plain scorer of every document, with blocks that are skipped."""

import math
import random
import re
from collections import Counter

from transqa.llm.search import build_index, search

DOCS = "doc_id long, text string, item_id string, block int"
ITEMS = "item_id long, text string, term string"
PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    if text is None:
        return []
    return PATTERN.findall(text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def plain(docs, items, k=50):
    live = [(i, d, words(t)) for i, (d, t, *_) in enumerate(docs) if words(t)]
    n_docs, length = len(live), sum(len(w) for _, _, w in live)
    df = Counter(t for _, _, w in live for t in set(w))
    out = []
    for item, text, *_ in items:
        q = set(words(text))
        scores = []
        for key, d, w in live:
            tf, m = Counter(w), 50 + (50 * len(w) * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m))
                    for t in q if t in tf)
            if s > 0:
                scores.append((-s, d is None, d if d is not None else 0, key, d, s))
        scores.sort()
        out += [(item, r + 1, d, s) for r, (*_, d, s) in enumerate(scores[:k])]
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_against_plain_scores(spark):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(300)] + ["Common", "ÉTÉ", "naïve", "x1y2"]
    docs = [(i, " ".join(rnd.choice(vocab[: 30 + i % 270]) for _ in range(rnd.randint(0, 60))), "clash", 1) for i in range(700)]
    docs += [(None, "common common w1", "c", 2), (5, docs[5][1], "c", 3), (800, None, None, None), (801, "", None, None),
             (802, "... ,,, !!!", None, None), (803, " ".join(["w7"] * 5000), None, None)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 12))), "t") for i in range(25)]
    items += [(100, None, None), (101, "", None), (102, "COMMON commons w1 W1", None), (103, "zzz-not-there", None)]
    index = build_index(spark.createDataFrame(docs, DOCS), block=8)
    got = sorted((tuple(r) for r in search(index, spark.createDataFrame(items, ITEMS), seeds=2).collect()),
                 key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert got == plain(docs, items)


def test_blocks_are_skipped(spark):
    # One rare term in a few documents: its blocks bound high, the rest bound low and are skipped.
    docs = [(i, "filler text words " * (1 + i % 4) + ("rare rare" if i % 97 == 0 else ""), None, None) for i in range(2000)]
    index = build_index(spark.createDataFrame(docs, DOCS), block=16)
    items = spark.createDataFrame([(1, "rare filler", None)], ITEMS)
    got = [tuple(r) for r in search(index, items, k=5).collect()]
    assert got == plain(docs, [(1, "rare filler")], k=5)


def test_empty(spark):
    index = build_index(spark.createDataFrame([], DOCS))
    assert index.count == 0
    assert search(index, spark.createDataFrame([(1, "a", None)], ITEMS)).count() == 0
