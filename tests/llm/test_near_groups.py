"""Groups of near copies that their bucket's smallest member does not hold together."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa

from transqa.llm import minhash


def test_a_run_gives_fewer_pairs_than_groups():
    n = 200
    none, ids = pa.array(np.zeros(n, np.int64)), pa.array(np.arange(1, n + 1))
    batch = pa.RecordBatch.from_arrays(
        [none, none, none, none, ids, none, ids,
         pa.array([bytes(2 * minhash.SYMBOLS)] * n), pa.array([bytes(minhash.BITS // 8)] * n)],
        ["key", "block_a", "block_b", "block", "id", "hub", "label", "symbols", "sketch"])
    kernel = minhash.near_pairs(minhash.most_apart(80), np.uint16, minhash._first_key, groups=True)
    pairs = [p for out in kernel(iter([batch])) for p in zip(
        out["a"].to_pylist(), out["b"].to_pylist(), strict=True)]
    assert len(pairs) == n - 1 and {x for p in pairs for x in p} == set(range(1, n + 1))


def test_loose_group_as_by_brute_force(spark, monkeypatch):
    """Members about 0.75 to 0.85 alike, so that many pairs miss the limit; no list of such pairs is joined."""
    joined = []
    confirmed = minhash.confirmed
    monkeypatch.setattr(minhash, "confirmed", lambda pairs, *rest: joined.append(pairs.count()) or confirmed(pairs, *rest))
    rnd, words, texts = random.Random(4), [f"g{j}" for j in range(400)], {}
    for i in range(150):
        changed = set(rnd.sample(range(400), 4 + i % 7))
        texts[i] = " ".join(f"c{i}_{j}" if j in changed else w for j, w in enumerate(words))
    sets = {i: {tuple(t.split()[j:j + 4]) for j in range(397)} for i, t in texts.items()}
    group = {i: i for i in texts}
    for a, b in combinations(texts, 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and group[a] != group[b]:
            low, high = sorted((group[a], group[b]))
            group = {i: low if g == high else g for i, g in group.items()}
    got = minhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), words=4)
    assert {r.doc_id: r.component_id for r in got.collect()} == group
    assert 1 < len(set(group.values())) < len(texts)
    assert sum(joined) <= minhash.CHUNKS * minhash.WIDTH * len(texts)
