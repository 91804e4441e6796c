"""Word shingles as 64-bit hashes, computed over the bytes of a whole Arrow column.

Words are runs of anything but ASCII white space with A-Z lower-cased. All
arithmetic is modulo 2**64; two different shingles agree with probability 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
ROWS = 1 << 9       # sets of a batch at most: a sketch of one holds 16 kB
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_random = np.random.Generator(np.random.PCG64(20240501))
_BYTES = _random.integers(1, 2**63, 256, dtype=np.uint64)[_LOWER] * np.uint64(2) + np.uint64(1)
_STEPS = _random.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, 2 * SLICE)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows of about SLICE bytes: first row, bytes, and the rows' bounds in them.

    A text longer than that is a run of its own. Nulls are empty texts.
    """
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, bounds, data = texts.buffers()
    at = np.frombuffer(bounds, np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + SLICE, "right")) - 1)
        yield first, data[at[first]:at[last]], at[first:last + 1] - at[first]
        first = last


def words(data: np.ndarray, bounds: np.ndarray, blank: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of a run, their byte bounds, and the rows' bounds among the words."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, np.zeros(len(bounds), np.int64)
    solid = ~blank[data]
    fresh = np.ones(n + 1, bool)       # here a word cannot go on
    fresh[1:n] = ~solid[:-1]
    fresh[bounds] = True
    starts = np.flatnonzero(solid & fresh[:n])
    stop = np.ones(n + 1, bool)
    stop[:n] = ~solid
    stop[bounds] = True
    ends = np.flatnonzero(solid & stop[1:]) + 1
    up, down = _power(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[:n], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts])
    return hashes, starts, ends, np.searchsorted(starts, bounds)


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width``-word windows of each row, and the rows' bounds among them.

    A row of fewer words is one window of all its words; one without words has none.
    """
    count = np.diff(bounds)
    made = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    out = np.zeros(len(made) + 1, np.int64)
    np.cumsum(made, out=out[1:])
    row = np.repeat(np.arange(len(made)), made)
    start = bounds[:-1][row] + np.arange(out[-1]) - out[:-1][row]
    length = np.minimum(count[row], width)
    value = length.astype(np.uint64) * _STEPS[-1]
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    for j in range(width):
        value += np.where(j < length, padded[start + j], np.uint64(0)) * _STEPS[j]
    return mix(value), out


def distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's different values in order, and the rows' bounds among them."""
    parts = [np.unique(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    out = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=out[1:])
    return (np.concatenate(parts) if parts else values[:0]), out


class MinHash:
    """``size`` minima of hashed sets; rows without values get zeros."""

    def __init__(self, size: int, seed: int = 7):
        random = np.random.Generator(np.random.PCG64(seed))
        self.flips = random.integers(0, 2**63, size, dtype=np.uint64)
        self.steps = random.integers(1, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def minima(self, values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        out = np.zeros((len(bounds) - 1, len(self.steps)), np.uint64)
        full = np.flatnonzero(np.diff(bounds))
        if len(full):
            for k, (flip, step) in enumerate(zip(self.flips, self.steps, strict=True)):
                out[full, k] = np.minimum.reduceat((values ^ flip) * step, bounds[:-1][full])
        return out


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), signed(values))


def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Ids, values and bounds of batches of (id, full) of about SLICE bytes and at most ROWS rows."""
    for batch in batches:
        full = batch["full"]
        ends = np.cumsum(full.value_lengths().to_numpy(zero_copy_only=False))
        first = 0
        while first < len(full):
            base = ends[first - 1] if first else 0
            last = min(first + ROWS, max(first + 1, int(np.searchsorted(ends, base + SLICE // 8, "right"))))
            values = full.slice(first, last - first).flatten().to_numpy().view(np.uint64)
            yield batch["id"].slice(first, last - first), values, np.concatenate([[0], ends[first:last] - base])
            first = last
