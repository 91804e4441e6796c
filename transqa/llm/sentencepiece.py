"""SentencePiece encoding and decoding over a lattice of pieces.

For the words that a task has not met yet: all substrings up to the longest piece
are exploded, joined by hash with the piece table, grouped by word into a lattice of
edges, and folded from left to right to the best path. For unigram models the fold is
Viterbi over the scores. A BPE model's scores are merge ranks, whose best sum is not what its
encoder gives: there the fold applies, per word, the best edge that joins two
neighbouring pieces until none is left. Words do not touch: no piece holds the space mark after
another character, which is checked. The steps run over Arrow batches within tasks, so that
neither words nor texts are shuffled.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transqa.llm.common import read, tokenizer_file
from transqa.llm.shingles import mix

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, DEFINED, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2
_BASE = 0x9E3779B97F4A7C15
LONG = 96           # longer words are folded one by one
CHUNK = 1 << 17     # characters in one lattice
WORDS = 600_000     # words that a worker remembers


@dataclass
class Model:
    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    bpe: bool
    prefix: bool
    unknown: int

    @classmethod
    def load(cls, path: str) -> Model:
        from sentencepiece import sentencepiece_model_pb2 as format_

        with open(path, "rb") as file:
            told = format_.ModelProto.FromString(file.read())
        if told.normalizer_spec.precompiled_charsmap or told.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("models that rewrite their text are not read")
        if told.trainer_spec.model_type not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are read")
        kinds = [p.type for p in told.pieces]
        return cls([p.piece for p in told.pieces], [p.score for p in told.pieces], kinds,
                   told.trainer_spec.model_type == BPE, told.normalizer_spec.add_dummy_prefix,
                   kinds.index(UNKNOWN))


class Codec:
    """Encodes and decodes whole texts, remembering words."""

    def __init__(self, model: Model):
        self.model = model
        usable = [i for i, k in enumerate(model.kinds) if k in (NORMAL, DEFINED)]
        if any(MARK in p.lstrip(MARK) for p in (model.pieces[i] for i in usable)):
            raise ValueError("a piece spans words")
        self.longest = max(len(model.pieces[i]) for i in usable)
        self.scores = np.array(model.scores)
        hashes = self._hashes(*self._codes([model.pieces[i] for i in usable]))
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], np.array(usable, np.int64)[order]
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[hashes >> np.uint64(42)] = True
        self.by_text = {model.pieces[i]: i for i in usable}
        inner = {c for i in usable if len(model.pieces[i]) > 1 for c in model.pieces[i]}
        self.newline = "\n" not in inner       # then no piece reaches across one
        bytes_ = {model.pieces[i]: i for i, k in enumerate(model.kinds) if k == BYTE}
        self.bytes = [bytes_.get(f"<0x{b:02X}>", -1) for b in range(256)] if bytes_ else None
        self.low = min(self.scores[usable], default=0.0) - 10
        self.words: dict[str, bytes] = {}
        self.texts = [
            bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k in (CONTROL,) else
            " ⁇ ".encode() if k == UNKNOWN else p.replace(MARK, " ").encode()
            for p, k in zip(model.pieces, model.kinds, strict=True)]

    # --- encoding

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers; null and empty give none."""
        cut = [self._cut(t) if t else [] for t in texts]
        new = list(set().union(*cut).difference(self.words))
        if new:
            if len(self.words) > WORDS:
                self.words = {}
                new = list(set().union(*cut))
            self._learn(new)
        at = self.words.__getitem__
        return [b"".join(map(at, words)) for words in cut]

    def _cut(self, text: str) -> list[str]:
        """The words of a text, each without the space mark it begins with; '\\0' marks one
        that has none."""
        if self.model.prefix and "  " not in text and MARK not in text and text[-1] != " " and text[0] != " ":
            return text.split(" ")
        text = (MARK if self.model.prefix else "") + text.replace(" ", MARK)
        return [w[1:] if w[0] == MARK else "\0" + w for w in re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", text)]

    def _learn(self, words: list[str]) -> None:
        whole = [w[1:] if w[:1] == "\0" and len(w) > 1 else MARK + w for w in words]
        if self.newline:
            parts = [re.split("(\n)", w) if "\n" in w else [w] for w in whole]
        else:
            parts = [[w] for w in whole]
        new = list({p for some in parts for p in some if p})
        known = dict(zip(new, self._best(new), strict=True))
        known[""] = b""
        self.words.update((w, b"".join(known[p] for p in some)) for w, some in zip(words, parts, strict=True))

    def _best(self, words: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        some: list[int] = []
        size = 0
        for i in order:
            if len(words[i]) > LONG:
                out[i] = self._alone(words[i])
                continue
            some.append(i)
            size += len(words[i])
            if size >= CHUNK:
                self._together(words, some, out)
                some, size = [], 0
        if some:
            self._together(words, some, out)
        return out

    @staticmethod
    def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        bounds = np.zeros(len(words) + 1, np.int64)
        np.cumsum([len(w) for w in words], out=bounds[1:])
        return codes, bounds

    @staticmethod
    def _prefix(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(codes)
        up = np.full(n + 1, _BASE, np.uint64)
        up[0] = 1
        up = np.multiply.accumulate(up)
        down = np.full(n + 1, pow(_BASE, -1, 1 << 64), np.uint64)
        down[0] = 1
        down = np.multiply.accumulate(down)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(codes.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        return total, down

    def _hashes(self, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        total, down = self._prefix(codes)
        return mix((total[bounds[1:]] - total[bounds[:-1]]) * down[bounds[:-1]])

    def lattice(self, codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Explode the substrings of words and join them with the pieces: the piece's id by
        start and length, or -1. ``ends`` has the end of the word of each character."""
        total, down = self._prefix(codes)
        edges = np.full((len(codes), self.longest + 1), -1, np.int64)
        for length in range(1, self.longest + 1):
            start = np.flatnonzero(np.arange(len(codes)) + length <= ends)
            if not len(start):
                break
            h = mix((total[start + length] - total[start]) * down[start])
            hit = self.maybe[h >> np.uint64(42)]
            start, h = start[hit], h[hit]
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            same = self.hashes[at] == h
            edges[start[same], length] = self.ids[at[same]]
        return edges

    def _together(self, words: list[str], some: list[int], out: list[bytes]) -> None:
        codes, bounds = self._codes([words[i] for i in some])
        ends = np.repeat(bounds[1:], np.diff(bounds))
        edges = self.lattice(codes, ends)
        start, end = (self._merge if self.model.bpe else self._viterbi)(edges, bounds)
        ids = edges[start, end - start]
        pieces = self._spelled(ids, codes, start)
        first = np.searchsorted(start, bounds)
        for k, i in enumerate(some):
            a, b = first[k], first[k + 1]
            part = ids[a:b]
            out[i] = part.astype("<u4").tobytes() if (part >= 0).all() else b"".join(pieces[a:b])

    def _spelled(self, ids: np.ndarray, codes: np.ndarray, start: np.ndarray) -> dict | list:
        if (ids >= 0).all():
            return []
        return [struct.pack("<I", i) if i >= 0 else self._strange(chr(codes[s]))
                for i, s in zip(ids.tolist(), start.tolist(), strict=True)]

    def _strange(self, char: str) -> bytes:
        """A character without a piece: its bytes, or the unknown piece."""
        if self.bytes is None:
            return struct.pack("<I", self.model.unknown)
        return b"".join(struct.pack("<I", self.bytes[b]) for b in char.encode("utf-8", "surrogatepass"))

    def _merge(self, edges: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fold: in every word at once, the best edge over two neighbours, until none is left."""
        start = np.arange(len(edges))
        end = start + 1
        word = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(start) > 1:
            length = end[1:] - start[:-1]
            fits = (word[1:] == word[:-1]) & (length <= self.longest)
            score = np.full(len(start), -np.inf)
            at = np.flatnonzero(fits)
            piece = edges[start[at], length[at]]
            real = piece >= 0
            score[at[real]] = self.scores[piece[real]]
            begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.maximum.reduceat(score, begin)
            size = np.diff(np.append(begin, len(start)))
            over = np.repeat(best == -np.inf, size)
            if over.any():
                done.append((start[over], end[over]))
                keep = ~over
                start, end, word, score = start[keep], end[keep], word[keep], score[keep]
                size, best = size[best > -np.inf], best[best > -np.inf]
                if not len(start):
                    break
            top = np.flatnonzero(score == np.repeat(best, size))
            left = top[np.concatenate([[True], word[top[1:]] != word[top[:-1]]])]
            end[left] = end[left + 1]
            keep = np.ones(len(start), bool)
            keep[left + 1] = False
            start, end, word = start[keep], end[keep], word[keep]
        done.append((start, end))
        start, end = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(start)
        return start[order], end[order]

    def _viterbi(self, edges: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fold: position by position, in every word at once, the best way to reach it."""
        n = len(edges)
        score = np.where(edges >= 0, self.scores[edges], -np.inf)
        score[:, 1] = np.where(edges[:, 1] >= 0, score[:, 1], self.low)
        sizes = np.diff(bounds)
        best = np.full((len(sizes), int(sizes.max()) + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros(best.shape, np.int64)
        for place in range(1, best.shape[1]):
            rows = np.flatnonzero(sizes >= place)
            for length in range(1, min(self.longest, place) + 1):
                value = best[rows, place - length] + score[bounds[rows] + place - length, length]
                better = value > best[rows, place]
                best[rows[better], place] = value[better]
                back[rows[better], place] = length
        start = []
        place, rows = sizes.copy(), np.arange(len(sizes))
        while len(rows):
            length = back[rows, place[rows]]
            place[rows] -= length
            start.append(bounds[rows] + place[rows])
            rows = rows[place[rows] > 0]
        start = np.sort(np.concatenate(start))
        return start, np.append(start[1:], n)

    def _alone(self, word: str) -> bytes:
        """A long word: Viterbi in pieces of memory, or merges from a heap."""
        if not self.model.bpe:
            out = [b""]
            self._together([word], [0], out)
            return out[0]
        symbols: list[str | None] = list(word)
        after = list(range(1, len(word) + 1))
        before = list(range(-1, len(word) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(symbols):
                both = symbols[i] + symbols[j]
                piece = self.by_text.get(both)
                if piece is not None:
                    heapq.heappush(heap, (-self.scores[piece], i, both))

        for i in range(len(word)):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i] if symbols[i] is not None else len(symbols)
            if j >= len(symbols) or symbols[i] + symbols[j] != both:
                continue
            symbols[i], symbols[j] = both, None
            after[i] = after[j]
            if after[j] < len(symbols):
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return b"".join(
            struct.pack("<I", self.by_text[s]) if s in self.by_text else self._strange(s)
            for s in symbols if s is not None)

    # --- decoding

    def decode(self, ids: list[bytes | None]) -> list[str]:
        """Texts of id sequences. The space of the dummy prefix goes; bytes that are no UTF-8
        become U+FFFD."""
        table, out = self.texts, []
        for some in ids:
            text = b"".join(map(table.__getitem__, np.frombuffer(some or b"", "<u4").tolist()))
            text = text.decode("utf-8", "replace")
            out.append(text[1:] if self.model.prefix and text[:1] == " " else text)
        return out


_codecs: dict[str, Codec] = {}


def _codec(shared) -> Codec:
    """The worker's codec, kept for its next tasks with the words it has met; another model's goes."""
    if shared.id not in _codecs:
        _codecs.clear()
        _codecs[shared.id] = Codec(shared.value)
    return _codecs[shared.id]


class _Shared:
    """A model of fixed size, sent to the workers once."""

    def __init__(self, spark: SparkSession, model: Model):
        self.held = spark.sparkContext.broadcast(model)
        self.id = hashlib.sha256(repr(model).encode()).hexdigest()     # the same in every session and run

    @property
    def value(self) -> Model:
        return self.held.value


def encoded(docs: DataFrame, model: Model, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Replace the text column by its ids, little-endian unsigned 32-bit integers as bytes.

    Null and empty texts have no ids. All other columns stay, whatever their names; rows
    are independent, so repeats and ties make no difference.
    """
    return _mapped(docs, model, text_col, ids_col, "binary", lambda codec, x: codec.encode(x.to_pylist()))


def decoded(rows: DataFrame, model: Model, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """Replace ids by their text; null and empty ids give an empty text.

    A text comes back as it was, unless it held the space mark itself, which is read as a space.
    """
    return _mapped(rows, model, ids_col, text_col, "string", lambda codec, x: codec.decode(x.to_pylist()))


def _mapped(df: DataFrame, model: Model, old: str, new: str, kind: str, body) -> DataFrame:
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string

    at = df.columns.index(old)
    fields = list(df.schema.fields)
    fields[at] = StructField(new, _parse_datatype_string(kind))
    shared = _Shared(df.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                some = batch.slice(lo, 512)
                columns = list(some.columns)
                columns[at] = pa.array(body(codec, columns[at]), pa.binary() if kind == "binary" else pa.string())
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return df.mapInArrow(run, StructType(fields))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents, decode the ids again, and compare checksums."""
    model = Model.load(tokenizer_file("piece_bpe_32k.model"))
    docs = read(spark, sf_dir, "documents").select("doc_id", "text").withColumn(
        "text_crc32", F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")))
    ids = encoded(docs, model).withColumn("n_ids", (F.octet_length("ids") / 4).cast("long")).withColumn(
        "ids_crc32", F.crc32("ids"))
    return decoded(ids, model).select(
        "doc_id", "n_ids", "ids_crc32",
        (F.crc32(F.encode("text", "UTF-8")) == F.col("text_crc32")).alias("round_trip"))
