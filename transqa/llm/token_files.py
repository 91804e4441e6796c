"""Token ids in files of shuffled planes.

Ids are written in blocks of ``BLOCK`` unsigned 32-bit integers. A block is transposed into
planes: its first bytes, its second bytes and so on (or its single bits), each compressed
with zstandard; the high planes of a small vocabulary then cost nothing. A file ends
with an index of its blocks and planes, its documents and their lengths, and a folder's
manifest gives the files in order with the number of ids before each.

layout: magic, blocks of planes, index (zstandard JSON), length of the index (8 bytes), magic
"""

from __future__ import annotations

import json
import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage,
)

from transqa.llm import files
from transqa.llm.common import new_folder, read, tokenizer_file

MAGIC = b"PLANES01"
BLOCK = 1 << 18
FILE = 1 << 25          # ids of a file
BATCH = 1 << 20         # ids of a batch that is read
CALL = 1 << 22          # bytes of texts encoded at once, about
SCHEMA = "doc_id long, start long, ids binary"


def shuffle(ids: np.ndarray, planes: str) -> list[bytes]:
    """The byte or bit planes of a block."""
    rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    if planes == "bit":
        bits = np.unpackbits(np.ascontiguousarray(rows), axis=1, bitorder="little").reshape(4, -1, 8)
        rows = np.packbits(bits.transpose(0, 2, 1).reshape(32, -1), axis=1, bitorder="little")
    return [np.ascontiguousarray(r).tobytes() for r in rows]


def unshuffle(planes: list[bytes], n: int) -> np.ndarray:
    rows = np.stack([np.frombuffer(p, np.uint8) for p in planes])
    if len(planes) == 32:
        bits = np.unpackbits(rows, axis=1, bitorder="little", count=n).reshape(4, 8, n)
        rows = np.packbits(bits.transpose(0, 2, 1).reshape(4, -1), axis=1, bitorder="little")
    return np.ascontiguousarray(rows.T).view("<u4").ravel()


class PlaneSource(DataSource):
    """Options: path; planes, 'byte' or 'bit'; level of compression."""

    @classmethod
    def name(cls) -> str:
        return "token_planes"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PlaneReader(self.options["path"])

    def writer(self, schema, overwrite) -> DataSourceArrowWriter:
        return PlaneWriter(self.options["path"], self.options.get("planes", "byte"), int(self.options.get("level", 3)))


@dataclass
class Written(WriterCommitMessage):
    part: int
    files: list[dict]


class _File:
    def __init__(self, system, root: str, planes: str, level: int):
        self.name, self.planes = files.new_name(".planes"), planes
        self.pack = zstandard.ZstdCompressor(level=level)
        self.out = system.open_output_stream(f"{root}/{self.name}", compression=None)
        self.at = self.out.write(MAGIC)
        self.blocks: list[list] = []
        self.docs: list[int | None] = []
        self.lengths: list[int] = []
        self.rest, self.held, self.ids = [], 0, 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append(doc_id)
        self.lengths.append(len(ids) // 4)
        self.rest.append(ids)
        self.held += len(ids)
        self.ids += len(ids) // 4
        if self.held >= 4 * BLOCK:
            data = b"".join(self.rest)
            whole = len(data) // (4 * BLOCK) * 4 * BLOCK
            for lo in range(0, whole, 4 * BLOCK):
                self._block(data[lo:lo + 4 * BLOCK])
            self.rest, self.held = [data[whole:]], len(data) - whole

    def _block(self, data: bytes) -> None:
        planes = [self.pack.compress(p) for p in shuffle(np.frombuffer(data, "<u4"), self.planes)]
        self.blocks.append([self.at, len(data) // 4, [len(p) for p in planes]])
        self.at += self.out.write(b"".join(planes))

    def close(self) -> dict:
        if self.held:
            self._block(b"".join(self.rest))
        index = self.pack.compress(json.dumps(
            {"planes": self.planes, "blocks": self.blocks, "docs": self.docs, "lengths": self.lengths}).encode())
        self.out.write(index + struct.pack("<Q", len(index)) + MAGIC)
        self.out.close()
        return {"name": self.name, "ids": self.ids, "docs": len(self.docs)}


@dataclass
class PlaneWriter(DataSourceArrowWriter):
    place: str
    planes: str
    level: int

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        system, root = files.store(self.place)
        system.create_dir(root, recursive=True)
        done, file = [], None
        for batch in iterator:
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), batch["ids"], strict=True):
                file = file or _File(system, root, self.planes, self.level)
                file.add(doc_id, ids.as_py() or b"")
                if file.ids >= FILE:
                    done.append(file.close())
                    file = None
        if file:
            done.append(file.close())
        return Written(TaskContext.get().partitionId(), done)

    def commit(self, messages: list) -> None:
        listed, start = [], 0
        for message in sorted((m for m in messages if m), key=lambda m: m.part):
            for file in message.files:
                listed.append({**file, "start": start})
                start += file["ids"]
        files.write_manifest(self.place, {"files": listed, "ids": start})

    def abort(self, messages: list) -> None:
        """Nothing to undo: files without a manifest entry are never read."""


@dataclass
class Piece(InputPartition):
    name: str
    start: int


@dataclass
class PlaneReader(DataSourceReader):
    place: str

    def partitions(self):
        return [Piece(f["name"], f["start"]) for f in files.read_manifest(self.place)["files"]] or [Piece("", 0)]

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        system, root = files.store(self.place)
        with system.open_input_file(f"{root}/{partition.name}") as source:
            size = source.size()
            length, magic = struct.unpack("<Q8s", source.read_at(16, size - 16))
            if magic != MAGIC:
                raise ValueError(f"{partition.name} is no file of token planes")
            unpack = zstandard.ZstdDecompressor()
            index = json.loads(unpack.decompress(source.read_at(length, size - 16 - length)))
            docs, lengths = index["docs"], np.array(index["lengths"], np.int64)
            ends = np.cumsum(lengths)
            blocks, held, base, doc = iter(index["blocks"]), b"", 0, 0
            while doc < len(docs):
                last = max(doc + 1, int(np.searchsorted(ends, base + BATCH, "right")))
                need = 4 * int(ends[last - 1] - base)
                parts, have = [held], len(held)
                while have < need:
                    at, n, sizes = next(blocks)
                    data, planes, lo = source.read_at(sum(sizes), at), [], 0
                    for s in sizes:
                        planes.append(unpack.decompress(data[lo:lo + s]))
                        lo += s
                    parts.append(unshuffle(planes, n).tobytes())
                    have += 4 * n
                data = b"".join(parts)
                held = data[need:]
                bounds = np.concatenate([[0], np.cumsum(4 * lengths[doc:last])])
                ids = pa.Array.from_buffers(pa.large_binary(), last - doc, [
                    None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data[:need])]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs[doc:last], pa.int64()),
                    pa.array(partition.start + ends[doc:last] - lengths[doc:last]), ids],
                    ["doc_id", "start", "ids"])
                base, doc = int(ends[last - 1]), last


class Encoder:
    """Whole texts to ids by the tokenizers library, each different piece encoded once.

    Byte-level BPE never joins what its splitting pattern parts. It always parts before white
    space that follows another character, before the last white space of a run that goes on
    with another character, after that one if it is no space, and between letters or digits
    and punctuation (but the apostrophe). A text is cut there, so it is the sum of its pieces;
    a call's different pieces are looked up as one column, and those not met before go to the
    library many in one text. There a piece begins with the only token that begins with its
    lead, a space or a line feed; where that does not hold, they go one by one. In texts with
    white space beyond ASCII, only what lies between ASCII characters is cut. Texts of other
    tokenizers or with special tokens go to the library whole.
    """

    # Most words come once, and frequent ones in every call: pieces held, what a call that
    # does not meet one leaves of its worth, and pieces of a text for the library.
    WORDS, FADE, TOGETHER = 200_000, 0.9, 256
    # What a byte is (OTHER: the apostrophe, control characters, all beyond ASCII).
    OTHER, ALNUM, MARK, SPACE, BREAK = range(5)
    KINDS = bytes(
        4 if b in b"\t\n\v\f\r" else 3 if b == 32 else 1 if b < 128 and chr(b).isalnum()
        else 2 if 32 < b < 127 and b != 39 else 0 for b in range(256))
    # Which neighbours (5 * kind + next kind) are parted; wary: whatever OTHER may be.
    PARTED = bytes(b >= 3 > a or (a == 4 and b < 3) or {a, b} == {1, 2} for a in range(5) for b in range(5)).ljust(256, b"\0")
    WARY = bytes(p and k > 4 and k % 5 > 0 for k, p in enumerate(PARTED))
    # White space beyond ASCII, and what other patterns take for it.
    ODD = "\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

    def __init__(self, model: str, end_id: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(model)
        told = json.loads(model)
        split = told.get("pre_tokenizer") or {}
        self.by_piece = (
            told.get("normalizer") is None and split.get("type") == "ByteLevel"
            and not split.get("add_prefix_space") and split.get("use_regex", True))
        self.special = [t["content"] for t in told.get("added_tokens", [])]
        size = self.library.get_vocab_size(with_added_tokens=True)
        tokens = [self.library.id_to_token(i) or "" for i in range(size)]
        self.begins = {lead: np.array([t.startswith(sign) for t in tokens], bool)
                       for lead, sign in ((" ", "\u0120"), ("\n", "\u010a"))}
        self.end = b"" if end_id is None else struct.pack("<I", end_id)
        # The pieces held, their ids and in how many calls they were met, late calls counting most.
        self.words = pa.array([], pa.large_string())
        self.ids = pa.array([], pa.large_binary())
        self.met = np.zeros(0)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        return self.column(pa.array(texts, pa.large_string())).to_pylist()

    def column(self, texts: pa.Array) -> pa.Array:
        """The ids of each text (null: empty), the end id after them."""
        texts = texts.cast(pa.large_string()).fill_null("")
        odd = pc.match_substring_regex(texts, f"[{self.ODD}]").to_numpy(zero_copy_only=False)
        whole = np.full(len(texts), not self.by_piece)
        for token in self.special:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        way = np.where(whole, 2, odd)
        if not way.any():
            return self._by_piece(texts)
        plain, odd, whole = (texts.filter(pa.array(way == k)) for k in range(3))
        out = pa.concat_arrays([
            self._by_piece(plain), self._by_piece(odd, wary=True),
            pa.array([i + self.end for i in self._library(whole.to_pylist())], pa.large_binary())])
        place = np.empty(len(texts), np.int64)
        place[np.argsort(way, kind="stable")] = np.arange(len(texts))
        return out.take(pa.array(place))

    def _by_piece(self, texts: pa.Array, wary: bool = False) -> pa.Array:
        bounds = _offsets(texts)
        data = (texts.buffers()[2] or pa.py_buffer(b"")).slice(bounds[0], bounds[-1] - bounds[0])
        bounds = bounds - bounds[0]
        at = self._cuts(data, bounds, wary)
        coded = _column(pa.large_string(), np.append(at, len(data)), data).dictionary_encode()
        ids = pa.concat_arrays([self._known(coded.dictionary), pa.array([self.end], pa.large_binary())])
        last = np.searchsorted(at, bounds)[1:]      # pieces up to each text's end
        codes = np.insert(coded.indices.to_numpy(), last, len(ids) - 1)
        flat = ids.take(pa.array(codes))
        stops = _offsets(flat)[np.append(0, last + np.arange(1, len(texts) + 1))]
        return _column(pa.large_binary(), stops, flat.buffers()[2])

    def _cuts(self, data: pa.Buffer, bounds: np.ndarray, wary: bool) -> np.ndarray:
        """Where pieces begin, in texts that end at ``bounds``."""
        text, n = np.frombuffer(data, np.uint8), len(data)
        kind = np.frombuffer(data.to_pybytes().translate(self.KINDS), np.uint8)
        pair = kind[:-1] * np.uint8(5) + kind[1:]
        cut = np.zeros(n, bool)
        cut[1:] = np.frombuffer(pair.tobytes().translate(self.WARY if wary else self.PARTED), bool)
        last = np.zeros(n + 1, bool)
        last[bounds] = True
        # The last of several white spaces, unless they end the text.
        white = np.flatnonzero(pair >= 18) + 1
        white = white[(kind[white - 1] >= self.SPACE) & (kind[white] >= self.SPACE) & ~last[white + 1]]
        cut[white[(kind[white + 1] < self.SPACE) & (kind[white + 1] >= wary)]] = True
        # Marks after a Latin letter of two bytes, but the signs of multiplication and division.
        mark = np.flatnonzero(pair == self.MARK) + 1
        mark = mark[mark >= 2]
        lead, rest = text[mark - 2], text[mark - 1]
        cut[mark[(lead >= 0xC3) & (lead <= 0xC5) & ~((lead == 0xC3) & ((rest == 0x97) | (rest == 0xB7)))]] = True
        cut |= last[:-1]
        return np.flatnonzero(cut)

    def _known(self, words: pa.Array) -> pa.Array:
        """The ids of each of different pieces."""
        place = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy()
        new = np.flatnonzero(place < 0)
        if len(new):
            place = place.copy()
            place[new] = np.arange(len(self.words), len(self.words) + len(new))
            fresh = words.take(pa.array(new))
            self.words = pa.concat_arrays([self.words, fresh])
            self.ids = pa.concat_arrays([self.ids, self._learned(fresh)])
            self.met = np.append(self.met, np.zeros(len(new)))
        self.met *= self.FADE
        self.met[place] += 1
        out = self.ids.take(pa.array(place))
        if len(self.words) > self.WORDS:
            # Bounded: what was met most stays, in the order in which it came.
            stay = np.sort(np.argsort(self.met, kind="stable")[-self.WORDS:])
            self.words, self.ids = self.words.take(pa.array(stay)), self.ids.take(pa.array(stay))
            self.met = self.met[stay]
        return out

    def _learned(self, words: pa.Array) -> pa.Array:
        plain = pc.match_substring_regex(words, rf"^ ?[^\t-\r {self.ODD}]+$").to_numpy(zero_copy_only=False)
        spaced = pc.starts_with(words, " ").to_numpy(zero_copy_only=False)
        groups = [np.flatnonzero(g) for g in (plain & spaced, plain & ~spaced, ~plain)]
        some = [words.take(pa.array(g)) for g in groups]
        ids = pa.concat_arrays([
            self._together(some[0], some[0], " "),
            self._together(some[1], pc.binary_join_element_wise("", some[1].cast(pa.string()), "\n").cast(pa.large_string()), "\n"),
            pa.array(self._library(some[2].to_pylist()), pa.large_binary())])
        place = np.empty(len(words), np.int64)
        place[np.concatenate(groups)] = np.arange(len(words))
        return ids.take(pa.array(place))

    def _together(self, words: pa.Array, led: pa.Array, lead: str) -> pa.Array:
        """The ids of pieces, many of them in one text; ``led`` has them with the lead before each."""
        begins, out = self.begins[lead], []
        bounds, data = _offsets(led), led.buffers()[2]
        for lo in range(0, len(words), self.TOGETHER):
            n = min(self.TOGETHER, len(words) - lo)
            text = data[bounds[lo]:bounds[lo + n]].to_pybytes().decode()
            if not any(token in text for token in self.special):
                ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
                starts = begins[ids]
                first = np.flatnonzero(starts)
                if len(first) == n and not first[0]:
                    stops = np.append(first, len(ids))
                    if lead == "\n":
                        ids, stops = ids[~starts], stops - np.append(np.arange(n), n)
                    out.append(_column(pa.large_binary(), 4 * stops, pa.py_buffer(ids)))
                    continue
            out.append(pa.array(self._library(words.slice(lo, n).to_pylist()), pa.large_binary()))
        return pa.concat_arrays(out) if out else pa.array([], pa.large_binary())

    def _library(self, texts: list[str]) -> list[bytes]:
        out = []
        for lo in range(0, len(texts), 4096):
            out += [_packed(e.ids) for e in self.library.encode_batch_fast(
                texts[lo:lo + 4096], add_special_tokens=False)]
        return out


def _offsets(column: pa.Array) -> np.ndarray:
    """Where the values of a large string or binary column lie in its data, and the end of the last."""
    if not len(column):
        return np.zeros(1, np.int64)
    return np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]


def _column(kind: pa.DataType, bounds: np.ndarray, data: pa.Buffer | None) -> pa.Array:
    bounds = np.ascontiguousarray(bounds, np.int64)
    return pa.Array.from_buffers(kind, len(bounds) - 1, [None, pa.py_buffer(bounds), data or pa.py_buffer(b"")])


def tokenized(docs: DataFrame, model: str, end_id: int | None = 0, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """Ids of every whole text (null: empty) as little-endian unsigned 32-bit integers.

    ``model`` is the JSON of a tokenizer. Returns (doc_id, ids) in ascending order of doc_id,
    null first, then of a hash of the text; ``end_id`` follows every document.
    """
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shared = docs.sparkSession.sparkContext.broadcast(model)      # a file of fixed size

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared, end_id)
        for batch in batches:
            # Many texts a call share their words; large texts come by fewer.
            step = max(1, min(2048, batch.num_rows * CALL // max(batch.nbytes, 1)))
            for lo in range(0, batch.num_rows, step):
                some = batch.slice(lo, step)
                yield pa.RecordBatch.from_arrays(
                    [some["doc_id"], encoder.column(some["text"]).cast(pa.binary())],
                    ["doc_id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.repartitionByRange(parts, "doc_id").sortWithinPartitions(
        "doc_id", F.xxhash64("text")).mapInArrow(encode, "doc_id long, ids binary")


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_encoders: dict[tuple, Encoder] = {}


def _encoder(model, end_id: int | None) -> Encoder:
    """The worker's encoder, kept for its next tasks with what it has learned."""
    import zlib

    key = (zlib.crc32(model.value.encode()), end_id)
    if key not in _encoders:
        _encoders[key] = Encoder(model.value, end_id)
    return _encoders[key]


def write_planes(rows: DataFrame, place: str, planes: str = "byte") -> None:
    """Write (doc_id, ids) in the order of the rows' partitions into a new folder."""
    rows.sparkSession.dataSource.register(PlaneSource)
    rows.select("doc_id", F.lit(0).cast("long").alias("start"), "ids").write.format("token_planes").option(
        "planes", planes).mode("append").save(place)


def read_planes(spark: SparkSession, place: str) -> DataFrame:
    """(doc_id, start, ids): the documents of a folder, with the number of ids before each.

    A folder without documents gives no rows.
    """
    spark.dataSource.register(PlaneSource)
    return spark.read.format("token_planes").load(place)


def op10_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = new_folder(spark, "tokens")
    with open(tokenizer_file("byte_bpe_50k.json"), encoding="utf-8") as model:
        write_planes(tokenized(read(spark, sf_dir, "documents"), model.read()), place)
    return read_planes(spark, place).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
