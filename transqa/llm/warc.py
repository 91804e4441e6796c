"""WARC archives as a Spark data source.

``spark.read.format("warc").load(folder)`` plans one partition per stretch of records, takes filters
on record type, ids, URI and digest into the scan, parses a record's headers first and
inflates the payload of wanted records alone. ``df.write.format("warc")`` writes gzip archives of
one member per record; a member's length stands in its extra field, so an unwanted one is
stepped over without inflating it. Archives from elsewhere, plain or gzip, are read as a stream.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage,
)

from transqa.llm import files
from transqa.llm.common import new_folder, read

SCHEMA = ("record_type string, record_id string, target_uri string, refers_to string, "
          "payload_digest string, payload_bytes long, payload binary")
HEADERS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri",
           "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}
STRETCH, FILE = 8 << 20, 256 << 20
BATCH = 4 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
_MEMBER = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x0c\0SL\x08\0"


@dataclass
class Stretch(InputPartition):
    file: str
    start: int = 0
    end: int | None = None


class WarcSource(DataSource):
    """Options: path; payloads ('no' leaves the payload column null and inflates none);
    date of written records."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options["path"], self.options.get("payloads", "yes") != "no")

    def writer(self, schema, overwrite) -> DataSourceArrowWriter:
        return WarcWriter(self.options["path"], self.options.get("date", DATE))


@dataclass
class WarcReader(DataSourceReader):
    place: str
    payloads: bool
    wanted: dict[str, set] = field(default_factory=dict)

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                values = set(f.value) if isinstance(f, In) else {f.value}
                name = f.attribute[0]
                self.wanted[name] = self.wanted.get(name, values) & values
            else:
                yield f

    def partitions(self):
        manifest = files.read_manifest(self.place)
        if manifest is not None:
            return [Stretch(x["name"], a, b) for x in manifest["files"]
                    for a, b in zip(x["cuts"][:-1], x["cuts"][1:], strict=True)] or [Stretch("", 0, 0)]
        system, root = files.store(self.place)
        found = system.get_file_info(files.fs.FileSelector(root, recursive=True))
        return [Stretch(i.path[len(root):].lstrip("/")) for i in found
                if i.path.endswith((".warc", ".warc.gz"))] or [Stretch("", 0, 0)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        system, root = files.store(self.place)
        with system.open_input_file(f"{root}/{partition.file}") as source:
            if partition.end is None:
                rows = _foreign(source, partition.file.endswith(".gz"), self._wants, self.payloads)
            else:
                source.seek(partition.start)
                data = source.read(partition.end - partition.start)
                rows = _members(data, self._wants, self.payloads)
            yield from _batched(rows)

    def _wants(self, headers: dict[str, str]) -> bool:
        return all(_header(headers, name) in values for name, values in self.wanted.items())


def _header(headers: dict[str, str], name: str) -> str | None:
    value = headers.get(HEADERS[name])
    if value is not None and name in ("record_id", "refers_to"):
        value = value.strip("<>")
    return value


def _parsed(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:]) if k}


def _members(data: bytes, wants, payloads: bool) -> Iterator[tuple]:
    """Records of members that tell their own length."""
    at = 0
    while at < len(data):
        size = struct.unpack_from("<Q", data, at + len(_MEMBER))[0]
        body = memoryview(data)[at + len(_MEMBER) + 8:at + size - 8]
        inflate, head = zlib.decompressobj(-15), b""
        rest = body
        while b"\r\n\r\n" not in head:
            head += inflate.decompress(rest, 1024)
            rest = inflate.unconsumed_tail
            if not rest and inflate.eof:
                break
        head, _, begun = head.partition(b"\r\n\r\n")
        headers = _parsed(head)
        if wants(headers):
            block = None
            if payloads or _needs_block(headers):
                block = begun + inflate.decompress(rest) + inflate.flush()
                block = block[:int(headers["content-length"])]
            yield _row(headers, block, payloads)
        at += size


def _needs_block(headers: dict[str, str]) -> bool:
    return headers.get("warc-type") == "revisit"      # its HTTP header tells the payload's length


def _foreign(source, packed: bool, wants, payloads: bool) -> Iterator[tuple]:
    """Records of any archive, read from its beginning."""
    import gzip

    stream = gzip.GzipFile(fileobj=source) if packed else source
    read = stream.read
    buffer = b""
    while True:
        while b"\r\n\r\n" not in buffer.lstrip(b"\r\n"):
            more = read(1 << 16)
            if not more:
                return
            buffer += more
        head, _, buffer = buffer.lstrip(b"\r\n").partition(b"\r\n\r\n")
        headers = _parsed(head)
        length = int(headers.get("content-length", 0))
        keep = wants(headers)
        need = keep and (payloads or _needs_block(headers))
        if need:
            while len(buffer) < length:
                more = read(max(1 << 16, length - len(buffer)))
                if not more:
                    break
                buffer += more
            block, buffer = buffer[:length], buffer[length:]
        else:
            block, left = None, length - len(buffer)
            buffer = buffer[length:]
            if left > 0 and not packed:
                source.seek(left, 1)
            while left > 0 and packed:
                more = read(min(left, 1 << 20))
                if not more:
                    break
                left -= len(more)
        if keep:
            yield _row(headers, block, payloads)


def _row(headers: dict[str, str], block: bytes | None, payloads: bool) -> tuple:
    payload, size = block, None if block is None else len(block)
    if block is not None and headers.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
        if headers.get("warc-type") == "revisit":
            told = _parsed(head).get("content-length")
            size = int(told) if told and told.isdigit() else None
    if headers.get("warc-type") == "revisit" or not payloads:
        payload = None
    return (*(_header(headers, name) for name in HEADERS), size, payload)


def _batched(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, pa.string()) for n in HEADERS] + [("payload_bytes", pa.int64()), ("payload", pa.binary())])
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += 500 + len(row[-1] or b"")
        if weight >= BATCH:
            yield _batch(held, schema)
            held, weight = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


@dataclass
class Written(WriterCommitMessage):
    files: list[dict]


@dataclass
class WarcWriter(DataSourceArrowWriter):
    place: str
    date: str

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = files.store(self.place)
        system.create_dir(root, recursive=True)
        done, out, cuts, at = [], None, [0], 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None:
                    name = files.new_name(".warc.gz")
                    out, cuts, at = system.open_output_stream(f"{root}/{name}", compression=None), [0], 0
                at += out.write(_member(self._record(row)))
                if at - cuts[-1] >= STRETCH:
                    cuts.append(at)
                if at >= FILE:
                    out = self._close(out, name, cuts, at, done)
        if out is not None:
            self._close(out, name, cuts, at, done)
        return Written(done)

    def _close(self, out, name, cuts, at, done) -> None:
        out.close()
        done.append({"name": name, "cuts": cuts + [at] * (cuts[-1] < at)})

    def _record(self, row: dict) -> bytes:
        payload, size = row["payload"] or b"", row["payload_bytes"]
        revisit = row["record_type"] == "revisit"
        http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                f"Content-Length: {len(payload) if size is None else size}\r\n\r\n").encode()
        block = http if revisit else http + payload
        head = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <{row['record_id']}>",
                f"WARC-Date: {self.date}"]
        if row["target_uri"] is not None:
            head.append(f"WARC-Target-URI: {quote(row['target_uri'], safe=_PLAIN)}")
        if row["payload_digest"] is not None:
            head.append(f"WARC-Payload-Digest: {row['payload_digest']}")
        if row["refers_to"] is not None:
            head.append(f"WARC-Refers-To: <{row['refers_to']}>")
        if revisit:
            head.append(f"WARC-Profile: {PROFILE}")
        head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
        return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    def commit(self, messages: list) -> None:
        files.write_manifest(self.place, {"files": [x for m in messages if m for x in m.files]})

    def abort(self, messages: list) -> None:
        """Nothing to undo: files without a manifest entry are never read."""


_PLAIN = "".join(map(chr, range(33, 127)))


def _member(record: bytes, level: int = 4) -> bytes:
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(record) + deflate.flush()
    size = len(_MEMBER) + 8 + len(body) + 8
    return (_MEMBER + struct.pack("<Q", size) + body
            + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, place: str, payloads: bool = True) -> DataFrame:
    """The records of all archives below a folder; filters on headers go into the scan."""
    register(spark)
    return spark.read.format("warc").option("payloads", "yes" if payloads else "no").load(place)


def write_warc(records: DataFrame, place: str) -> None:
    """Write records of ``SCHEMA`` as archives into a new folder."""
    register(records.sparkSession)
    records.select(*[c.split()[0] for c in SCHEMA.split(", ")]).write.format("warc").mode("append").save(place)


def page_records(pages: DataFrame, least_bytes: int = 100, id_col: str = "page_id",
                 url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One record per page: a response, or a revisit of the smallest page with an equal payload.

    Payloads under ``least_bytes`` bytes are always responses. A null html is an empty
    payload, a null url leaves the header out. Of pages that share the smallest id each is a
    response; a page without an id revisits the smallest, or is a response if none has one.
    Extra columns are ignored.
    """
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_col).cast("string").alias("page"), F.col(id_col).alias("id"), F.col(url_col).alias("target_uri"),
        payload.alias("payload")).withColumn("hex", F.sha2("payload", 256)).withColumn(
        "payload_bytes", F.octet_length("payload").cast("long"))
    first = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("hex").agg(
        F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("hex", "first")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return rows.join(first, "hex", "left").select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.concat(F.lit("urn:page:"), F.coalesce("page", F.lit(""))).alias("record_id"), "target_uri",
        F.when(again, F.concat(F.lit("urn:page:"), F.col("first").cast("string"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), "hex").alias("payload_digest"), "payload_bytes",
        F.when(~again, F.col("payload")).alias("payload"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = new_folder(spark, "warc")
    write_warc(page_records(read(spark, sf_dir, "pages")), place)
    number = lambda c: F.nullif(F.replace(F.col(c), F.lit("urn:page:"), F.lit("")), F.lit("")).cast("long")
    told = F.replace(F.col("payload_digest"), F.lit("sha256:"), F.lit(""))
    response = F.col("record_type") == "response"
    return read_warc(spark, place).select(
        number("record_id").alias("page_id"), "payload_bytes",
        F.when(response, F.sha2("payload", 256)).otherwise(told).alias("payload_digest"), "record_type",
        number("refers_to").alias("refers_to"))


OP9_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""
