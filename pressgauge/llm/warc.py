"""Deterministic sharded WARC archives: written, committed by manifest, and read back.

Records are range-sorted by page id: shards are runs of blocks of ids that hold about ``shard_bytes`` of
payload, so their borders follow from the data alone, and a shard is one task. Inside it a file is rolled
once it holds ``file_bytes`` compressed. Headers, digests and record ids are made from the rows; with the
given date they are the same bytes in every run. Of equal payloads the smallest page id is
written whole and the others revisit it; that is decided on (id, digest) rows only.

A task writes to temporary names and renames a finished file, so a repeated task replaces it by the same
bytes. Only files listed in the manifest, which is written when all tasks are done, belong to the
archive. Paths are opened through Arrow's file systems.

Edge cases: null html is an empty payload; a null url leaves the record without page address; rows with a null id come first;
repeated rows get a record each, the first of equal ones being the response; an empty table gives an archive
without files and an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pressgauge.llm.common import join_unique, text_or_empty
from pressgauge.session import fresh_dir
from pressgauge.sinks.files import stored

SHARD_BYTES = 32 << 20
FILE_BYTES = 4 << 20
BLOCK_IDS = 1024
DATE = "2000-01-01T00:00:00Z"
MANIFEST = "shard long, file string, records long, bytes long, sha256 string"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, file string"


def _sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _urn(page_id: int | None, copy: int) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}:{copy}>"


def record(page_id: int | None, copy: int, url: str | None, payload: bytes, refers: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit with the response's headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id, copy)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="".join(chr(c) for c in range(33, 127) if c != 37)))
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_urn(refers, 0)}"]
    head += [
        f"WARC-Payload-Digest: sha1:{_sha1(payload)}", f"WARC-Block-Digest: sha1:{_sha1(block)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _info(name: str, date: str) -> bytes:
    block = b"software: pressgauge\r\nformat: WARC File Format 1.1\r\n"
    head = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:x-file:{name}>", f"WARC-Date: {date}", f"WARC-Filename: {name}",
            f"WARC-Block-Digest: sha1:{_sha1(block)}", "Content-Type: application/warc-fields", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class _Roller:
    """The files of one shard, rolled by compressed size."""

    def __init__(self, folder: str, shard: int, limit: int, date: str) -> None:
        self.system, self.root = fs.FileSystem.from_uri(folder)
        self.shard, self.limit, self.date, self.no = shard, limit, date, 0
        self.out = None

    def add(self, data: bytes) -> Iterator[tuple]:
        if self.out is None:
            self.name = f"part-{self.shard:06d}-{self.no:04d}.warc.gz"
            self.temporary = f"{self.root}/_temporary/{self.name}.{uuid.uuid4().hex}"
            self.system.create_dir(f"{self.root}/_temporary", recursive=True)
            self.out, self.size, self.count, self.digest = self.system.open_output_stream(self.temporary), 0, 0, hashlib.sha256()
            self._put(_info(self.name, self.date))
        self._put(data)
        self.count += 1
        if self.size >= self.limit:
            yield self.close()

    def _put(self, data: bytes) -> None:
        packed = _member(data)
        self.out.write(packed)
        self.size += len(packed)
        self.digest.update(packed)

    def close(self) -> tuple:
        self.out.close()
        self.out = None
        self.no += 1
        self.system.move(self.temporary, f"{self.root}/{self.name}")
        return self.shard, self.name, self.count, self.size, self.digest.hexdigest()


def _borders(sizes: DataFrame, shard_bytes: int) -> list[int]:
    """The first block of each shard but the first: one number per ``shard_bytes`` of payload."""
    so_far = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = sizes.groupBy("block").agg(F.sum("payload_bytes").alias("size"))
    shards = blocks.withColumn("shard", F.floor((F.sum("size").over(so_far) - F.col("size")) / shard_bytes))
    return sorted(r.low for r in shards.groupBy("shard").agg(F.min("block").alias("low")).collect())[1:]


def write(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *,
    least_bytes: int = 0, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, date: str = DATE,
) -> DataFrame:
    """Write all rows as WARC records into ``folder`` and return the committed manifest.

    Rows whose payload, of at least ``least_bytes``, also stands under a smaller id become revisits.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), text_or_empty(html_col).alias("html"))
    block = F.coalesce(F.floor(F.col("page_id") / BLOCK_IDS), F.lit(-(1 << 62))).cast("long")
    sizes = stored(rows.select("page_id", F.sha1("html").alias("digest"), F.octet_length("html").cast("long").alias("payload_bytes"), block.alias("block")), "payloads")
    heads = sizes.groupBy("digest").agg(F.min("page_id").alias("refers"), F.count(F.lit(1)).alias("n"))
    linked = join_unique(sizes, stored(heads, "heads"), "digest", "n", sizes.count())
    again = linked.where((F.col("n") > 1) & (F.col("payload_bytes") >= least_bytes) & F.col("refers").isNotNull())
    again = again.select("page_id", "digest", "refers").distinct()
    borders = np.array(_borders(sizes, shard_bytes), np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.asarray(batch.column(batch.schema.get_field_index("block")))
            shard = np.searchsorted(borders, at, side="right")
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), *batch.columns], ["shard", *batch.schema.names])

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, roller, page, copy, refers, first = None, None, (), 0, {}, set()
        done: list[tuple] = []
        for batch in batches:
            for at, digest, page_id, url, html, known in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("shard", "digest", "page_id", "url", "html", "refers"))):
                if at != shard:
                    if roller and roller.out:
                        done.append(roller.close())
                    shard, roller, page = at, _Roller(folder, at, file_bytes, date), ()
                if page != (page_id,):
                    page, copy, refers, first = (page_id,), 0, {}, set()
                if digest is not None:  # says whom the page's payload revisits; comes before the page
                    refers[digest] = known
                    continue
                payload = html.encode()
                key = hashlib.sha1(payload).hexdigest()
                revisit = key in refers and (refers[key] != page_id or key in first)
                first.add(key)
                done += roller.add(record(page_id, copy, url, payload, refers.get(key), revisit, date))
                copy += 1
        if roller and roller.out:
            done.append(roller.close())
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["shard", "file", "records", "bytes", "sha256"]) if done else pa.RecordBatch.from_pylist([], manifest)

    manifest = pa.schema([("shard", pa.int64()), ("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])
    whole = rows.select(F.lit(None).cast("string").alias("digest"), "page_id", "url", "html", F.lit(None).cast("long").alias("refers"), block.alias("block"))
    notes = again.select("digest", "page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "refers", block.alias("block"))
    dealt = whole.unionByName(notes).mapInArrow(deal, "shard int, digest string, page_id long, url string, html string, refers long, block long")
    placed = dealt.repartitionById(len(borders) + 1, "shard")
    ordered = placed.sortWithinPartitions("shard", F.asc_nulls_first("page_id"), F.asc_nulls_last("digest"), "url", F.sha1("html"))
    ordered.mapInArrow(put, MANIFEST).write.mode("overwrite").parquet(f"{folder}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def _members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, each unpacked."""
    unpacker, out, rest = zlib.decompressobj(31), [], b""
    while data := rest or stream.read(1 << 20):
        out.append(unpacker.decompress(data))
        rest = unpacker.unused_data
        if unpacker.eof:
            yield b"".join(out)
            unpacker, out = zlib.decompressobj(31), []
    if out:
        raise ValueError("the archive breaks off inside a record")


def _headers(text: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in text.decode().split("\r\n")[1:])}


def _page(urn: str) -> int | None:
    page = urn.strip("<>").split(":")[2]
    return None if page == "none" else int(page)


def parse(data: bytes) -> dict | None:
    """The fields of a response or revisit record; None for other records. Digests are verified."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _headers(head)
    block = rest[: int(fields["content-length"])]
    if fields["warc-block-digest"] != f"sha1:{_sha1(block)}":
        raise ValueError(f"the digest of {fields['warc-record-id']} is wrong")
    if fields["warc-type"] not in ("response", "revisit"):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    revisit = fields["warc-type"] == "revisit"
    if not revisit and digest != _sha1(payload):
        raise ValueError(f"the payload digest of {fields['warc-record-id']} is wrong")
    from urllib.parse import unquote

    return {
        "page_id": _page(fields["warc-record-id"]), "url": unquote(fields["warc-target-uri"]) if "warc-target-uri" in fields else None,
        "payload_bytes": int(_headers(http)["content-length"]), "payload_digest": digest, "record_type": fields["warc-type"],
        "refers_to": _page(fields["warc-refers-to"]) if revisit else None, "html": None if revisit else payload,
    }


def read(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """All pages of a committed archive, one row per record; with ``payloads`` also ``html`` (binary)."""
    schema = RECORD + (", html binary" if payloads else "")
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]]) for n, c in zip(names, schema.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file, count in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen, rows, held = 0, [], 0
                with system.open_input_stream(f"{root}/{file}", compression=None) as stream:
                    for data in _members(stream):
                        if found := parse(data):
                            rows.append({**found, "file": file})
                            seen, held = seen + 1, held + len(data)
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in rows], kinds)
                            rows, held = [], 0
                if seen != count:
                    raise ValueError(f"{file} holds {seen} records, the manifest says {count}")
                yield pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in rows], kinds)

    files = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest").select("file", "records")
    return files.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file").mapInArrow(run, schema)


def archive(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write the pages to ``folder`` (by default a new one in the shared folder) and read them back."""
    folder = folder or fresh_dir(pages.sparkSession, "warc")
    if "://" not in folder and not folder.startswith("/"):
        folder = folder.replace("file:", "file://", 1)
    write(pages, folder, **options)
    return read(pages.sparkSession, folder)
