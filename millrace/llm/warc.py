"""Deterministic sharded WARC archives: written by ranges of records, committed through a manifest, read back.

Records are sorted by page_id and dealt to ranges at fixed places of their total size; one task writes a
range, a compressed member per record, and starts a new file when the file's compressed size reaches a
bound. Files are written under temporary names; the rows of the finished job name those that count, a second
job renames them, and the manifest, put in place last, makes the archive complete. What the files hold
hangs on the records only, not on the cluster.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import constant, settle

#: A range holds at least this many bytes of payload, and there are at most so many ranges.
RANGE_BYTES, MAX_RANGES = 16 << 20, 4096
#: Compressed size at which a file is closed.
ROLL_BYTES = 1 << 30
#: Payloads of fewer bytes are never replaced by a revisit.
MIN_REVISIT_BYTES = 0
#: The same for every record, as tables hold no time of capture.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "manifest"

_RECORD = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{page_id}:{digest}'.encode()).digest())}>"


def _clean(url: str) -> str:
    """A url fit for a header line: blanks and control characters percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def make_record(page_id, url, payload: bytes, refers_to=None) -> bytes:
    """One uncompressed record: a revisit if it refers to a page, else a response."""
    digest = base32_sha1(payload)
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block += payload if refers_to is None else b""
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id, digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else _clean(url)),
        ("WARC-Profile", None if refers_to is None else PROFILE),
        ("WARC-Refers-To", None if refers_to is None else _record_id(refers_to, digest)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("Page-Id", page_id),
        ("Refers-To-Page-Id", refers_to),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """What a record says, its digests checked against its block. ``payload`` is None for a revisit."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("damaged record: " + fields.get("WARC-Record-ID", "no id"))
    if fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError("block digest differs: " + fields["WARC-Record-ID"])
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    whole = fields["WARC-Type"] == "response"
    if whole and (len(payload) != length or base32_sha1(payload) != digest):
        raise ValueError("payload digest differs: " + fields["WARC-Record-ID"])

    def number(name):
        return int(fields[name]) if name in fields else None

    return {
        "page_id": number("Page-Id"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
        "payload_bytes": length, "payload_digest": digest, "refers_to": number("Refers-To-Page-Id"),
        "payload": payload if whole else None,
    }


def read_members(stream):
    """The records of an archive file, one at a time."""
    more = zlib.decompressobj(31)
    parts: list[bytes] = []
    while piece := stream.read(1 << 20):
        while piece:
            parts.append(more.decompress(piece))
            piece = more.unused_data
            if more.eof:
                yield b"".join(parts)
                parts, more = [], zlib.decompressobj(31)
    if any(parts):
        raise ValueError("archive ends within a record")


class _RangeWriter:
    """Files of one range; remembers what it finished."""

    def __init__(self, folder: str, number: int, roll_bytes: int):
        self.files, path = arrow_fs.FileSystem.from_uri(folder)
        self.folder, self.number, self.roll_bytes = path, number, roll_bytes
        self.done: list[dict] = []
        self.stream = None

    def write(self, record: bytes) -> None:
        if self.stream is None:
            name = f"part-{self.number:05d}-{len(self.done):05d}.warc.gz"
            self.now = {"name": name, "temporary": f"{name}.{uuid.uuid4().hex}", "records": 0, "bytes": 0}
            self.stream = self.files.open_output_stream(f"{self.folder}/_temporary/{self.now['temporary']}")
        member = gzip.compress(record, 6, mtime=0)
        self.stream.write(member)
        self.now["records"] += 1
        self.now["bytes"] += len(member)
        if self.now["bytes"] >= self.roll_bytes:
            self.close()

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.done.append(self.now)
            self.stream = None


def _writer(folder: str, roll_bytes: int):
    schema = pa.schema([("name", pa.string()), ("temporary", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

    def write(batches):
        out, refers_to = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if not row["payload_row"]:
                    refers_to = row["refers_to"]
                    continue
                if out is None or out.number != row["range"]:
                    if out is not None:
                        out.close()
                        yield pa.RecordBatch.from_pylist(out.done, schema=schema)
                    out = _RangeWriter(folder, row["range"], roll_bytes)
                out.write(make_record(row["page_id"], row["url"], row["html"].encode(), refers_to))
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist(out.done, schema=schema)

    return write


def _renamer(folder: str):
    def rename(batches):
        files, path = arrow_fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                final = f"{path}/{row['name']}"
                if files.get_file_info(final).type == arrow_fs.FileType.NotFound:
                    files.move(f"{path}/_temporary/{row['temporary']}", final)
            yield batch.select(["name", "records", "bytes"])

    return rename


def _range_of(page_id: Column, starts: list[int]) -> Column:
    """The last range that starts at or before a page, by halving; a NULL page belongs to the first."""
    steps = max(1, math.ceil(math.log2(len(starts) + 1)))
    bounds = constant(starts, "array<bigint>")
    start = F.struct(F.lit(0).alias("low"), F.lit(len(starts)).alias("high"))

    def halve(s, _):
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        right = (middle < len(starts)) & (F.get(bounds, middle) <= page_id)
        return F.struct(F.when(right, middle).otherwise(s["low"]).alias("low"), F.when(right, s["high"]).otherwise(middle).alias("high"))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve)["low"]
    return F.when(page_id.isNull(), 0).otherwise(found)


def _range_starts(info: DataFrame, range_bytes: int, max_ranges: int) -> list[int]:
    """First page_id of each range; pages of one id stay together."""
    per_page = info.where("page_id IS NOT NULL").groupBy("page_id").agg(F.sum("bytes").alias("bytes"))
    parts = settle(per_page.repartitionByRange("page_id").withColumn("part", F.spark_partition_id()), "ranges")
    sums = sorted((r["part"], r["b"]) for r in parts.groupBy("part").agg(F.sum("bytes").alias("b")).collect())  # one row per partition
    total, before = 0, {}
    for part, size in sums:
        before[str(part)] = total
        total += size
    width = max(range_bytes, math.ceil(total / max_ranges))
    offset = F.element_at(constant(before, "map<string,bigint>"), F.col("part").cast("string"))
    within = Window.partitionBy("part").orderBy("page_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("at", F.coalesce(F.sum("bytes").over(within), F.lit(0)) + offset)
    starts = placed.groupBy(F.floor(F.col("at") / width)).agg(F.min("page_id").alias("s"))
    return sorted(r["s"] for r in starts.collect()) or [0]  # max_ranges rows at most


def write_archive(
    pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, range_bytes: int = RANGE_BYTES,
    max_ranges: int = MAX_RANGES, min_revisit_bytes: int = MIN_REVISIT_BYTES,
) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, html) and returns the manifest (name, records, bytes).

    The payload is the html in UTF-8, nothing for NULL. Of records with equal payloads of at least
    ``min_revisit_bytes`` the one with the largest page_id is the response and the others revisit it; ties of that
    page_id are all responses, as are all where no page_id is given. Repeated rows give repeated records. An empty
    table gives an archive without files. Other columns are not written. ``folder`` must be new and reachable
    from all executors by a file system that pyarrow knows.

    Payloads are shuffled once, by range; equal payloads are found by digest, on rows without them. A task streams its
    ranges record by record.
    """
    html = F.coalesce("html", F.lit(""))
    pages = pages.select("page_id", "url", html.alias("html")).withColumn("digest", F.sha1("html"))
    text = F.concat_ws(":", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), "digest", F.coalesce("url", F.lit("-")))
    pages = pages.withColumn("key", F.md5(text))
    info = settle(
        pages.groupBy("key").agg(
            F.any_value("page_id").alias("page_id"), F.any_value("digest").alias("digest"),
            F.any_value(F.octet_length("html")).alias("size"), F.count("*").alias("copies"),
        ).withColumn("bytes", (F.col("size") * F.col("copies")).cast("bigint")),
        "records",
    )
    starts = _range_starts(info, range_bytes, max_ranges)
    shared = info.groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1")
    refers = F.when((F.col("size") >= min_revisit_bytes) & ~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))
    told = info.join(shared, "digest", "left").select(
        "page_id", "key", refers.alias("refers_to"),
        F.lit(False).alias("payload_row"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"),
    )
    rows = told.union(pages.select(
        "page_id", "key", F.lit(None).cast("bigint"), F.lit(True), "url", "html",
    )).withColumn("range", _range_of(F.col("page_id"), starts))
    tasks = min(len(starts), int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartition(tasks, "range").sortWithinPartitions("range", "page_id", "key", "payload_row")
    files, path = arrow_fs.FileSystem.from_uri(folder)
    files.create_dir(f"{path}/_temporary", recursive=True)
    written = dealt.select("range", "page_id", "url", "html", "refers_to", "payload_row").mapInArrow(
        _writer(folder, roll_bytes), "name string, temporary string, records bigint, bytes bigint"
    )
    written = settle(written, "written")
    final = written.mapInArrow(_renamer(folder), "name string, records bigint, bytes bigint")
    name = f"{MANIFEST}-{uuid.uuid4().hex}"
    final.write.parquet(f"{folder}/_temporary/{name}")
    files.move(f"{path}/_temporary/{name}", f"{path}/{MANIFEST}")
    files.delete_dir(f"{path}/_temporary")
    return pages.sparkSession.read.schema(final.schema).parquet(f"{folder}/{MANIFEST}")


def read_archive(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """Records of a complete archive: page_id, url, record_type, payload_bytes, payload_digest, refers_to, and payload if asked for.

    Files that the manifest does not name are not read. A record whose digests do not fit its block, or a
    file that ends early, is an error. A revisit has no payload of its own (NULL); its bytes and digest are those
    of the full payload. Files are read in parallel, each as a stream.
    """
    manifest = spark.read.parquet(f"{folder}/{MANIFEST}").select("name")
    schema = _RECORD + (", payload string" if with_payload else "")
    names = [part.split()[0] for part in schema.split(", ")]

    def read(batches):
        files, path = arrow_fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, size = [], 0
                with files.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for data in read_members(stream):
                        record = parse_record(data)
                        if with_payload and record["payload"] is not None:
                            record["payload"] = record["payload"].decode()
                        rows.append({k: record[k] for k in names})
                        size += len(data) if with_payload else 200
                        if size > 1 << 22:
                            yield pa.RecordBatch.from_pylist(rows, schema=out)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=out)

    kinds = {"bigint": pa.int64(), "string": pa.string()}
    out = pa.schema([(part.split()[0], kinds[part.split()[1]]) for part in schema.split(", ")])
    return manifest.repartition(max(1, min(manifest.count(), MAX_RANGES))).mapInArrow(read, schema)
