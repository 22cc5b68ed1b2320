"""Web archives in ZIP packages (operator 2).

``write`` packs WARC records into ZIP files: ``archive/data.warc.gz`` holds one
gzip member a record and ``indexes/index.cdxj`` names each record's place;
both are stored, not deflated, so a record lies at a known place of the file.
``members`` reads the end record, the ZIP64 records and the central directory;
``locate`` reads the index members; ``read`` fetches records by range, in
splits of bounded size, so neither a package nor a member is ever extracted.

Packages are written by tasks to the shared folder through Arrow's file
systems, each under a name of its own; the list of packages is written as a
table, so a task that is run again leaves a file that nobody reads.

Edge cases: a null payload is an empty one; a page without id is written and
read, and refers to nothing; payloads under ``MIN_SHARED`` bytes are responses;
rows that repeat an id are all written, the copies of a payload with the same
id are revisits of it but for one; an empty table gives no packages and an
empty result; further columns play no part.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from trendlens.llm.common import lookup, shipped, written
from trendlens.session import scratch_path

MIN_SHARED = 100
#: A package is closed beyond so many bytes of records.
PACKAGE_BYTES = 256 << 20
#: Records are fetched in splits of about so many bytes.
SPLIT_BYTES = 4 << 20
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"

#: The records' signatures and layouts in a ZIP file.
_END, _END64, _FIND64, _ENTRY, _LOCAL = (b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\1\2", b"PK\3\4")
_MAX16, _MAX32 = 0xFFFF, 0xFFFFFFFF


def _file_system(path: str):
    """Arrow's file system of a path or URI, and the path in it."""
    from pyarrow import fs

    if "://" not in path and path.startswith("file:"):
        path = path[len("file:"):]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


# ---- records ----------------------------------------------------------------

def record(page_id, url: str, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the HTTP
    headers of the payload that ``refers_to`` has."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: " \
           f"{len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name}>",
             "WARC-Date: 2000-01-01T00:00:00Z", f"WARC-Target-URI: {_one_line(url)}",
             f"WARC-Payload-Digest: sha256:{digest}", f"X-Page-Id: {json.dumps(page_id)}"]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/"
                  "identical-payload-digest", f"X-Refers-To-Page-Id: {json.dumps(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8") + block + b"\r\n\r\n"


def _one_line(value: str | None) -> str:
    return "".join(" " if c in "\r\n" else c for c in value or "")


def _headers(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    pairs = (line.partition(": ") for line in head.decode("utf-8").split("\r\n")[1:])
    return {k: v for k, _, v in pairs}, rest


def parse(raw: bytes) -> dict:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest and,
    of a response, the payload; a payload must match its digest."""
    warc, rest = _headers(raw)
    block = rest[:int(warc["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a WARC record does not end where its length says")
    http, payload = _headers(block)
    kind, digest = warc["WARC-Type"], warc["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != int(http["Content-Length"])
                               or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("a payload does not match its record's digest")
    refers = warc.get("X-Refers-To-Page-Id")
    return {"page_id": json.loads(warc["X-Page-Id"]), "url": warc["WARC-Target-URI"],
            "record_type": kind, "refers_to": None if refers is None else json.loads(refers),
            "payload_bytes": int(http["Content-Length"]), "payload_digest": digest,
            "payload": payload if kind == "response" else None}


# ---- packages ---------------------------------------------------------------

class _Package:
    """A package being written: records go straight to the file."""

    def __init__(self, folder: str):
        self.name = f"{folder}/{uuid.uuid4().hex}.zip"
        system, path = _file_system(self.name)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.size, self.index = 0, []

    def add(self, page_id, raw: bytes) -> None:
        packed = gzip.compress(raw, 1, mtime=0)
        self.data.write(packed)
        self.index.append(json.dumps({"page_id": page_id, "offset": self.size,
                                      "length": len(packed)}))
        self.size += len(packed)

    def close(self) -> int:
        self.data.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as f:
            for line in self.index:
                f.write(line.encode() + b"\n")
        self.zip.close()
        self.out.close()
        return len(self.index)


def with_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): the smallest page_id of equal
    payloads of at least ``MIN_SHARED`` bytes is what the others refer to."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    named = pages.select("page_id", "url", payload.alias("payload"))
    named = named.withColumn("digest", F.sha2("payload", 256))
    shared = named.where((F.octet_length("payload") >= MIN_SHARED)
                         & F.col("page_id").isNotNull()).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    shared = written(shared.select("digest", "first"), "archive-shared")
    out = lookup(named, shared, ["digest"])
    # Of rows that repeat the first id, one is the response.
    again = out.where(F.col("page_id") == F.col("first")).groupBy("page_id").count().where(
        "count > 1").select("page_id").limit(1).count()
    if again:
        order = Window.partitionBy("digest", "page_id").orderBy("url")
        twice = (F.col("page_id") == F.col("first")) & (F.row_number().over(order) > 1)
        refers = F.when((F.col("page_id") != F.col("first")) | twice, F.col("first"))
    else:
        refers = F.when(F.col("page_id") != F.col("first"), F.col("first"))
    return out.select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def write(pages: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Writes every row of ``pages`` (page_id, url, html) and returns the table
    of packages (package, records)."""
    shipped(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            for page_id, url, payload, digest, refers in zip(*batch.columns, strict=True):
                package = package or _Package(folder)
                own = page_id.as_py()
                package.add(own, record(own, url.as_py(), payload.as_py(), digest.as_py(),
                                        refers.as_py()))
                if package.size >= package_bytes:
                    done.append((package.name, package.close()))
                    package = None
        if package is not None:
            done.append((package.name, package.close()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in done], pa.string()), pa.array([n for _, n in done],
                                                                   pa.int64())],
            names=["package", "records"])

    return written(with_revisits(pages).mapInArrow(run, "package string, records long"),
                   "archive-packages")


# ---- reading ----------------------------------------------------------------

def _range(file, at: int, size: int) -> bytes:
    file.seek(at)
    raw = file.read(size)
    if len(raw) != size:
        raise ValueError("the package ends too early")
    return raw


def members(file, size: int) -> dict[str, tuple[int, int]]:
    """(place, length) of the data of every stored member, from the end record,
    the ZIP64 records where the file has them, and the central directory."""
    tail = _range(file, max(0, size - 22 - _MAX16), min(size, 22 + _MAX16))
    end = tail.rfind(_END)
    if end < 0:
        raise ValueError("no ZIP end record")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if _MAX16 == count or _MAX32 in (length, start):
        if end < 20 or tail[end - 20:end - 16] != _FIND64:
            raise ValueError("no ZIP64 locator")
        where = struct.unpack_from("<Q", tail, end - 20 + 8)[0]
        big = _range(file, where, 56)
        if big[:4] != _END64:
            raise ValueError("no ZIP64 end record")
        count, length, start = struct.unpack_from("<QQQ", big, 32)
    directory, at, out = _range(file, start, length), 0, {}
    for _ in range(count):
        if directory[at:at + 4] != _ENTRY:
            raise ValueError("a broken central directory")
        method = struct.unpack_from("<H", directory, at + 10)[0]
        packed, plain, name, extra, note = struct.unpack_from("<IIHHH", directory, at + 20)
        place = struct.unpack_from("<I", directory, at + 42)[0]
        title = directory[at + 46:at + 46 + name].decode("utf-8")
        fields, k = directory[at + 46 + name:at + 46 + name + extra], 0
        while k + 4 <= len(fields):
            kind, width = struct.unpack_from("<HH", fields, k)
            if kind == 1:
                # Only values that don't fit their place stand here, in this order.
                big, j = fields[k + 4:k + 4 + width], 0
                if plain == _MAX32:
                    plain, j = struct.unpack_from("<Q", big, j)[0], j + 8
                if packed == _MAX32:
                    packed, j = struct.unpack_from("<Q", big, j)[0], j + 8
                if place == _MAX32:
                    place = struct.unpack_from("<Q", big, j)[0]
            k += 4 + width
        if method == 0:
            local = _range(file, place, 30)
            if local[:4] != _LOCAL:
                raise ValueError("no local header where the directory says")
            skip = sum(struct.unpack_from("<HH", local, 26))
            out[title] = (place + 30 + skip, packed)
        at += 46 + name + extra + note
    return out


def locate(packages: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(package, first, size, lengths): runs of neighbouring records by their
    places in the package, of about ``split_bytes`` each."""
    shipped(packages.sparkSession)

    def splits(package: str):
        system, path = _file_system(package)
        with system.open_input_file(path) as file:
            found = members(file, file.size())
            base, _ = found[DATA]
            place, length = found[INDEX]
            file.seek(place)
            # The index is read in pieces, a line at a time.
            first, total, lengths, rest = None, 0, [], b""
            while length or rest:
                piece = file.read(min(length, 1 << 20))
                length -= len(piece)
                lines = (rest + piece).split(b"\n")
                rest = lines.pop() if length else b""
                for line in filter(None, lines):
                    entry = json.loads(line)
                    if first is None:
                        first = base + entry["offset"]
                    lengths.append(entry["length"])
                    total += entry["length"]
                    if total >= split_bytes:
                        yield package, first, total, lengths
                        first, total, lengths = None, 0, []
            if lengths:
                yield package, first, total, lengths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for package in batch.column(0).to_pylist():
                rows = list(zip(*splits(package), strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int64()),
                     pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.list_(pa.int64()))],
                    names=["package", "first", "size", "lengths"])

    return packages.select("package").mapInArrow(
        run, "package string, first long, size long, lengths array<long>")


def read(packages: DataFrame, with_payload: bool = True,
         id_type: T.DataType | None = None) -> DataFrame:
    """Every record of the packages: page_id, url, record_type, refers_to,
    payload_bytes, payload_digest and, if asked for, the payload of responses."""
    id_type = id_type or T.LongType()
    kinds = {"page_id": id_type, "url": T.StringType(), "record_type": T.StringType(),
             "refers_to": id_type, "payload_bytes": T.LongType(),
             "payload_digest": T.StringType(), "payload": T.BinaryType()}
    columns = [c for c in kinds if c != "payload" or with_payload]
    schema = T.StructType([T.StructField(c, kinds[c]) for c in columns])
    arrow = to_arrow_schema(schema)
    # The place of a split tells nothing of its size, so splits are dealt out evenly.
    splits = written(locate(packages), "archive-splits")
    tasks = int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for package, first, size, lengths in zip(*[c.to_pylist() for c in batch.columns],
                                                     strict=True):
                system, path = _file_system(package)
                with system.open_input_file(path) as file:
                    raw, rows = io.BytesIO(_range(file, first, size)), []
                for length in lengths:
                    row = parse(gzip.decompress(raw.read(length)))
                    rows.append({k: row[k] for k in columns})
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return splits.repartition(tasks).mapInArrow(run, schema)


def archived(pages: DataFrame) -> DataFrame:
    """Writes all pages to packages in the shared folder and reads them back."""
    spark: SparkSession = pages.sparkSession
    packages = write(pages, scratch_path(spark, "archive"))
    kind = pages.schema["page_id"].dataType
    return read(packages, with_payload=False, id_type=kind).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
