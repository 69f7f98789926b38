"""WARC archives whose records are compressed one by one against a shared Zstandard dictionary.

The dictionary is trained on archived records (a bounded sample of their beginnings, chosen by hash), embedded in a leading skippable frame of
every archive file, as the WARC/Zstandard specification has it, and each record is a frame of its own. Of pages with equal
payloads the one with the largest page_id is a response; the others are revisits that refer to it and carry no payload.

A write task makes one file of the rows it holds, under a name of its own, and reports it in the manifest; a task that runs
again writes a new file, and only files of the manifest are archives. Files go through pyarrow's file systems, so that the
folder may be local, HDFS or an object store.

Defined cases: a null html is an empty payload; a null url leaves out the target; pages with a null page_id are responses
unless another page with the payload has an id; rows that repeat the largest page_id of their payload are all responses;
every row becomes a record; if there are too few records to train a dictionary (under LEAST_RECORDS), files have none and
records are plain frames; an empty table gives an empty result; other columns have no part in it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from itertools import islice
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_small_batches, lookup_join, new_path, stored

#: Payloads of at least so many bytes are stored once.
MIN_DEDUP_BYTES = 0
#: The sample that the dictionary is trained on: about so many records, so many characters of each, and the dictionary's size.
SAMPLE_ROWS, SAMPLE_CHARS, DICTIONARY_BYTES = 1000, 16_384, 65_536
LEAST_RECORDS = 16
LEVEL = 5
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the formats: magic numbers of the dictionary's skippable frame and of a Zstandard dictionary.
SKIPPABLE, DICTIONARY_MAGIC = 0x184D2A5D, b"\x37\xa4\x30\xec"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes that are read at once: what a frame leaves of them is copied for the next one.
CHUNK = 1 << 16


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str, place: int) -> str:
    """An id of its own for each row: by its page, its payload and its place in the scan."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}:{place}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, place: int = 0, kept: tuple[int, int] | None = None) -> bytes:
    """One WARC record; kept (page and place of the response with the payload) makes it a revisit, which has the payload's digest and length but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body, digest = http if kept else http + payload, payload_digest(payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if kept else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest, place)}",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~-._')}"] if url is not None else []),
        f"WARC-Payload-Digest: sha1:{digest}",
        *([f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(kept[0], digest, kept[1])}", f"WARC-Refers-To-Page: {kept[0]}"] if kept else []),
        *([f"WARC-Page: {page_id}"] if page_id is not None else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """page_id, payload_bytes, payload_digest, record_type, refers_to and payload of a record; checks lengths and digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    body = rest[: int(fields["Content-Length"])]
    if version != "WARC/1.1" or len(body) != int(fields["Content-Length"]) or rest[len(body) :] != b"\r\n\r\n":
        raise ValueError("a record of the archive is broken")
    http, _, payload = body.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError("a payload of the archive doesn't match its digest")
    whole = lambda x: int(x) if x is not None else None
    return {"page_id": whole(fields.get("WARC-Page")), "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": whole(fields.get("WARC-Refers-To-Page")), "payload": payload if kind == "response" else None, "url": fields.get("WARC-Target-URI")}


def trained_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from sample records, or nothing where they are too few to train one."""
    total = sum(map(len, records))
    try:
        return zstandard.train_dictionary(min(size, total // 8), records, level=LEVEL).as_bytes() if len(records) >= LEAST_RECORDS else b""
    except zstandard.ZstdError:
        return b""


def head_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary if dictionary else b""


def read_records(stream) -> Iterator[bytes]:
    """The records of an archive, frame by frame, with the dictionary from its leading frame; holds a record at a time."""
    data = stream.read(8)
    dictionary = None
    if len(data) == 8 and struct.unpack("<I", data[:4])[0] == SKIPPABLE:
        size, taken = struct.unpack("<I", data[4:])[0], b""
        while len(taken) < size:
            if not (more := stream.read(size - len(taken))):
                raise ValueError("the archive ends within its dictionary")
            taken += more
        if taken[:4] != DICTIONARY_MAGIC:
            taken = zstandard.ZstdDecompressor().decompress(taken)
        dictionary, data = zstandard.ZstdCompressionDict(taken), b""
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    while True:
        data = data or stream.read(CHUNK)
        if not data:
            return
        one, out = decompressor.decompressobj(), []
        while True:
            out.append(one.decompress(data))
            if one.eof:
                data = one.unused_data
                break
            if not (data := stream.read(CHUNK)):
                raise ValueError("the archive ends within a record")
        yield b"".join(out)


def decided(pages: DataFrame, min_bytes: int = MIN_DEDUP_BYTES) -> DataFrame:
    """page_id, url, html, place (in the scan), keep and keep_place: page_id and place of the response with the payload, null if that is this row.

    pages should come from files, whose rows keep their places when they are read again.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"), F.monotonically_increasing_id().alias("place"))
    rows = rows.withColumn("digest", F.sha1("html"))
    first = F.max(F.struct("page_id", (-F.col("place")).alias("p")))
    same = rows.where(F.octet_length("html") >= min_bytes).groupBy("digest").agg(first.alias("k"), F.min("page_id").alias("least"), F.count("*").alias("n"), F.count("page_id").alias("ids"))
    keep = F.col("k.page_id")
    same = stored(same.where((F.col("n") > 1) & keep.isNotNull() & ((F.col("least") < keep) | (F.col("ids") < F.col("n")))).select("digest", keep.alias("keep"), (-F.col("k.p")).alias("keep_place")), "payloads")
    joined = lookup_join(rows, same, ["digest"], "left", ["page_id", "url"])
    other = ~F.col("keep").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "html", "place", F.when(other, F.col("keep")).alias("keep"), F.when(other, F.col("keep_place")).alias("keep_place"))


def _sample(pages: DataFrame) -> DataFrame:
    """The beginnings of at most SAMPLE_ROWS pages, chosen by hash: a threshold leaves few on the way to the last step."""
    sample = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.substring("html", 1, SAMPLE_CHARS).alias("html"), F.xxhash64("page_id", "url", "html").alias("h")).where("html IS NOT NULL")
    share = min(1.0, 1.2 * SAMPLE_ROWS / max(1, pages.count()))
    return sample.where(F.pmod("h", F.lit(1 << 20)) < int(share * (1 << 20)) + 1).orderBy("h", "html").limit(SAMPLE_ROWS).select("page_id", "url", "html")


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_DEDUP_BYTES) -> DataFrame:
    """Writes the pages' archives and returns their manifest: path, records, bytes."""
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    if ":/" not in folder:  # in the file system that Spark's own writers would use
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        folder = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    folder = folder if "://" in folder else folder.replace(":/", ":///", 1)
    rows = decided(pages, min_bytes)
    dictionary = spark.sparkContext.broadcast(trained_dictionary([record(r[0], r[1], r[2].encode()) for r in _sample(pages).collect()]))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(i) for i in range(6)), strict=True))
        first = next(rows, None)
        if first is None:
            return
        system, root = pafs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        path = f"{root}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
        known = zstandard.ZstdCompressionDict(dictionary.value) if dictionary.value else None
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True)
        records = size = 0
        with system.open_output_stream(path, compression=None) as out:  # the name ends in .zst, but its frames are made here
            out.write(head_frame(dictionary.value))
            for row in (r for part in ([first], rows) for r in part):
                page_id, url, html, place, *kept = (x.as_py() for x in row)
                frame = compressor.compress(record(page_id, url, html.encode("utf-8", "surrogatepass"), place, tuple(kept) if kept[0] is not None else None))
                out.write(frame)
                records, size = records + 1, size + len(frame)
        yield pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})

    manifest = in_small_batches(rows).mapInArrow(write, "path string, records long, bytes long")
    return stored(manifest.withColumn("folder", F.lit(folder)), "manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to and url of every record of the manifest's archives."""
    paths = manifest.select("path", "folder", "records").repartition(max(1, manifest.count()))  # a task an archive
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, folder, records in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, _ = pafs.FileSystem.from_uri(folder)
                found = 0
                with system.open_input_stream(path, compression=None) as stream:
                    rows = map(parsed, read_records(stream))
                    while some := list(islice(rows, 1000)):
                        found += len(some)
                        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                        yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in some], k) for n, k in zip(names, kinds, strict=True)], names=names)
                if found != records:
                    raise ValueError(f"{path} has {found} records; the manifest says {records}")

    return paths.mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


# The base32 alphabet is a fixed value of RFC 4648.
ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
k AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS keep FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keep THEN keep END AS refers_to
FROM k
"""
