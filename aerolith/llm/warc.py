"""Web archives with a two-level capture index.

Pages are written as WARC records, one gzip member each. Records with equal payloads are stored once:
the one with the largest page_id is the response, the others are revisits that refer to it. Every
record gets an index entry, keyed by its URL with the host reversed (com,example,blog)/path) and its
page_id. Entries are range-sorted into shards; a shard is a file of compressed blocks of sorted
entries followed by a sparse directory, the first key and place of each block. Above them stands a
list with one line per shard, whose number is that of shuffle partitions.

A look-up finds the shard in that list and the block in the directory by binary search, reads that
block alone, and finds the entry in it by binary search again; then it reads the record's bytes.
Look-ups of many keys are dealt by shard and sorted, so that each block is read once, and the record
reads are dealt by file and place, so that neighbouring records come with one read.

Executors read and write the shared folder through pyarrow's file systems. A task that is run again
writes new files; only the files named in the rows of committed tasks are ever read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from aerolith.session import scratch_path, stored

LEAST_PAYLOAD = 0
BLOCK_ENTRIES = 512
FILE_BYTES = 512 << 20
READ_BYTES = 8 << 20
STRETCH_BYTES = 16 << 20  # of an archive, read by one task
_NO_ID = -(2**63)
_CONTROL = re.compile(r"[\x00-\x20\x7f]")
_URL = re.compile(r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*)(?::\d+)?([^#]*)")


def surt(url: str | None) -> str:
    """The URL's key: host labels reversed, then path and query; scheme, port and fragment go. What
    is no URL stands as it is, null as nothing; control characters and spaces are escaped."""
    plain = _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url or "")
    found = _URL.match(plain)
    if not found:
        return plain
    return ",".join(reversed(found[1].lower().split("."))) + ")" + (found[2] or "/")


def _file_system(path: str):
    """Arrow's file system for a folder as Spark names it: local files, S3 and, where their native
    libraries are installed, HDFS and Google Cloud Storage."""
    from pyarrow.fs import FileSystem

    scheme, colon, rest = path.partition(":")
    return FileSystem.from_uri(_SCHEMES.get(scheme, scheme) + colon + rest)


_SCHEMES = {"s3a": "s3", "s3n": "s3"}  # Spark's names to Arrow's


class _Reader:
    """Range reads; the last file stays open."""

    def __init__(self):
        self.path, self.file = None, None

    def __call__(self, path: str, offset: int, length: int) -> bytes:
        if path != self.path:
            system, inside = _file_system(path)
            self.path, self.file = path, system.open_input_file(inside)
        self.file.seek(offset)
        return self.file.read(length)


# Records ----------------------------------------------------------------------------------------


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, revisit: bool, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member. A revisit keeps the HTTP header and leaves out the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    body = http.encode() + (b"" if revisit else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
        "WARC-Date: 2024-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(body)}",
        "Content-Type: application/http;msgtype=response",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:x-page:{'' if refers_to is None else refers_to}>")
    whole = "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(whole) + packer.flush()


def parse_record(member: bytes) -> dict:
    """Fields of a record: page_id, payload_bytes, payload_digest, record_type, refers_to and payload
    (None for a revisit). A response whose payload does not have its digest is an error."""
    whole = zlib.decompress(member, 31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or _digest(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda name: int(v) if (v := fields.get(name, "")[len("<urn:x-page:") : -1]) else None
    return {
        "page_id": number("WARC-Record-ID"),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": number("WARC-Refers-To"),
        "payload": None if revisit else payload,
    }


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# Writing ----------------------------------------------------------------------------------------


def with_roles(pages: DataFrame, least_payload: int = LEAST_PAYLOAD) -> DataFrame:
    """page_id, url, payload, revisit and refers_to of every row of `pages`.

    Payloads are compared by SHA-1 and length on narrow rows. Only the list of revisits is joined to
    the payloads, which is built as a hash table, so payloads are shuffled once and never sorted.
    Rows that share the largest page_id of a payload are all responses. A null id is the smallest.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    whole = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha1", F.sha1("payload"))
    narrow = stored(
        whole.filter(F.length("payload") >= least_payload).select("page_id", "sha1"), "warc-digests"
    )
    largest = (
        narrow.groupBy(F.col("sha1").alias("s"))
        .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) & F.col("refers_to").isNotNull())
    )
    smaller = F.col("page_id").isNull() | (F.col("page_id") < F.col("refers_to"))
    revisits = (
        narrow.join(largest, F.col("sha1") == F.col("s"))
        .filter(smaller)
        .select(F.col("page_id").alias("p"), "s", "refers_to")
        .distinct()
    )
    hit = F.col("page_id").eqNullSafe(F.col("p")) & (F.col("sha1") == F.col("s"))
    joined = whole.join(revisits.hint("shuffle_hash"), hit, "left")
    return joined.select("page_id", "url", "payload", F.col("s").isNotNull().alias("revisit"), "refers_to")


ENTRY = "surt string, id long, file string, offset long, length long"


def write_archives(pages: DataFrame, folder: str, least_payload: int = LEAST_PAYLOAD, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the pages' records to archives below `folder`; the index entries, stored.

    Each task writes its own files, about `file_bytes` each.
    """

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, at = None, None, 0
        for batch in batches:
            entries = []
            for page_id, url, payload, revisit, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None or at >= file_bytes:
                    if out is not None:
                        out.close()
                    path, at = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                    system, inside = _file_system(path)
                    out = system.open_output_stream(inside, compression=None)
                member = record(page_id, url, payload, _digest(payload), revisit, refers_to)
                out.write(member)
                entries.append((surt(url), _NO_ID if page_id is None else page_id, path, at, len(member)))
                at += len(member)
            columns = list(zip(*entries)) or [[]] * 5
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["surt", "id", "file", "offset", "length"],
            )
        if out is not None:
            out.close()

    _make_folder(pages.sparkSession, folder)
    return stored(with_roles(pages, least_payload).mapInArrow(write, ENTRY), "warc-entries")


def _make_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)


# Index ------------------------------------------------------------------------------------------


def build_index(entries: DataFrame, folder: str, shards: int | None = None, block_entries: int = BLOCK_ENTRIES) -> list[tuple]:
    """Write the index shards below `folder`. Returns the list above them, at most `shards` lines in
    key order: first surt, first id, file, and the place and length of its directory. The cluster's
    number of shuffle partitions is the number of shards where none is given."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, at, directory, block = f"{folder}/{uuid.uuid4().hex}.cdx", None, 0, [], []

        def flush():
            nonlocal at
            data = zlib.compress("\n".join("\t".join(map(str, e)) for e in block).encode())
            out.write(data)
            directory.append([block[0][0], block[0][1], at, len(data)])
            at += len(data)
            block.clear()

        for batch in batches:
            for entry in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    system, inside = _file_system(path)
                    out = system.open_output_stream(inside, compression=None)
                block.append(entry)
                if len(block) == block_entries:
                    flush()
        if out is None:
            return
        if block:
            flush()
        data = zlib.compress(json.dumps(directory).encode())
        out.write(data)
        out.close()
        first = directory[0]
        yield pa.RecordBatch.from_pylist(
            [{"surt": first[0], "id": first[1], "file": path, "offset": at, "length": len(data)}]
        )

    _make_folder(entries.sparkSession, folder)
    dealt = entries.repartitionByRange(*([shards] if shards else []), "surt", "id")
    sorted_ = dealt.sortWithinPartitions("surt", "id")
    lines = stored(sorted_.mapInArrow(write, ENTRY), "warc-shards")
    # As many lines as shards; keys compare as UTF-8 bytes, as Spark sorts them.
    return sorted((tuple(r) for r in lines.collect()), key=lambda r: (r[0].encode(), r[1]))


def look_up(keys: DataFrame, shards: list[tuple]) -> DataFrame:
    """Index entries of the (surt, id) keys; keys that are not indexed give none, repeated keys the
    same entries once."""
    starts = [(r[0].encode(), r[1]) for r in shards]

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            # Equal keys are in one shard, the last that begins at or before them.
            at = [max(bisect_right(starts, (s.encode(), i)) - 1, 0) for s, i in wanted]
            yield batch.append_column("shard", pa.array(at, pa.int32()))

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, shard, directory, heads, held, entries, entry_keys = _Reader(), None, [], [], None, [], []
        for batch in batches:
            out = []
            for s, i, at in zip(*(c.to_pylist() for c in batch.columns)):
                if at != shard:
                    shard, held = at, None
                    *_, file, offset, length = shards[at]
                    directory = json.loads(zlib.decompress(read(file, offset, length)))
                    heads = [(d[0].encode(), d[1]) for d in directory]
                key = (s.encode(), i)
                # The block before the first that begins at or after the key may end with it.
                block = max(bisect_left(heads, key) - 1, 0)
                while block < len(heads) and heads[block] <= key:
                    if block != held:
                        data = zlib.decompress(read(shards[shard][2], *directory[block][2:])).decode()
                        entries = [line.split("\t") for line in data.split("\n")]
                        entry_keys = [(e[0].encode(), int(e[1])) for e in entries]
                        held = block
                    low = bisect_left(entry_keys, key)
                    high = bisect_right(entry_keys, key)
                    out += [(e[0], int(e[1]), e[2], int(e[3]), int(e[4])) for e in entries[low:high]]
                    block += 1
            columns = list(zip(*out)) or [[]] * 5
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["surt", "id", "file", "offset", "length"],
            )

    if not shards:
        return keys.sparkSession.createDataFrame([], ENTRY)
    routed = keys.select("surt", "id").distinct().mapInArrow(route, "surt string, id long, shard int")
    # Without a number, adaptive execution would go by the bytes of the keys and read all in one task.
    dealt = routed.repartition(len(shards), "shard").sortWithinPartitions("shard", "surt", "id")
    return dealt.mapInArrow(find, ENTRY)


def read_records(
    entries: DataFrame, with_payload: bool = False, read_bytes: int = READ_BYTES, stretches: int | None = None
) -> DataFrame:
    """The records at the entries' places, read in order of file and place, near ones together.

    `stretches` is the number of tasks; it should follow the bytes to be read, which the places
    alone do not show.
    """
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    schema += ", payload binary" if with_payload else ""
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][: len(names)]

    def fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, file, start, held = _Reader(), None, 0, b""
        for batch in batches:
            rows, size = [], 0
            for path, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if path != file or offset < start or offset + length > start + len(held):
                    file, start, held = path, offset, read(path, offset, max(length, read_bytes))
                found = parse_record(held[offset - start : offset - start + length])
                rows.append([found[n] for n in names])
                size += found["payload_bytes"] if with_payload else 0
                if size > read_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    places = entries.select("file", "offset", "length")
    by = ["file", F.floor(F.col("offset") / STRETCH_BYTES)]
    dealt = places.repartition(stretches, *by) if stretches else places.repartition(*by)
    dealt = dealt.sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(fetch, schema)


# Whole operator ---------------------------------------------------------------------------------


def page_keys(pages: DataFrame) -> DataFrame:
    """(surt, id) of every row, as the index has them."""

    def keys(batches):
        for batch in batches:
            ids = [_NO_ID if i is None else i for i in batch.column(0).to_pylist()]
            surts = [surt(u) for u in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(surts, pa.string()), pa.array(ids, pa.int64())], names=["surt", "id"])

    return pages.select("page_id", "url").mapInArrow(keys, "surt string, id long")


def archive_and_read(pages: DataFrame, least_payload: int = LEAST_PAYLOAD, shards: int | None = None, with_payload: bool = False) -> DataFrame:
    """Archive all pages, then look every one up in the index and read its record.

    One row per row of `pages`: page_id, payload_bytes, payload_digest, record_type, refers_to. Null
    html is an empty payload, which counts as any other; null URLs have the empty key; repeated rows
    have a record each; an empty table gives an empty result; other columns are not read.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    entries = write_archives(pages, f"{folder}/archives", least_payload)
    index = build_index(entries, f"{folder}/index", shards)
    archived = entries.agg(F.sum("length")).first()[0] or 0
    found = look_up(page_keys(pages), index)
    return read_records(found, with_payload, stretches=max(1, -(-archived // STRETCH_BYTES)))
