"""WARC archives: writing, revisit resolution, reading.

``write_raw`` stores one response record per page.  ``resolve`` then decides on
headers alone: they are shuffled by payload digest, and in each group of equal
payloads one record stays the response (the largest page_id) and the others
become revisits of it.  ``rewrite`` copies the archives file by file with fresh
headers: a revisit record carries the digest and the target's record id, but no
payload.  ``read`` lists the records of archives, and ``resolve_revisits`` gives
revisit records back the payload length of the response that they refer to.
Payloads never go through a shuffle; only headers do.

Records are gzip members of their own (``.warc.gz``), format WARC/1.1, payload
digests bare upper-case base32 SHA-1.

Defined cases: null html is an empty payload; null page_id sorts below all others
and comes back null; of rows that share payload and page_id the first record in
file order is the response; payloads shorter than ``min_bytes`` are always
responses; control characters in urls are percent-encoded; an empty table gives
no archives and no rows.  Extra columns are not written.

Recovery: archives carry a random part per task attempt in their names, and the
record tables written next to them list only files of successful attempts.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline.llm.common import attempt_name, file_dir, map_arrow, materialize, open_fs

#: Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
HTTP_REVISIT = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

RAW = "part int, file string, seq long, page_id long, payload_digest string, payload_bytes long"
RECORDS = ("file string, seq long, record_id string, record_type string, page_id long, url string, "
           "payload_digest string, payload_bytes long, refers_to_id string")
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(file: str, seq: int) -> str:
    """A record's id: a name-based UUID, so that a revisit can name its target before it is written."""
    h = hashlib.sha1(f"{file}#{seq}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-5{h[13:16]}-8{h[17:20]}-{h[20:32]}>"


def record(kind: str, rid: str, page_id: int | None, url: str | None, digest: str, block: bytes, date: str,
           refers_to: str | None = None) -> bytes:
    """One gzip member with a whole record."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Date", date),
            ("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("Content-Length", str(len(block)))]
    if url is not None:
        head.append(("WARC-Target-URI", _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)))
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        head += [("WARC-Refers-To", refers_to), ("WARC-Profile", PROFILE)]
    lines = b"".join(f"{k}: {v}\r\n".encode("utf-8", "replace") for k, v in head)
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return b"".join((pack.compress(VERSION + b"\r\n" + lines + b"\r\n"), pack.compress(block),
                     pack.compress(b"\r\n\r\n"), pack.flush()))


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records (headers, block) of an open archive, one gzip member in memory at a time."""
    rest = b""
    while True:
        unpack, out = zlib.decompressobj(31), []
        while not unpack.eof:
            if not rest:
                rest = stream.read(1 << 20)
                if not rest:
                    if out:
                        raise OSError("archive ends inside a record")
                    return
            out.append(unpack.decompress(rest))
            rest = unpack.unused_data
        data = b"".join(out)
        head, _, body = data.partition(b"\r\n\r\n")
        first, *lines = head.split(b"\r\n")
        if first != VERSION:
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        fields = dict(x.decode("utf-8", "replace").split(": ", 1) for x in lines)
        yield fields, body[:int(fields["Content-Length"])]


def payload_of(block: bytes) -> bytes:
    """The HTTP body of a response block."""
    return block.partition(b"\r\n\r\n")[2]


def _batch(rows: list[dict], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(list(types.items())))


_L, _S = pa.int64(), pa.string()
_RAW_TYPES = {"part": pa.int32(), "file": _S, "seq": _L, "page_id": _L, "payload_digest": _S, "payload_bytes": _L}
_FILE_TYPES = {"part": pa.int32(), "file": _S}
_RECORD_TYPES = {"file": _S, "seq": _L, "record_id": _S, "record_type": _S, "page_id": _L, "url": _S,
                 "payload_digest": _S, "payload_bytes": _L, "refers_to_id": _S}


def write_raw(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write every page as a response record, one archive per task; returns the headers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        part = TaskContext.get().partitionId()
        name, seq, out = attempt_name("raw", part, ".warc.gz"), 0, None
        try:
            for batch in batches:
                rows = []
                for page_id, url, html in zip(*(batch.column(c) for c in ("page_id", "url", "html"))):
                    payload = (html.as_py() or "").encode("utf-8", "replace")
                    digest, pid = payload_digest(payload), page_id.as_py()
                    out = out or fs.open_output_stream(f"{root}/{name}", compression=None)
                    out.write(record("response", record_id(name, seq), pid, url.as_py(), digest,
                                     HTTP_HEAD % len(payload) + payload, date))
                    rows.append(dict(part=part, file=name, seq=seq, page_id=pid, payload_digest=digest,
                                     payload_bytes=len(payload)))
                    seq += 1
                yield _batch(rows, _RAW_TYPES)
        finally:
            if out is not None:
                out.close()

    source = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html")
    return materialize(map_arrow(source, run, RAW), "warc-raw")


def resolve(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Add target_file and target_seq: the record that a revisit refers to (null: a response).

    The response of a digest is found by a partial aggregate (one row per digest and
    task is shuffled, whatever the number of copies); only digests with copies are
    joined back.
    """
    order = F.struct(F.coalesce(F.col("page_id"), F.lit(-(1 << 63))).alias("id"), F.col("page_id").isNotNull().alias("has"),
                     (-F.col("seq")).alias("seq"), F.col("file").alias("file"))
    groups = (headers.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
              .agg(F.max(order).alias("t"), F.count("*").alias("n")).filter("n > 1")
              .select("payload_digest", "payload_bytes", F.col("t.file").alias("target_file"),
                      (-F.col("t.seq")).alias("target_seq")))
    joined = headers.join(groups, ["payload_digest", "payload_bytes"], "left")
    own = (F.col("target_file") == F.col("file")) & (F.col("target_seq") == F.col("seq"))
    return (joined.withColumn("__own", F.coalesce(own, F.lit(True)))
            .withColumn("target_file", F.when(~F.col("__own"), F.col("target_file")))
            .withColumn("target_seq", F.when(~F.col("__own"), F.col("target_seq"))).drop("__own"))


def rewrite(resolved: DataFrame, headers: DataFrame, raw_folder: str, folder: str) -> DataFrame:
    """Copy the archives with fresh headers; returns one row (file) per archive written.

    Each task gets the decisions of whole archives, in record order, and streams
    through the archive beside them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        raw_fs, raw_root = open_fs(raw_folder)
        name = current = out = source = None
        done = []
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if row["file"] != current:
                        for f in (out, source):
                            if f is not None:
                                f.close()
                        current = row["file"]
                        name = attempt_name("dedup", TaskContext.get().partitionId(), ".warc.gz")
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                        source = raw_fs.open_input_file(f"{raw_root}/{current}")
                        records = enumerate(parse(source))
                        done.append(dict(part=row["part"], file=name))
                    for seq, (head, block) in records:
                        if seq == row["seq"]:
                            break
                    else:
                        raise ValueError(f"{current} has no record {row['seq']}")
                    target = None if row["target_file"] is None else record_id(row["target_file"], row["target_seq"])
                    out.write(record(head["WARC-Type"] if target is None else "revisit", head["WARC-Record-ID"],
                                     int(head["X-Page-ID"]) if "X-Page-ID" in head else None, head.get("WARC-Target-URI"),
                                     head["WARC-Payload-Digest"].removeprefix("sha1:"),
                                     block if target is None else HTTP_REVISIT, head["WARC-Date"], target))
            yield _batch(done, _FILE_TYPES)
        finally:
            for f in (out, source):
                if f is not None:
                    f.close()

    decisions = resolved.select("part", "file", "seq", "target_file", "target_seq")
    work = by_part(decisions, headers).sortWithinPartitions("file", "seq")
    return materialize(map_arrow(work, run, "part int, file string"), "warc-files")


def by_part(rows: DataFrame, table: DataFrame) -> DataFrame:
    """One task per archive: rows go to the partition number that wrote it (``table`` is a written table of them)."""
    last = table.agg(F.max("part")).first()[0]
    return rows.repartitionById((last or 0) + 1, "part")


def read(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """Records of archives: one row per record, digests computed anew for responses and checked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                rows = []
                with fs.open_input_file(f"{root}/{name}") as f:
                    for seq, (head, block) in enumerate(parse(f)):
                        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                        response = head["WARC-Type"] == "response"
                        payload = payload_of(block) if response else b""
                        if response and payload_digest(payload) != digest:
                            raise ValueError(f"{name}: record {seq} does not match its digest")
                        rows.append(dict(file=name, seq=seq, record_id=head["WARC-Record-ID"], record_type=head["WARC-Type"],
                                         page_id=int(head["X-Page-ID"]) if "X-Page-ID" in head else None,
                                         url=head.get("WARC-Target-URI"), payload_digest=digest,
                                         payload_bytes=len(payload) if response else None,
                                         refers_to_id=head.get("WARC-Refers-To")))
                        if len(rows) >= 5000:
                            yield _batch(rows, _RECORD_TYPES)
                            rows = []
                yield _batch(rows, _RECORD_TYPES)

    return map_arrow(by_part(files, files), run, RECORDS)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Give revisits the payload length and page_id of the response that they refer to.

    Only responses that somebody refers to are joined; revisits of one hot response
    are many rows of one key against a single row, which the join can split.
    """
    revisits = records.filter(F.col("refers_to_id").isNotNull())
    targets = (records.filter(F.col("record_type") == "response")
               .select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"),
                       F.col("payload_bytes").alias("__bytes")))
    found = (revisits.join(targets, "refers_to_id", "left").withColumn("payload_bytes", F.col("__bytes")).drop("__bytes"))
    plain = records.filter(F.col("refers_to_id").isNull()).withColumn("refers_to", F.lit(None).cast("long"))
    return plain.unionByName(found)


def dedup(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write, resolve, rewrite and read back: the records of the deduplicated archives."""
    spark = pages.sparkSession
    raw_folder, folder = file_dir(spark, "warc-raw-files"), file_dir(spark, "warc-dedup-files")
    headers = write_raw(pages, raw_folder)
    files = rewrite(resolve(headers, min_bytes), headers, raw_folder, folder)
    return resolve_revisits(materialize(read(spark, files, folder), "warc-records"))
