"""Web archives, index first: every record's place is written down with it, and reads follow the index.

Tasks write one gzip member per record to archives in a shared folder and return the index: archive, offset, length,
url and digest.  Only files named in the index count, so what a lost task left behind is never read.  Reading sorts the
selected index rows by place and fetches neighbouring records with one byte-range read.

Defined results: a null html is an empty payload; of equal payloads of at least ``least`` bytes the record with the
smallest page_id is the response and the others revisit it (a null id is the smallest only if there is no other);
rows equal in id and payload are written alike; a null url has no target header, control characters in one are
percent-encoded; an empty table writes nothing; further columns are not read, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanframe.llm.common import stored

ROLL = 256 << 20         # bytes after which a task begins a new archive
GAP = 64 << 10           # bytes between two records that are read rather than skipped
READ = 8 << 20           # bytes of one coalesced read, unless a single record is longer
TASK_BYTES = 16 << 20   # of the archives that one task reads back
DATE = "2024-01-01T00:00:00Z"
URN = "urn:page:"
INDEX = "archive string, offset bigint, length bigint, url string, digest string, page_id {0}, record_type string, refers_to {0}"


def records(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, payload, record_type, refers_to."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload.cast("binary"), 256).alias("same"))
    long_enough = F.octet_length(F.coalesce("html", F.lit(""))) >= least
    keys = pages.filter(long_enough).select("page_id", F.sha2(payload.cast("binary"), 256).alias("same"))
    first = keys.groupBy("same").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    # stored, so that the join deals both sides itself and Spark may split a hot payload
    found = rows.join(stored(first).hint("shuffle_hash"), "same", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return found.select("page_id", "url", "payload", F.when(again, "revisit").otherwise("response").alias("record_type"),
                        F.when(again, F.col("first")).alias("refers_to"))


def _record(page_id, url: str | None, payload: bytes, kind: str, refers_to) -> tuple[bytes, str]:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if kind == "response" else http
    head = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <{URN}{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub("[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        head += [f"WARC-Refers-To: <{URN}{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest


def write(rows: DataFrame, folder: str) -> DataFrame:
    """Writes the records to archives below ``folder`` and returns the index, which is written there as well."""
    schema = INDEX.format(rows.schema["page_id"].dataType.simpleString())

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        out, name, offset = None, "", 0
        for batch in batches:
            ids, url, kind, refers = (batch.column(c) for c in ("page_id", "url", "record_type", "refers_to"))
            place, digests = [], []
            for i in range(batch.num_rows):
                payload = batch.column("payload")[i].as_py().encode()
                raw, digest = _record(ids[i].as_py(), url[i].as_py(), payload, kind[i].as_py(), refers[i].as_py())
                packer = zlib.compressobj(3, zlib.DEFLATED, 31)
                member = packer.compress(raw) + packer.flush()
                if out is None or offset + len(member) > ROLL:
                    if out is not None:
                        out.close()
                    name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{path}/{name}", compression=None)
                out.write(member)
                place.append((f"{folder}/{name}", offset, len(member)))
                digests.append(digest)
                offset += len(member)
            columns = [pa.array([p[0] for p in place], pa.string()), *(pa.array([p[k] for p in place], pa.int64()) for k in (1, 2)),
                       url, pa.array(digests, pa.string()), ids, kind, refers]
            yield pa.RecordBatch.from_arrays(columns, names=["archive", "offset", "length", "url", "digest", "page_id", "record_type", "refers_to"])
        if out is not None:
            out.close()

    rows.mapInArrow(save, schema).write.parquet(f"{folder}/index")
    return rows.sparkSession.read.schema(schema).parquet(f"{folder}/index")


def _runs(offset: list[int], length: list[int], archive: list[str]) -> Iterator[tuple[int, int]]:
    """Row ranges whose records are fetched with one read."""
    first = 0
    for i in range(1, len(offset) + 1):
        if i < len(offset) and archive[i] == archive[first]:
            gap, end = offset[i] - offset[i - 1] - length[i - 1], offset[i] + length[i]
            if gap <= GAP and end - offset[first] <= READ:
                continue
        yield first, i
        first = i


def _parsed(member: bytes) -> tuple[dict[str, str], bytes]:
    raw = zlib.decompressobj(31).decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    return fields, block


def read(index: DataFrame, payload: bool = True, bytes_per_task: int = TASK_BYTES) -> DataFrame:
    """The selected records: page_id, url, payload_bytes, payload_digest, record_type, refers_to (and the payload).

    The payload of a response is read, counted and digested anew; one that differs from its header is an error.  A
    revisit has no payload; its counts are those of its headers.
    """
    kind = index.schema["page_id"].dataType.simpleString()
    number = index.schema["page_id"].dataType.typeName() in ("long", "integer", "short", "byte")
    schema = f"page_id {kind}, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to {kind}"

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payload
        opened = (None, None)
        for batch in batches:
            archive, offset, length = (batch.column(c).to_pylist() for c in ("archive", "offset", "length"))
            types = [batch.schema.field("page_id").type, pa.string(), pa.int64(), pa.string(), pa.string(), batch.schema.field("page_id").type, pa.string()]
            for a, b in _runs(offset, length, archive):
                if opened[0] != archive[a]:
                    store, path = fs.FileSystem.from_uri(archive[a])
                    opened = (archive[a], store.open_input_file(path))
                opened[1].seek(offset[a])
                data, rows = opened[1].read(offset[b - 1] + length[b - 1] - offset[a]), []
                for i in range(a, b):
                    at = offset[i] - offset[a]
                    rows.append(_row(*_parsed(data[at:at + length[i]]), number)[:len(names)])
                columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types[:len(names)])]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    placed = index.select("archive", "offset", "length", "page_id")
    # by the bytes that are to be read, not by the size of the index
    tasks = max(1, math.ceil((placed.agg(F.sum("length")).first()[0] or 0) / bytes_per_task))
    placed = placed.repartitionByRange(tasks, "archive", "offset")
    return placed.sortWithinPartitions("archive", "offset").mapInArrow(load, schema + ", payload string" * payload)


def _row(fields: dict[str, str], block: bytes, number: bool) -> tuple:
    def of(name: str):
        text = fields.get(name, "")[1 + len(URN):-1]
        return None if not text else int(text) if number else text

    http, _, body = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (size, digest) != (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode()):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is not what its headers say")
    text = body.decode() if fields["WARC-Type"] == "response" else None
    return of("WARC-Record-ID"), fields.get("WARC-Target-URI"), size, digest, fields["WARC-Type"], of("WARC-Refers-To"), text
