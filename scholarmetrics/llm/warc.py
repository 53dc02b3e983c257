"""Operator 10: WARC archives, index first.

``write`` makes one gzip member per record (so each can be read by itself) and
returns the index: archive, offset, length, URL and digest of every record.  Each
task writes archives of its own under a fresh name and reports them in its index
rows; only rows of tasks that succeeded reach the index, so a lost executor or a
second attempt leaves at most an archive that nothing refers to.  Equal payloads of
at least ``least`` bytes are written once; other records revisit that one.

``read`` takes any selection of the index, deals it to tasks by the archives' bytes, sorts
it by archive and offset, joins neighbouring byte ranges to one read, and checks each
payload against its digest.

Archives go to a folder that all executors share, by any URI that pyarrow.fs opens.

Cases: a null payload is empty; a null URL is left out of the record and null in the
index; a null page id is kept; rows that repeat the largest id of a group of equal
payloads are all responses; an empty table gives an empty index; further columns of
the pages are not archived.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarmetrics.llm.common import checked_join, cut, shared_dir

#: Payloads shorter than this are never revisits.
LEAST = 1000
#: A task begins a new archive beyond this size.
ARCHIVE_BYTES = 256 << 20
#: Ranges with a gap up to the first are read as one, up to the second in all.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20

_INDEX = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, "
    "payload_bytes bigint, archive string, offset bigint, length bigint"
)
_RECORDS = "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, payload binary"
_EOL = b"\r\n"


def with_revisits(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Add ``payload`` (binary), its digest and size, ``record_type`` and ``refers_to``."""
    body = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    pages = pages.select("page_id", "url", body.alias("payload"))
    pages = pages.withColumns({"payload_digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})
    first = (
        pages.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("__response"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .drop("n")
    )
    joined = checked_join(pages, cut(first), ["payload_digest", "payload_bytes"], "left")
    again = F.col("__response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("__response"))
    return joined.withColumn("record_type", F.when(again, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(again, F.col("__response"))
    ).drop("__response")


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _record(row: dict, date: str) -> bytes:
    """A response holds an HTTP response, whose body is the payload; a revisit holds none."""
    response, block = row["record_type"] == "response", b""
    if response:
        size = str(len(row["payload"])).encode()
        http = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: " + size, b"", b""]
        block = _EOL.join(http) + row["payload"]
    head = [
        ("WARC-Type", row["record_type"]),
        ("WARC-Record-ID", _name(row["page_id"])),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{row['payload_digest']}"),
        ("X-Payload-Length", str(row["payload_bytes"])),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if row["url"] is not None:
        head.insert(2, ("WARC-Target-URI", quote(row["url"], safe=":/?#[]@!$&'()*+,;=~")))
    if not response:
        head.insert(3, ("WARC-Refers-To", _name(row["refers_to"])))
        head.insert(4, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    lines = [b"WARC/1.1", *(f"{k}: {v}".encode() for k, v in head), b"", b""]
    return _EOL.join(lines) + block + _EOL + _EOL


def write(pages: DataFrame, folder: str | None = None, least: int = LEAST, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the archives and return the index (kept in the shared folder)."""
    folder = folder or f"{shared_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, top = fs.FileSystem.from_uri(folder)
        out, name, at = None, "", 0
        for batch in batches:
            index = []
            for row in batch.to_pylist():
                if out is None or at > ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    disk.create_dir(top, recursive=True)
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = disk.open_output_stream(f"{top}/{name}", compression=None)
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = pack.compress(_record(row, date)) + pack.flush()
                out.write(data)
                del row["payload"]
                index.append(row | {"archive": name, "offset": at, "length": len(data)})
                at += len(data)
            yield pa.RecordBatch.from_pylist(index, schema=_schema(_INDEX))
        if out is not None:
            out.close()

    index = cut(with_revisits(pages, least).mapInArrow(run, _INDEX))
    return index.withColumn("archive", F.concat(F.lit(folder.rstrip("/") + "/"), F.col("archive")))


def _schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def _parse(member: bytes) -> dict:
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(_EOL + _EOL)
    fields = dict(x.decode().split(": ", 1) for x in head.split(_EOL)[1:])
    body = rest[: int(fields["Content-Length"])].partition(_EOL + _EOL)[2]
    number = lambda k: int(v) if (v := fields[k][len("<urn:page:") : -1]) else None
    response = fields["WARC-Type"] == "response"
    return {
        "page_id": number("WARC-Record-ID"),
        "url": unquote(fields["WARC-Target-URI"]) if "WARC-Target-URI" in fields else None,
        "record_type": "response" if response else "revisit",
        "refers_to": None if response else number("WARC-Refers-To"),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload_bytes": int(fields["X-Payload-Length"]),
        "payload": body if response else None,
    }


def ranges(rows: list[dict]) -> Iterator[list[dict]]:
    """Runs of rows of one archive, by offset, that one read can serve."""
    run: list[dict] = []
    for row in rows:
        if run and (
            row["archive"] != run[-1]["archive"]
            or row["offset"] > run[-1]["offset"] + run[-1]["length"] + GAP_BYTES
            or row["offset"] + row["length"] - run[0]["offset"] > READ_BYTES
        ):
            yield run
            run = []
        run.append(row)
    if run:
        yield run


def read(index: DataFrame) -> DataFrame:
    """The records that the selected index rows point to; payload is null for revisits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, name, source = _schema(_RECORDS), "", None
        for batch in batches:
            for part in ranges(batch.to_pylist()):
                if part[0]["archive"] != name:
                    name = part[0]["archive"]
                    disk, path = fs.FileSystem.from_uri(name)
                    source = disk.open_input_file(path)
                start = part[0]["offset"]
                data = source.read_at(max(r["offset"] + r["length"] for r in part) - start, start)
                yield pa.RecordBatch.from_pylist([_parse(data[r["offset"] - start :][: r["length"]]) for r in part], schema=schema)

    # tasks follow the bytes of the archives, not those of the (much smaller) index
    chunk = F.floor(F.col("offset") / READ_BYTES)
    size = index.agg(F.sum("length"), F.count_distinct("archive", chunk)).first()
    tasks = max(-(-(size[0] or 0) // READ_BYTES), index.sparkSession.sparkContext.defaultParallelism)
    tasks = max(1, min(size[1], tasks))
    chosen = index.select("archive", "offset", "length").repartition(tasks, "archive", chunk).sortWithinPartitions("archive", "offset")
    records = chosen.mapInArrow(run, _RECORDS)
    wrong = F.col("payload").isNotNull() & (F.sha1("payload") != F.col("payload_digest"))
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("digest differs: page "), F.col("page_id").cast("string"))).cast("string"))
    return records.withColumn("payload_digest", F.coalesce(checked, F.col("payload_digest")))
