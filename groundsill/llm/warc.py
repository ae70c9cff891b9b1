"""WARC archives: written as one gzip stream per file, then normalised to one member per record.

Writing. A record is a line of Spark's text source whose line end is the blank lines that end a WARC
record, so that Spark itself writes whole-file gzip archives to whatever store the folder is in.
Pages with equal payloads are stored once; the others are revisit records that refer to it.

Normalising. Each archive is inflated once, as a stream, and each record is written again as a gzip
member of its own, so that a reader can begin at any record. A sidecar index beside the archive
holds offset and length of every member, one JSON line each. Files are written under a name of the
attempt's own and renamed when complete: a lost executor leaves nothing half written.

Reading. The index alone says where to read; each member is fetched by offset and length.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundsill.session import materialize, shared_dir, ship_with_tasks

ship_with_tasks(__name__)

RECORDS_PER_FILE = 4000
_END = "\r\n\r\n"
_URN = "urn:groundsill:page:"
_INDEX_TYPE = "archive string, offset bigint, length bigint, record_id string, type string"
_CHUNK = 1 << 18

# Names and the profile that the WARC format gives.
_VERSION = "WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"


def digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a text's UTF-8 bytes, built from its hexadecimal form:
    ten hexadecimal digits are eight base32 digits."""
    hexed = F.sha1(F.encode(payload, "UTF-8"))
    pieces = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*pieces)), "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """One row per page: ``page_id, url, payload, payload_bytes, payload_digest, refers_to``.

    Of pages with equal payloads of at least ``least_bytes`` bytes the smallest id is kept, the
    others refer to it. A null html is an empty payload. A null id is never the one kept unless it is
    alone; rows that repeat the smallest id with the same payload are all kept.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    base = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    base = base.withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"),
                             "payload_digest": digest(F.col("payload"))})
    # Only digests that occur more than once are joined; their table is stored, so that Spark knows
    # its size and can split a digest that a third of all pages share.
    shared = materialize(base.where(F.col("payload_bytes") >= least_bytes).groupBy(
        "payload_digest", "payload_bytes").agg(
            F.min("page_id").alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n"))
    return base.join(shared, ["payload_digest", "payload_bytes"], "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept")),
               F.col("kept")).alias("refers_to"))


def _record_id(page: Column) -> Column:
    return F.concat(F.lit(f"<{_URN}"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def _text(rows: DataFrame) -> DataFrame:
    """Records as WARC text, without the blank lines that end them."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(_END))
    revisit = F.col("refers_to").isNotNull()
    body = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))
    target = F.col("url")
    for raw, coded in (("\r", "%0D"), ("\n", "%0A"), (" ", "%20"), ("\t", "%09")):
        target = F.replace(target, F.lit(raw), F.lit(coded))
    lines = [
        F.lit(_VERSION),
        F.when(revisit, "WARC-Type: revisit").otherwise("WARC-Type: response"),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"))),
        F.lit(f"WARC-Date: {_DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.when(revisit, f"WARC-Profile: {_PROFILE}"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("refers_to")))),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    ]
    return rows.select(F.concat(F.concat_ws("\r\n", *lines), F.lit(_END), body).alias("value"))


def write_monolithic(rows: DataFrame, folder: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Rows of :func:`records` as ``*.gz`` archives of one gzip stream each."""
    _text(rows).write.option("lineSep", _END).option("compression", "gzip").option(
        "maxRecordsPerFile", records_per_file).text(folder)


class _Stream:
    """The inflated bytes of a whole-file gzip stream (or of several members), read forward."""

    def __init__(self, data: bytes):
        self.data, self.at, self.inflater, self.held = data, 0, zlib.decompressobj(31), b""

    def _more(self) -> bool:
        if self.inflater.eof:
            rest = self.inflater.unused_data
            self.at -= len(rest)
            self.inflater = zlib.decompressobj(31)
        if self.at >= len(self.data):
            return False
        piece = self.data[self.at : self.at + _CHUNK]
        self.at += len(piece)
        self.held += self.inflater.decompress(piece)
        return True

    def until(self, end: bytes) -> bytes:
        """Bytes up to and with ``end``; empty at the end of the stream."""
        looked = 0
        while (place := self.held.find(end, looked)) < 0:
            looked = max(0, len(self.held) - len(end))
            if not self._more():
                return b""
        return self.take(place + len(end))

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self._more():
                raise ValueError("a WARC record is cut off")
        out, self.held = self.held[:n], self.held[n:]
        return out


def parse_head(head: bytes) -> dict[str, str]:
    """Named fields of a WARC or HTTP head, names in lower case."""
    lines = head.decode().split("\r\n")[1:]
    pairs = (line.split(":", 1) for line in lines if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def split_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and complete bytes of every record of an archive, in order."""
    stream = _Stream(data)
    while head := stream.until(_END.encode()):
        fields = parse_head(head)
        rest = stream.take(int(fields["content-length"]) + len(_END))
        yield fields, head + rest


def _publish(store: fs.FileSystem, path: str, data: bytes) -> None:
    draft = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        out.write(data)
    store.move(draft, path)


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrites every archive of ``source`` into ``target`` with one member per record and a sidecar
    index; returns ``archive, records, bytes``. A task holds one archive."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(target)
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                name = re.sub(r"(\.txt)?\.gz$", "", path.as_py().rsplit("/", 1)[-1]) + ".warc.gz"
                members, index, offset = [], [], 0
                for fields, record in split_records(content.as_py()):
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = packer.compress(record) + packer.flush()
                    index.append(json.dumps({
                        "archive": name, "offset": offset, "length": len(member),
                        "record_id": fields["warc-record-id"], "type": fields["warc-type"]}))
                    members.append(member)
                    offset += len(member)
                _publish(store, f"{root}/{name}", b"".join(members))
                _publish(store, f"{root}/{name}.index.json", "".join(x + "\n" for x in index).encode())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([len(index)], pa.int64()),
                     pa.array([offset], pa.int64())], ["archive", "records", "bytes"])

    store, root = fs.FileSystem.from_uri(target)
    store.create_dir(root)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source)
    # Archives are dealt out by name: a task gets few, whatever their size on disk.
    return materialize(files.select("path", "content").mapInArrow(
        rewrite, "archive string, records bigint, bytes bigint"))


def _parsed(record: bytes) -> tuple[int | None, int, str, str, int | None]:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of one record."""
    head, _, block = record.partition(_END.encode())
    fields = parse_head(head)
    http, _, body = block[: int(fields["content-length"])].partition(_END.encode())
    said = fields["warc-payload-digest"].removeprefix("sha1:")

    def page(value: str) -> int | None:
        number = value.strip("<>").removeprefix(_URN)
        return None if number == "none" else int(number)

    if fields["warc-type"] == "response":
        found = base64.b32encode(hashlib.sha1(body).digest()).decode()
        if found != said:
            raise ValueError(f"{fields['warc-record-id']}: payload does not fit its digest")
        return page(fields["warc-record-id"]), len(body), found, "response", None
    return (page(fields["warc-record-id"]), int(parse_head(http)["content-length"]), said, "revisit",
            page(fields["warc-refers-to"]))


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_INDEX_TYPE).option("pathGlobFilter", "*.index.json").json(folder)


def read_records(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """Every indexed record of normalised archives, each fetched at its offset: ``page_id,
    payload_bytes, payload_digest, record_type, refers_to`` and, on request, ``payload`` (null for
    revisits). A response whose payload does not fit its digest is an error."""
    schema = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string,"
              " refers_to bigint" + (", payload string" if with_payload else ""))
    names = [part.split()[0] for part in schema.split(", ")]

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        open_name, handle = None, None
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if row["archive"] != open_name:
                    if handle is not None:
                        handle.close()
                    open_name, handle = row["archive"], store.open_input_file(f"{root}/{row['archive']}")
                handle.seek(row["offset"])
                record = zlib.decompress(handle.read(row["length"]), 31)
                parsed = _parsed(record)
                if with_payload:
                    body = record[: -len(_END)].split(_END.encode(), 2)[2].decode()
                    parsed += (body if parsed[3] == "response" else None,)
                rows.append(parsed)
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            kinds = {"payload_digest": pa.string(), "record_type": pa.string(), "payload": pa.string()}
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names, columns, strict=True)],
                names)
        if handle is not None:
            handle.close()

    return read_index(spark, folder).mapInArrow(fetch, schema)


def archive(pages: DataFrame, folder: str | None = None, **settings) -> str:
    """Writes and normalises archives of ``pages`` under ``folder`` (by default a new one in the
    shared folder) and returns where the normalised archives are."""
    spark = pages.sparkSession
    top = folder or f"{shared_dir(spark).rstrip('/')}/groundsill/warc-{uuid.uuid4().hex}"
    top = top if "://" in top or top.startswith("file:") else f"file://{top}"
    write_monolithic(records(pages, **settings), f"{top}/monolithic")
    normalise(spark, f"{top}/monolithic", f"{top}/normalised")
    return f"{top}/normalised"


SQL = """
WITH base AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages),
sized AS (
  SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS hexed,
    CASE WHEN strlen(payload) >= 0
      THEN min(page_id) OVER (PARTITION BY payload) ELSE page_id END AS kept
  FROM base),
bits AS (
  SELECT *, (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + CAST((CAST('0x' || substr(hexed, 1 + 10 * (i // 8), 10) AS BIGINT)
        >> (35 - 5 * (i % 8))) & 31 AS INTEGER), 1), '' ORDER BY i)
    FROM range(32) AS t(i)) AS payload_digest
  FROM sized)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = kept THEN NULL ELSE kept END AS refers_to
FROM bits"""
