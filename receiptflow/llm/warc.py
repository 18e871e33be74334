"""WARC archives: one gzip stream for a whole file, rewritten as one gzip member per record with an offset index.

Files are opened in tasks through ``pyarrow.fs`` by URI, so the shared folder may be a mounted path or any store
pyarrow knows; Hadoop's names of stores are taken for pyarrow's (``located``). Names carry a random part: what a lost task wrote is never listed, and what is listed is whole.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from receiptflow.llm.shared import drop_folder, drop_written, fresh_path, written
from receiptflow.session import ship_package

_CHUNK = 1 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILES = "archive string, records long"
INDEX = "archive string, index string, records long"
RECORDS = (
    "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, "
    "archive string, offset long, length long"
)


def located(path: str) -> str:
    """A path as Hadoop spells it, as a URI for pyarrow: ``s3a`` and ``s3n`` are ``s3``, ``dbfs`` is its mounted folder."""
    scheme, colon, rest = path.partition(":")
    if scheme in ("s3a", "s3n"):
        return "s3:" + rest
    if scheme == "dbfs":
        return "file:///dbfs/" + rest.lstrip("/")
    if colon and scheme == "file" and not rest.startswith("//"):
        return "file://" + rest
    return path


def _open(path: str, mode: str):
    system, inner = pafs.FileSystem.from_uri(located(path))
    if mode == "r":
        return system.open_input_file(inner)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(inner, compression=None)


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    def payload(self) -> bytes:
        return self.block.partition(b"\r\n\r\n")[2]

    def http_headers(self) -> dict[str, str]:
        lines = self.block.partition(b"\r\n\r\n")[0].decode().split("\r\n")[1:]
        return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}

    def encoded(self) -> bytes:
        head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in self.headers.items())
        return head.encode() + b"\r\n" + self.block + b"\r\n\r\n"


def _header_text(value: str) -> str:
    """Control characters percent-encoded, so that a value stays on its line."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def page_record(page_id, url: str | None, html: str | None, digest: str, refers_to, date: str) -> Record:
    """The response or, if ``refers_to`` is given, revisit record of a page. A revisit has HTTP headers only."""
    payload = (html or "").encode()
    name = lambda p: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{p}')}>"
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    headers = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": name(page_id), "WARC-Date": date}
    if url is not None:
        headers["WARC-Target-URI"] = _header_text(url)
    if page_id is not None:
        headers["WARC-Page-ID"] = str(page_id)
    headers["WARC-Payload-Digest"] = f"sha256:{digest}"
    if revisit:
        headers |= {"WARC-Profile": _PROFILE, "WARC-Refers-To": name(refers_to), "WARC-Refers-To-Page-ID": str(refers_to)}
    else:
        block += payload
    headers |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}
    return Record(headers, block)


def inflated(file: BinaryIO) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members, in pieces."""
    engine = zlib.decompressobj(31)
    fresh = True
    while data := file.read(_CHUNK):
        while data:
            if engine.eof:
                engine, fresh = zlib.decompressobj(31), True
            out = engine.decompress(data, _CHUNK)
            fresh = False
            data = engine.unused_data if engine.eof else engine.unconsumed_tail
            if out:
                yield out
    while not engine.eof and not fresh and (out := engine.decompress(engine.unconsumed_tail, _CHUNK)):
        yield out
    if not engine.eof and not fresh:
        raise ValueError("the gzip stream is cut off")


def parsed(pieces: Iterator[bytes]) -> Iterator[Record]:
    """The records of a WARC byte stream; memory holds one record at a time."""
    buffer = bytearray()

    def fill(n: int) -> bool:
        while len(buffer) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            buffer.extend(piece)
        return True

    while True:
        end, at = -1, 0
        while end < 0:
            end = buffer.find(b"\r\n\r\n", max(0, at - 3))
            at = len(buffer)
            if end < 0 and not fill(at + 1):
                if buffer.strip():
                    raise ValueError("the archive ends inside a record's header")
                return
        lines = bytes(buffer[:end]).decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record starts with {lines[0][:20]!r}")
        headers = {k: v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(headers["Content-Length"])
        if not fill(end + 4 + size + 4):
            raise ValueError("the archive ends inside a record")
        block = bytes(buffer[end + 4 : end + 4 + size])
        del buffer[: end + 8 + size]
        yield Record(headers, block)


def classify(pages: DataFrame, least: int, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``pages`` with ``__digest``, ``__bytes`` and ``__refers``: the first page of an equal payload, for revisits.

    The smallest ids are found by a grouped minimum over digests alone, then joined back; a payload that a third of
    the pages share is one row on the small side, and Spark may split its pages. Pages below ``least``, which match
    nothing, are dealt out by themselves: empty ones do not meet in one task.
    """
    raw = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    pages = pages.withColumns({"__digest": F.sha2(raw, 256), "__bytes": F.octet_length(raw).cast("long")})
    large = F.col("__bytes") >= least
    alone = F.concat(F.lit("-"), F.xxhash64(F.col(id_col), F.col(url_col)).cast("string"))
    pages = pages.withColumn("__key", F.when(large, F.col("__digest")).otherwise(alone))
    first = pages.filter(large).groupBy("__digest").agg(F.min(id_col).alias("__first"), F.count(F.lit(1)).alias("__n"))
    first = first.filter("__n > 1 AND __first IS NOT NULL").select(F.col("__digest").alias("__same"), "__first")
    out = pages.join(first, F.col("__key") == F.col("__same"), "left")
    refers = F.when(~F.col(id_col).eqNullSafe(F.col("__first")), F.col("__first"))
    return out.withColumn("__refers", refers).drop("__same", "__first", "__key")


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least: int = 100,
    file_bytes: int = 32 << 20,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Writes a WARC record for each page, each file as one gzip stream; returns the files (``FILES``).

    Of pages with equal payloads of ``least`` bytes or more, the one with the smallest id is a response and the others
    revisit it; other pages are responses. Pages of a null id are responses unless a page with an id has their payload;
    repeated rows of the smallest id are all responses. Null html is an empty payload. A file is closed once its
    records reach ``file_bytes``. Other columns of ``pages`` are not written.
    """
    ship_package(pages.sparkSession)
    chosen = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )
    rows = classify(chosen, least, "id", "url", "html").select(
        F.col("id").cast("string"), "url", "html", "__digest", F.col("__refers").cast("string")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = path = engine = None
        size = count = 0
        for batch in batches:
            for row in zip(*(c for c in batch.columns), strict=True):
                if sink is None:
                    path = f"{folder}/whole-{uuid.uuid4().hex}.warc.gz"
                    sink, engine, size, count = _open(path, "w"), zlib.compressobj(1, zlib.DEFLATED, 31), 0, 0
                data = page_record(row[0].as_py(), row[1].as_py(), row[2].as_py(), row[3].as_py(), row[4].as_py(), date).encoded()
                sink.write(engine.compress(data))
                size, count = size + len(data), count + 1
                if size >= file_bytes:
                    sink.write(engine.flush())
                    sink.close()
                    sink = None
                    yield pa.RecordBatch.from_pydict({"archive": [path], "records": [count]})
        if sink is not None:
            sink.write(engine.flush())
            sink.close()
            yield pa.RecordBatch.from_pydict({"archive": [path], "records": [count]})

    return written(rows.mapInArrow(write, FILES), "warc-files")


def _each_alone(files: DataFrame) -> DataFrame:
    """A partition for about each file of a list, so that archives are read in parallel."""
    return files.repartition(max(1, min(files.count(), 10_000)))


def normalise(files: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Inflates each whole-file stream once and writes every record as its own gzip member, with a sidecar index.

    The index is a text file beside the archive, one JSON object per line: offset and length of the member, record id
    and type. Returns the new archives and their indexes (``INDEX``). A cut-off or malformed archive raises ValueError.
    """
    ship_package(files.sparkSession)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for old in batch.column("archive").to_pylist():
                path = f"{folder}/members-{uuid.uuid4().hex}.warc.gz"
                offset = count = 0
                with _open(old, "r") as source, _open(path, "w") as sink, _open(path + ".idx", "w") as index:
                    for record in parsed(inflated(source)):
                        engine = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = engine.compress(record.encoded()) + engine.flush()
                        entry = {
                            "offset": offset,
                            "length": len(member),
                            "id": record.headers["WARC-Record-ID"],
                            "type": record.headers["WARC-Type"],
                        }
                        sink.write(member)
                        index.write(json.dumps(entry).encode() + b"\n")
                        offset, count = offset + len(member), count + 1
                yield pa.RecordBatch.from_pydict({"archive": [path], "index": [path + ".idx"], "records": [count]})

    return written(_each_alone(files).mapInArrow(rewrite, INDEX), "warc-index")


def read_archives(indexed: DataFrame) -> DataFrame:
    """A row (``RECORDS``) for each record of normalised archives, each member found by its offset and inflated alone.

    Digest and length of a response are taken from its payload, and a digest that differs from the header's raises
    ValueError; those of a revisit, which has no payload, come from its headers.
    """
    ship_package(indexed.sparkSession)
    names = [x.split()[0] for x in RECORDS.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, index in zip(batch.column("archive").to_pylist(), batch.column("index").to_pylist(), strict=True):
                rows: dict[str, list] = {n: [] for n in names}
                with _open(path, "r") as file, _open(index, "r") as sidecar:
                    for entry in map(json.loads, sidecar.read().splitlines()):
                        file.seek(entry["offset"])
                        (record,) = parsed(iter([zlib.decompress(file.read(entry["length"]), 31)]))
                        h, response = record.headers, record.headers["WARC-Type"] == "response"
                        digest = h["WARC-Payload-Digest"].partition(":")[2]
                        payload = record.payload()
                        if response and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{h['WARC-Record-ID']} of {path} is damaged")
                        size = len(payload) if response else int(record.http_headers()["content-length"])
                        found = (
                            h.get("WARC-Page-ID"), h.get("WARC-Target-URI"), size, digest, h["WARC-Type"],
                            h.get("WARC-Refers-To-Page-ID"), path, entry["offset"], entry["length"],
                        )
                        for n, x in zip(names, found, strict=True):
                            rows[n].append(x)
                        if len(rows["length"]) >= 10_000:
                            yield _records(rows)
                            rows = {n: [] for n in names}
                yield _records(rows)

    return _each_alone(indexed).mapInArrow(read, RECORDS)


def _records(rows: dict[str, list]) -> pa.RecordBatch:
    longs = ("payload_bytes", "offset", "length")
    return pa.RecordBatch.from_arrays([pa.array(v, pa.int64() if k in longs else pa.string()) for k, v in rows.items()], names=[*rows])


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes ``pages`` as archives below the shared folder, normalises them and reads them back (``RECORDS``).

    ``page_id`` and ``refers_to`` have the type of ``id_col``. Ties: of equal payloads the smallest id is the response, and
    all rows that repeat it. A very long page is one record, in the memory of one task. Other columns, of whatever names,
    are left out. An empty table gives no archive and no row. The normalised archives stay: they are what is made. The whole-file streams
    go once their members are written.
    """
    folder = fresh_path(pages.sparkSession, "warc")
    files = write_archives(pages, f"{folder}/whole", id_col, url_col, html_col)
    back = read_archives(normalise(files, folder))
    # the members and their index are written by now, in tables that no later loss of an executor makes anew
    drop_folder(pages.sparkSession, f"{folder}/whole")
    drop_written(files)
    kind = pages.schema[id_col].dataType
    return back.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})
