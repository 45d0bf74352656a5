"""Web archive (WARC 1.0/1.1) files: listing, distributed parsing, filtered writing.

Listing uses Spark's ``binaryFile`` source with only ``path``/``length``
selected, so file contents are never loaded by the listing.  Parsing runs in
``mapInPandas`` tasks, one archive per task, streaming record by record from
the (gzip member-wise) file; a damaged record or archive yields an ``error``
row and the job continues.  Files are opened through ``pyarrow.fs`` so local
paths and cluster storage URIs work alike.
"""

from __future__ import annotations

import gzip
import io
import re
import zlib
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARCHIVE_GLOB = "*.{warc,warc.gz}"
MAX_BATCH_ROWS = 256
MAX_BATCH_BYTES = 64 << 20

RECORD_SCHEMA = (
    "archive string, offset bigint, warc_type string, record_id string, warc_date string, target_uri string, "
    "warc_headers map<string,string>, http_status string, http_reason string, http_version string, "
    "http_command string, http_path string, http_headers map<string,string>, media_type string, "
    "content_encoding string, body binary, error string, path string"
)


# ---------------------------------------------------------------- listing
def archive_files(spark: SparkSession, root: str, name_regex: str | None = None, recursive: bool = False) -> DataFrame:
    """``(path, name, length)`` of every ``*.warc`` / ``*.warc.gz`` under ``root``.

    Only the listing columns are selected, so the file contents are not read.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", ARCHIVE_GLOB)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.load(root).select("path", "length")
    df = df.withColumn("name", F.regexp_extract("path", r"([^/]*)$", 1))
    if name_regex:
        df = df.where(F.col("name").rlike(name_regex))
    return df.select("path", "name", "length")


# ---------------------------------------------------------------- parsing
def _open(path: str):
    import pyarrow.fs as pafs

    if "://" in path and not path.startswith("file:"):
        fs, p = pafs.FileSystem.from_uri(path)
    else:
        fs, p = pafs.LocalFileSystem(), path.replace("file://", "").replace("file:", "")
    return fs.open_input_stream(p, compression=None)


class _Damage(Exception):
    """A compressed member that cannot be inflated; reading goes on behind it."""


GZIP_MAGIC = b"\x1f\x8b\x08"


def _pieces(path: str) -> Iterator[bytes | _Damage]:
    """Decompressed bytes of a file, piece by piece; a damaged gzip member is
    reported and the next member is searched behind it."""
    with _open(path) as fh:
        if not path.endswith(".gz"):
            while data := fh.read(1 << 20):
                yield data
            return
        member, rest, begun = zlib.decompressobj(31), b"", False
        while data := fh.read(1 << 20):
            rest += data
            while rest:
                try:
                    out = member.decompress(rest)
                except zlib.error as e:
                    yield _Damage(f"gzip: {e}")
                    at = rest.find(GZIP_MAGIC, 1)
                    rest, member, begun = (rest[at:] if at > 0 else rest[-2:]), zlib.decompressobj(31), False
                    if at <= 0:
                        break
                    continue
                begun = True
                if out:
                    yield out
                rest = member.unused_data.lstrip(b"\0") if member.eof else b""
                if member.eof:
                    member, begun = zlib.decompressobj(31), False
        if begun:
            yield _Damage("gzip: truncated member")


class _Stream:
    """Lines and blocks of a file with the offset of the next byte."""

    def __init__(self, pieces: Iterator[bytes | _Damage]):
        self.pieces, self.held, self.offset = pieces, bytearray(), 0

    def _more(self) -> bool:
        piece = next(self.pieces, None)
        if isinstance(piece, _Damage):
            raise piece
        self.held += piece or b""
        return piece is not None

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self._more():
            pass
        out = bytes(self.held[:n])
        del self.held[:n]
        self.offset += len(out)
        return out

    def line(self) -> bytes:
        """The next line with its end, however long; empty at the end of the file."""
        looked = 0
        while (at := self.held.find(b"\n", looked)) < 0:
            looked = len(self.held)
            if not self._more():
                return self.take(len(self.held))
        return self.take(at + 1)


def _parse_headers(lines: list[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    last = None
    for raw in lines:
        line = raw.decode("utf-8", "replace").rstrip("\r\n")
        if line[:1] in (" ", "\t") and last is not None:
            out[last] += " " + line.strip()
            continue
        if ":" not in line:
            raise ValueError(f"bad header line: {line[:80]!r}")
        k, v = line.split(":", 1)
        last = k.strip().lower()
        if last not in out:  # first value of a repeated header wins
            out[last] = v.strip()
    return out


def _dechunk(data: bytes) -> bytes:
    out = bytearray()
    buf = io.BytesIO(data)
    while True:
        size_line = buf.readline()
        if not size_line:
            break
        size = int(size_line.split(b";")[0].strip() or b"0", 16)
        if size == 0:
            break
        out += buf.read(size)
        buf.readline()
    return bytes(out)


def _decode_encoding(body: bytes, encoding: str | None) -> bytes:
    enc = (encoding or "").strip().lower()
    if enc in ("", "identity"):
        return body
    if enc in ("gzip", "x-gzip"):
        return gzip.decompress(body)
    if enc == "deflate":
        try:
            return zlib.decompress(body)
        except zlib.error:
            return zlib.decompress(body, -zlib.MAX_WBITS)
    raise ValueError(f"content encoding {enc[:40]!r} is not supported")


# start lines as HTTP defines them: a status line may lack its reason, a request line names a method
STATUS_LINE = re.compile(r"(?P<version>HTTP/[0-9.]+) +(?P<code>[0-9]{3})(?: +(?P<reason>.*))?")
REQUEST_LINE = re.compile(r"(?P<method>[!#$%&'*+.^_`|~0-9A-Za-z-]+) +(?P<target>.*\S) +(?P<version>HTTP/[0-9.]+)")


def _start_line(line: str) -> dict:
    if m := STATUS_LINE.fullmatch(line):
        return {"http_version": m["version"], "http_status": m["code"], "http_reason": m["reason"] or ""}
    if m := REQUEST_LINE.fullmatch(line):
        return {"http_version": m["version"], "http_command": m["method"], "http_path": m["target"]}
    return {}


def _parse_http(block: bytes) -> dict:
    """Start line, headers and decoded body of an HTTP message; an undecodable body stays raw with an error."""
    buf = io.BytesIO(block)
    rec = _start_line(buf.readline().decode("iso-8859-1").strip())
    lines = []
    while (line := buf.readline()) not in (b"\r\n", b"\n", b""):
        lines.append(line)
    headers = _parse_headers(lines)
    body = buf.read()
    ctype = headers.get("content-type", "")
    rec.update(http_headers=headers, media_type=ctype.lower().split(";")[0].strip() if ctype else None,
               content_encoding=headers.get("content-encoding"))
    try:
        if headers.get("transfer-encoding", "").lower() == "chunked":
            body = _dechunk(body)
        elif headers.get("content-length", "").isdigit():
            body = body[: int(headers["content-length"])]
        rec["body"] = _decode_encoding(body, headers.get("content-encoding"))
    except Exception as e:  # noqa: BLE001 - any damage of the body
        rec.update(body=body, error=f"http: {e}"[:500])
    return rec


def _one_record(stream: _Stream, first: bytes) -> tuple[dict, dict, bytes]:
    """(headers, fields, block) of the record that ``first``, its version line, begins."""
    if not VERSION_LINE.match(first):
        raise ValueError(f"bad version line: {first[:40]!r}")
    lines = []
    while (line := stream.line()) not in (b"\r\n", b"\n"):
        if not line:
            raise ValueError("truncated headers")
        if VERSION_LINE.match(line):
            raise _Restart(line)
        lines.append(line)
    headers = _parse_headers(lines)
    if not headers.get("content-length", "").isdigit():
        raise ValueError("missing Content-Length")
    n = int(headers["content-length"])
    block = stream.take(n)
    if len(block) < n:
        raise ValueError("truncated record block")
    return headers, {
        "warc_type": headers.get("warc-type"), "record_id": headers.get("warc-record-id"), "warc_date": headers.get("warc-date"),
        "target_uri": headers.get("warc-target-uri"), "warc_headers": headers, "error": None,
    }, block


class _Restart(ValueError):
    """A record that ends at the version line of the next one."""

    def __init__(self, line: bytes):
        super().__init__("record ends inside its headers")
        self.line = line


VERSION_LINE = re.compile(rb"WARC/1\.[0-9]+\s*$")


def iter_records(path: str, name: str) -> Iterator[dict]:
    """Records of one archive.  What cannot be read gives one error row with the bytes
    passed over, and reading goes on at the next version line."""
    base = {"archive": name, "path": path}
    try:
        stream = _Stream(_pieces(path))
        line = stream.line()
    except _Damage as e:
        yield base | {"offset": 0, "error": str(e)}
        line = b"\n"
    except Exception as e:  # noqa: BLE001 - a file that cannot be opened
        yield base | {"offset": 0, "error": f"open: {e}"[:500]}
        return
    while line:
        if line in (b"\r\n", b"\n"):
            line, bad = _next_line(stream)
            if bad:
                yield base | {"offset": stream.offset, "error": bad}
            continue
        start = stream.offset - len(line)
        try:
            headers, rec, block = _one_record(stream, line)
            if "application/http" in headers.get("content-type", "").lower():
                try:
                    rec.update(_parse_http(block))
                except ValueError as e:  # bad HTTP headers: keep the record, flag it
                    rec.update(body=block, error=f"http: {e}")
            else:
                rec["body"] = block
            yield base | {"offset": start} | rec
            line = b"\n"
        except (ValueError, _Damage) as e:
            passed = [line]
            line = e.line if isinstance(e, _Restart) else b"\n"
            while line and not VERSION_LINE.match(line):
                line, _ = _next_line(stream)
                if not VERSION_LINE.match(line):
                    passed.append(line)
            yield base | {"offset": start, "body": b"".join(passed), "error": str(e)[:500]}


def _next_line(stream: _Stream) -> tuple[bytes, str | None]:
    """The next line, and the damage in front of it if any; bytes held from before a damage are dropped."""
    try:
        return stream.line(), None
    except _Damage as e:
        stream.held.clear()
        return b"\n", str(e)


_COLS = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]


def _parse_partition(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in it:
        for path, name in zip(pdf["path"], pdf["name"]):
            rows, size = [], 0
            for rec in iter_records(path, name):
                rows.append({c: rec.get(c) for c in _COLS})
                size += len(rec.get("body") or b"")
                if len(rows) >= MAX_BATCH_ROWS or size >= MAX_BATCH_BYTES:
                    yield pd.DataFrame(rows, columns=_COLS)
                    rows, size = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=_COLS)


def read_records(spark: SparkSession, root: str, name_regex: str | None = None, recursive: bool = False) -> DataFrame:
    """Every record of every archive under ``root`` (schema ``RECORD_SCHEMA``).

    One archive per task: the file list is spread by path hash over as many
    partitions as there are archives, so parsing parallelizes across archives.
    """
    files = archive_files(spark, root, name_regex, recursive)
    n = max(1, files.count())
    # range partitioning on the path gives each archive its own task (hash
    # partitioning would pile colliding archives into one task)
    spread = files.repartitionByRange(n, "path")
    return spread.mapInPandas(_parse_partition, RECORD_SCHEMA)


# ---------------------------------------------------------------- writing (filtered dump)
def _warc_bytes(row: dict) -> bytes:
    """One record; an HTTP message gets its start line and headers back, and its body the encoding its headers name."""
    block = row["body"] or b""
    if row["http_headers"] is not None and row["warc_type"] in ("response", "request"):
        headers = {k: v for k, v in row["http_headers"].items() if v is not None and k != "transfer-encoding"}
        block = gzip.compress(block, mtime=0) if headers.get("content-encoding") == "gzip" else block
        headers["content-length"] = str(len(block))
        if row["http_status"]:
            start = f"{row['http_version'] or 'HTTP/1.1'} {row['http_status']} {row['http_reason'] or ''}".strip()
        else:
            start = f"{row['http_command'] or 'GET'} {row['http_path'] or '/'} {row['http_version'] or 'HTTP/1.1'}"
        block = "\r\n".join([start, *(f"{k}: {v}" for k, v in headers.items()), "", ""]).encode() + block
    head = {k: v for k, v in (row["warc_headers"] or {}).items() if v is not None} | {"content-length": str(len(block))}
    return "\r\n".join(["WARC/1.0", *(f"{k}: {v}" for k, v in head.items()), "", ""]).encode() + block + b"\r\n\r\n"


def _output_stream(path: str):
    import pyarrow.fs as pafs

    if "://" in path and not path.startswith("file:"):
        fs, p = pafs.FileSystem.from_uri(path)
    else:
        fs, p = pafs.LocalFileSystem(), path.replace("file://", "").replace("file:", "")
    fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
    return fs.open_output_stream(p, compression=None)


def write_archives(records: DataFrame, out_dir: str, archives: int) -> DataFrame:
    """Write records as gzip-member WARC files under their archives' names; returns
    ``(path, records)`` per file.

    Records are range-partitioned by archive, so a file is written by one task, and a
    retried task writes its own files anew."""
    out_dir = out_dir.rstrip("/")

    def write(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fh, name, count = None, None, 0
        for pdf in it:
            for row in pdf.to_dict("records"):
                if row["archive"] != name:
                    if fh is not None:
                        fh.close()
                        yield pd.DataFrame({"path": [f"{out_dir}/{name}"], "records": [count]})
                    name, count = row["archive"], 0
                    fh = _output_stream(f"{out_dir}/{name}")
                fh.write(gzip.compress(_warc_bytes(row)))
                count += 1
        if fh is not None:
            fh.close()
            yield pd.DataFrame({"path": [f"{out_dir}/{name}"], "records": [count]})

    cols = ["archive", "offset", "warc_type", "warc_headers", "http_status", "http_reason", "http_version", "http_command", "http_path", "http_headers", "body"]
    spread = records.select(*cols).repartitionByRange(archives, "archive").sortWithinPartitions("archive", "offset")
    return spread.mapInPandas(write, "path string, records bigint")


# ---------------------------------------------------------------- data source API
def _list_archives(root: str) -> list[str]:
    import fnmatch

    import pyarrow.fs as pafs

    if "://" in root and not root.startswith("file:"):
        fs, base = pafs.FileSystem.from_uri(root)
        prefix = root[: len(root) - len(base)] if root.endswith(base) else ""
    else:
        fs, base, prefix = pafs.LocalFileSystem(), root.replace("file://", "").replace("file:", ""), ""
    info = fs.get_file_info(base)
    if info.type == pafs.FileType.File:
        return [prefix + base]
    sel = pafs.FileSelector(base, recursive=False)
    names = [f for f in fs.get_file_info(sel) if f.type == pafs.FileType.File and f.size > 0]
    return sorted(prefix + f.path for f in names
                  if fnmatch.fnmatch(f.base_name, "*.warc") or fnmatch.fnmatch(f.base_name, "*.warc.gz"))


def register_warc_source(spark: SparkSession) -> None:
    """Register ``spark.read.format("warc").load(path)``: one input partition per
    archive file, records streamed by the same parser as :func:`read_records`."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class _ArchivePartition(InputPartition):
        def __init__(self, path: str):
            super().__init__(path)
            self.path = path

    class _Reader(DataSourceReader):
        def __init__(self, options):
            self.root = options.get("path")

        def partitions(self):
            return [_ArchivePartition(p) for p in _list_archives(self.root)]

        def read(self, partition):
            name = partition.path.rsplit("/", 1)[-1]
            for rec in iter_records(partition.path, name):
                yield tuple(rec.get(c) for c in _COLS)

    class WarcDataSource(DataSource):
        @classmethod
        def name(cls):
            return "warc"

        def schema(self):
            return RECORD_SCHEMA

        def reader(self, schema):
            return _Reader(self.options)

    spark.dataSource.register(WarcDataSource)
