"""WARC records in ZIP packages, written and read by Spark tasks.

A package is a ZIP file whose members are stored, not compressed: archive/data.warc.gz (a gzip member for each record) and
indexes/index.cdxj (a line a record, with its place). The reader opens no whole package: it reads the end of the file, the
central directory behind it (ZIP64's where numbers are too large for the old one), a range of the index, and then the
ranges of the records it names; records that lie side by side come with one read. Large packages are divided by ranges of
their index, so several tasks read one. A package without an index is scanned record by record.

    spark.dataSource.register(WarcZip)
    rows.write.format("warczip").mode("append").save(folder)
    spark.read.format("warczip").load(folder)

Tasks write packages under names of their own; a commit names them in a manifest, and only what a manifest names is read,
so attempts that failed or ran twice leave no records. A folder without manifests is read whole (*.zip, *.wacz).

Cases: null payloads are empty; a null url has no header; a null page_id is written as `-` and is the last to become a
response; of rows alike one is the response; an empty table gives a manifest without packages; names of further columns don't matter, as only those of COLUMNS are written.
Very long payloads are held one at a time.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from lectern.saving import shared_folder
from lectern.sources import files

from .common import salt_of, saved, small_batches, table

#: Payloads of fewer bytes are never revisits.
LEAST = 100
#: Bytes and records of a package; bytes that a task reads at once.
PACKAGE, RECORDS, READ = 128 << 20, 100_000, 8 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
COLUMNS = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


# records


def record(row: dict) -> bytes:
    """A response with its payload, or a revisit with the HTTP header alone."""
    payload, urn = row["payload"] or b"", lambda i: f"<urn:page:{'-' if i is None else i}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n".encode()
    again = row["record_type"] == "revisit"
    block = http if again else http + payload
    head = {"WARC-Type": row["record_type"], "WARC-Record-ID": urn(row["page_id"]), "WARC-Date": DATE, "WARC-Target-URI": None if row["url"] is None else quote(row["url"], safe=":/?#[]@!$&'()*+,;=~")}
    head |= {"WARC-Payload-Digest": f"sha256:{row['payload_digest']}", "WARC-Profile": PROFILE if again else None, "WARC-Refers-To": urn(row["refers_to"]) if again else None}
    head |= {"Content-Type": "application/http;msgtype=response", "Content-Length": len(block)}
    return "WARC/1.1\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None).encode() + b"\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])}


def parsed(data: bytes) -> dict | None:
    """A row of COLUMNS of one record, None for records of other types. Length and digest are of the payload itself where it is there."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    if fields.get("warc-type") not in ("response", "revisit"):
        return None
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda name: int(x) if (x := fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")).lstrip("-").isdigit() else None
    again, url = fields["warc-type"] == "revisit", fields.get("warc-target-uri")
    return {
        "page_id": number("warc-record-id"), "url": None if url is None else unquote(url), "payload": None if again else payload,
        "payload_bytes": int(_fields(http)["content-length"]) if again else len(payload),
        "payload_digest": fields["warc-payload-digest"].removeprefix("sha256:") if again else hashlib.sha256(payload).hexdigest(),
        "record_type": fields["warc-type"], "refers_to": number("warc-refers-to") if again else None,
    }


# packages


@dataclass
class Member:
    name: str
    method: int
    size: int
    header: int


def directory(file) -> dict[str, Member]:
    """The members of a ZIP file, from its central directory. file: size() and read_at(bytes, offset)."""
    size = file.size()
    tail_at = max(size - 65_557, 0)
    tail = file.read_at(size - tail_at, tail_at)
    end = tail.rfind(b"PK\x05\x06")
    while end >= 0 and end + 22 + int.from_bytes(tail[end + 20 : end + 22], "little") != len(tail):
        end = tail.rfind(b"PK\x05\x06", 0, end)
    if end < 0:
        raise ValueError("no ZIP file: it has no end of a central directory")
    n, length, start = struct.unpack("<HII", tail[end + 10 : end + 20])
    if 0xFFFF == n or 0xFFFFFFFF in (length, start):
        locator = file.read_at(20, tail_at + end - 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("the ZIP64 directory is missing")
        where = struct.unpack("<Q", locator[8:16])[0]
        n, length, start = struct.unpack("<QQQ", file.read_at(56, where)[32:56])
    data, at, out = file.read_at(length, start), 0, {}
    for _ in range(n):
        if data[at : at + 4] != b"PK\x01\x02":
            raise ValueError("the central directory is broken")
        flags, method = struct.unpack("<HH", data[at + 8 : at + 12])
        packed, whole, names, extras, comment = struct.unpack("<IIHHH", data[at + 20 : at + 34])
        header = int.from_bytes(data[at + 42 : at + 46], "little")
        name = data[at + 46 : at + 46 + names].decode("utf-8" if flags & 0x800 else "cp437")
        extra, wide = data[at + 46 + names : at + 46 + names + extras], []
        while len(extra) >= 4:
            kind, most = struct.unpack("<HH", extra[:4])
            if kind == 1:
                wide = list(struct.unpack(f"<{most // 8}Q", extra[4 : 4 + most // 8 * 8]))
            extra = extra[4 + most :]
        whole, packed, header = (wide.pop(0) if x == 0xFFFFFFFF and wide else x for x in (whole, packed, header))
        out[name] = Member(name, method, whole, header)
        at += 46 + names + extras + comment
    return out


def start_of(file, member: Member) -> int:
    """Where a stored member's bytes begin; its local header tells."""
    if member.method:
        raise ValueError(f"{member.name} is compressed in the ZIP file, so records can't be read by range")
    names, extras = struct.unpack("<HH", file.read_at(30, member.header)[26:30])
    return member.header + 30 + names + extras


def index_lines(file, start: int, size: int, low: int, high: int) -> Iterator[bytes]:
    """Lines of an index (size bytes at start) whose first byte is from low to before high."""
    place, data, off, skip = max(low - 1, 0), b"", 0, low > 0  # the byte before low tells whether a line begins there
    read = place
    while True:
        cut = data.find(b"\n", off)
        if cut < 0 and read < size:
            piece = file.read_at(min(READ, size - read, max(high - read, 1 << 16)), start + read)
            data, place, off, read = data[off:] + piece, place + off, 0, read + len(piece)
            continue
        if off >= len(data) or (not skip and place + off >= high):
            return
        cut = len(data) if cut < 0 else cut
        if not skip and cut > off:
            yield data[off:cut]
        skip, off = False, cut + 1


def ranges(entries: Iterator[tuple[str, int, int]], most: int = READ) -> Iterator[tuple[str, int, list[int]]]:
    """Entries (name, offset, length) that lie side by side, together: name, offset, lengths."""
    name, first, lengths = None, 0, []
    for n, offset, length in entries:
        if lengths and (n != name or offset != first + sum(lengths) or sum(lengths) + length > most):
            yield name, first, lengths
            lengths = []
        if not lengths:
            name, first = n, offset
        lengths.append(length)
    if lengths:
        yield name, first, lengths


def indexed(file, members: dict[str, Member], part: int, parts: int) -> Iterator[bytes]:
    """Records that a part of the indexes names."""
    starts = {}
    for index in (m for name, m in sorted(members.items()) if name.startswith("indexes/") and name.endswith((".cdx", ".cdxj"))):
        lines = index_lines(file, start_of(file, index), index.size, index.size * part // parts, index.size * (part + 1) // parts)
        facts = (json.loads(line[line.index(b"{") :]) for line in lines)
        for name, first, lengths in ranges((f["filename"], int(f["offset"]), int(f["length"])) for f in facts):
            start = starts.get(name) or starts.setdefault(name, start_of(file, members[f"archive/{name}"]))
            data = file.read_at(sum(lengths), start + first)
            at = 0
            for length in lengths:
                piece = data[at : at + length]
                yield gzip.decompress(piece) if piece[:2] == b"\x1f\x8b" else piece
                at += length


def scanned(file, member: Member) -> Iterator[bytes]:
    """All records of an archive member, one after the other."""
    start, at, data, zipped = start_of(file, member), 0, b"", None

    def more() -> bytes:
        nonlocal at
        piece = file.read_at(min(READ, member.size - at), start + at)
        at += len(piece)
        return piece

    while at < member.size or data:
        if len(data) < 2 and at < member.size:
            data += more()
        zipped = data[:2] == b"\x1f\x8b" if zipped is None else zipped
        if zipped:
            d, out = zlib.decompressobj(31), []
            while not d.eof:
                if not data and at == member.size:
                    raise ValueError(f"{member.name} ends inside a record")
                out.append(d.decompress(data or more()))
                data = d.unused_data
            yield b"".join(out)
            continue
        while (head := data.find(b"\r\n\r\n")) < 0 and at < member.size:
            data += more()
        if head < 0:
            return
        end = head + 8 + int(_fields(data[:head])["content-length"])
        while len(data) < end and at < member.size:
            data += more()
        yield data[:end]
        data = data[end:]


def records(file, part: int = 0, parts: int = 1) -> Iterator[bytes]:
    members = directory(file)
    if any(name.startswith("indexes/") for name in members):
        yield from indexed(file, members, part, parts)
    elif part == 0:
        for name in sorted(members):
            if name.startswith("archive/") and name.endswith((".warc", ".warc.gz")):
                yield from scanned(file, members[name])


# Spark's side


@dataclass
class Written(WriterCommitMessage):
    packages: list


class _Package:
    """A ZIP file that grows by records; its index is written last."""

    def __init__(self, folder: str) -> None:
        self.store, path = files.at(folder)
        self.name = f"part-{uuid.uuid4().hex}.wacz"
        self.path = f"{path}/{self.name}"
        self.stream = self.store.open_output_stream(self.path)
        self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.archive = self.zip.open(zipfile.ZipInfo("archive/data.warc.gz"), "w", force_zip64=True)
        self.size, self.index = 0, []

    def add(self, row: dict) -> None:
        data = gzip.compress(record(row), 6, mtime=0)
        self.archive.write(data)
        facts = {"offset": self.size, "length": len(data), "filename": "data.warc.gz", "digest": f"sha256:{row['payload_digest']}"}
        self.index.append(f"urn:page:{row['page_id']} {DATE[:4]}0101000000 {json.dumps(facts)}\n")
        self.size += len(data)

    def close(self) -> dict:
        self.archive.close()
        self.zip.writestr(zipfile.ZipInfo("indexes/index.cdxj"), "".join(self.index))
        self.zip.close()
        self.stream.close()
        return {"name": self.name, "bytes": self.store.get_file_info(self.path).size, "records": len(self.index)}

    def drop(self) -> None:
        self.close()
        self.store.delete_file(self.path)


class _Writer(DataSourceArrowWriter):
    def __init__(self, folder: str, overwrite: bool) -> None:
        self.folder, self.overwrite = folder.rstrip("/"), overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        package, done = None, []
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    package = package or _Package(self.folder)
                    package.add(row)
                    if package.size >= PACKAGE or len(package.index) >= RECORDS:
                        done.append(package.close())
                        package = None
            if package:
                done.append(package.close())
        except BaseException:
            if package:
                package.drop()
            self.abort([Written(done)])
            raise
        return Written(done)

    def commit(self, messages: list) -> None:
        store, path = files.at(self.folder)
        store.create_dir(path, recursive=True)
        older = [f.path for f in files.listed(self.folder, ".manifest.json")] if self.overwrite else []
        with store.open_output_stream(f"{path}/{uuid.uuid4().hex}.manifest.json") as out:
            out.write(json.dumps({"packages": [p for m in messages if m for p in m.packages]}).encode())
        for f in older:
            store.delete_file(f)

    def abort(self, messages: list) -> None:
        store, path = files.at(self.folder)
        for m in messages:
            for p in m.packages if m else ():
                store.delete_file(f"{path}/{p['name']}")


@dataclass
class _Part(InputPartition):
    path: str
    part: int
    parts: int


class _Reader(DataSourceReader):
    def __init__(self, folder: str, payload: bool) -> None:
        self.folder, self.payload = folder.rstrip("/"), payload

    def partitions(self) -> list[_Part]:
        store, path = files.at(self.folder)
        manifests = files.listed(self.folder, ".manifest.json")
        if manifests:
            found = [(f"{path}/{p['name']}", p["bytes"]) for m in manifests for p in json.loads(store.open_input_file(m.path).read())["packages"]]
        else:
            found = [(f.path, f.size) for f in files.listed(self.folder, ".zip", ".wacz")]
        parts = [_Part(name, k, n) for name, size in found for n in [-(-size // (2 * PACKAGE)) or 1] for k in range(n)]
        return parts or [_Part("", 0, 0)]  # one without rows, as none at all is no plan

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        store, _ = files.at(self.folder)
        rows, load = [], 0
        if not partition.path:
            yield pa.RecordBatch.from_pylist([], _ARROW)
            return
        with store.open_input_file(partition.path) as file:
            for data in records(file, partition.part, partition.parts):
                if (row := parsed(data)) is None:
                    continue
                if not self.payload:
                    row["payload"] = None
                rows.append(row)
                load += len(row["payload"] or b"")
                if len(rows) >= 1000 or load >= READ:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)
                    rows, load = [], 0
        yield pa.RecordBatch.from_pylist(rows, _ARROW)


class WarcZip(DataSource):
    """Option payload: false leaves payloads out of the rows (their lengths and digests are still of what was read)."""

    @classmethod
    def name(cls) -> str:
        return "warczip"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"], self.options.get("payload", "true").lower() != "false")

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], overwrite)


def as_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST) -> DataFrame:
    """Rows of COLUMNS. Of payloads that are equal and long enough, that with the smallest page_id is the response.

    Pages are dealt by digest and a salt of the page, so a payload that a third of all pages share is many keys; the first
    page of each such key meets the firsts of the digest's other salts in a table of slim rows.
    """
    small_batches(pages.sparkSession)
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2("payload", 256)})
    rows = rows.withColumn("salt", salt_of(F.concat_ws(" ", "page_id", "url")))
    page = F.struct(F.col("page_id").isNull().alias("nameless"), "page_id", F.coalesce("url", F.lit("")).alias("u"))
    key = ["payload_digest", "salt"]
    firsts = rows.where(F.col("payload_bytes") >= least).groupBy(*key).agg(F.min(page).alias("its_first"))
    firsts = saved(firsts.withColumn("first", F.min("its_first").over(Window.partitionBy("payload_digest"))))
    placed = rows.withColumn("place", F.row_number().over(Window.partitionBy(*key).orderBy(*[page[c] for c in ("nameless", "page_id", "u")])))
    met = placed.join(firsts, key, "left")
    again = (F.col("payload_bytes") >= least) & ~((F.col("place") == 1) & (F.col("its_first") == F.col("first")))
    return met.select(
        "page_id", "url", F.when(~again, F.col("payload")).alias("payload"), "payload_bytes", "payload_digest",
        F.when(again, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"), F.when(again, F.col("first.page_id")).alias("refers_to"),
    )


def packaged(pages: DataFrame, folder: str, **names: str) -> None:
    """Writes the pages' records to packages in a folder."""
    pages.sparkSession.dataSource.register(WarcZip)
    as_records(pages, **names).write.format("warczip").mode("append").save(folder)


def read_packages(spark, folder: str, payload: bool = True) -> DataFrame:
    spark.dataSource.register(WarcZip)
    return spark.read.format("warczip").option("payload", str(payload).lower()).load(folder)


def op12_warc_zip(spark, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    files_at, path = files.at(folder)
    files_at.create_dir(path, recursive=True)
    packaged(table(spark, sf_dir, "pages"), folder)
    return read_packages(spark, folder, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The same in DuckDB's SQL.
OP12_SQL = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest, url FROM pages
), q AS (
  SELECT *, row_number() OVER w AS place, first_value(page_id) OVER w AS first_id FROM p
  WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id NULLS LAST, coalesce(url, '') ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= {LEAST} AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST} AND place > 1 THEN first_id END AS refers_to FROM q
"""
