"""Web archives inside ZIP packages: written by tasks, indexed, and read by ranges without extraction.

A package is a ZIP file with two stored (uncompressed) members: the archive
``archive/data.warc.gz``, one gzip member per record as its format wants it, and
the index ``indexes/index.cdxj`` with a line for each record (key, date, and a
JSON object with the record's offset and length in the archive, its digest and
type). As both are stored, a record's bytes lie at a known place of the package:
the reader takes the end of the file, the central directory (with its ZIP64
forms, for packages of more than 4 GB or 65,535 members), the two local headers
and the index, and then reads records by their ranges.

Equal payloads are archived once: ``choices`` finds the record that keeps the
payload, the others become ``revisit`` records that refer to it. Payloads are
told apart by SHA-256; the SHA-1 in the records is only the format's label.

A writing task makes a package of its own rows, so payloads aren't shuffled for
it, and another for every ``PACKAGE_BYTES``. Its name holds the attempt: the
table of packages that ``write`` returns lists those of the attempts that ended,
so a lost executor leaves no half package and none twice.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_path, sized, text_of, written

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Compressed bytes after which a task begins another package.
PACKAGE_BYTES = 1 << 30
#: Bytes of an archive that one task reads at least, if it reads them all.
SLICE_BYTES = 4 << 20
#: A payload of more rows than this part of all is hot; so at most this many payloads are.
HOT_SHARE = 1000
DATE = "2024-01-01T00:00:00Z"
INDEX_ROW = "path string, offset long, length long, page_id long, url string, record_type string, payload_digest string"
RECORD = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload string"


# ---------------------------------------------------------------- the ZIP format

LOCAL, CENTRAL, END, END64, LOCATOR, DESCRIPTOR = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x07\x08"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


class Package:
    """Writes stored members one after another to a stream that can't seek; sizes stand in descriptors behind them."""

    def __init__(self, out):
        self.out, self.at, self.members, self.open = out, 0, [], None

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode()
        self.open = [raw, self.at, 0, 0]
        # the ZIP64 field is there, so the descriptor's sizes have eight bytes
        self._put(LOCAL + struct.pack("<5H3I2H", 45, 1 << 3 | 1 << 11, 0, 0, 33, 0, FULL32, FULL32, len(raw), 20) + raw + struct.pack("<2H2Q", 1, 16, 0, 0))

    def write(self, data: bytes) -> None:
        self._put(data)
        self.open[2] = zlib.crc32(data, self.open[2])
        self.open[3] += len(data)

    def end(self) -> None:
        _, _, crc, size = self.open
        self._put(DESCRIPTOR + struct.pack("<I2Q", crc, size, size))
        self.members.append(self.open)
        self.open = None

    def close(self, zip64: bool = False) -> None:
        """The central directory; ``zip64`` forces the large forms, which are used by themselves where they are needed."""
        start = self.at
        for raw, offset, crc, size in self.members:
            wide = zip64 or max(offset, size) >= FULL32
            extra = struct.pack("<2H3Q", 1, 24, size, size, offset) if wide else b""
            s, o = (FULL32, FULL32) if wide else (size, offset)
            self._put(CENTRAL + struct.pack("<6H3I5H2I", 45, 45, 1 << 3 | 1 << 11, 0, 0, 33, crc, s, s, len(raw), len(extra), 0, 0, 0, 0, o) + raw + extra)
        n, size = len(self.members), self.at - start
        if zip64 or n >= FULL16 or max(start, size) >= FULL32:
            end = self.at
            self._put(END64 + struct.pack("<Q2H2I4Q", 44, 45, 45, 0, 0, n, n, size, start))
            self._put(LOCATOR + struct.pack("<IQI", 0, end, 1))
            n, size, start = FULL16, FULL32, FULL32
        self._put(END + struct.pack("<4H2IH", 0, 0, n, n, size, start, 0))


@dataclass
class Member:
    name: str
    method: int
    size: int
    header: int


class Directory:
    """The members of a package that can be read at any place (``size()``, ``read_at(n, offset)``)."""

    def __init__(self, file):
        self.file, end = file, file.size()
        tail_at = max(0, end - FULL16 - 22)  # a comment has 65,535 bytes at most
        tail = file.read_at(end - tail_at, tail_at)
        k = tail.rfind(END)
        while k >= 0 and (len(tail) < k + 22 or k + 22 + struct.unpack_from("<H", tail, k + 20)[0] != len(tail)):
            k = tail.rfind(END, 0, k)
        if k < 0:
            raise ValueError("not a ZIP package: no end of a central directory")
        disk, first, _, n, size, start = struct.unpack_from("<4H2I", tail, k + 4)
        if FULL16 in (n, disk, first) or FULL32 in (size, start):
            at = tail_at + k - 20
            locator = file.read_at(20, at) if at >= 0 else b""
            if locator[:4] == LOCATOR:
                end64 = file.read_at(56, struct.unpack_from("<Q", locator, 8)[0])
                if end64[:4] != END64:
                    raise ValueError("broken ZIP64 directory")
                disk, first, _, n, size, start = struct.unpack_from("<2I4Q", end64, 16)
        if disk or first:
            raise ValueError("a ZIP package in several parts can't be read")
        raw, at = file.read_at(size, start), 0
        self.members: dict[str, Member] = {}
        for _ in range(n):
            if raw[at : at + 4] != CENTRAL:
                raise ValueError("broken central directory")
            flags, method = struct.unpack_from("<2H", raw, at + 8)
            packed, plain, name_len, extra_len, note_len = struct.unpack_from("<2I3H", raw, at + 20)
            header = struct.unpack_from("<I", raw, at + 42)[0]
            name = raw[at + 46 : at + 46 + name_len].decode("utf-8" if flags >> 11 & 1 else "cp437")
            plain, packed, header = self._wide(raw[at + 46 + name_len : at + 46 + name_len + extra_len], plain, packed, header)
            self.members[name] = Member(name, method, packed, header)
            at += 46 + name_len + extra_len + note_len

    @staticmethod
    def _wide(extra: bytes, *values: int) -> list[int]:
        """Values that don't fit are in the ZIP64 field, in this order, and only those."""
        out, at = list(values), 0
        while at + 4 <= len(extra):
            kind, size = struct.unpack_from("<2H", extra, at)
            if kind == 1:
                field = at + 4
                for k, v in enumerate(values):
                    if v == FULL32 and field + 8 <= at + 4 + size:
                        out[k] = struct.unpack_from("<Q", extra, field)[0]
                        field += 8
            at += 4 + size
        return out

    def place(self, name: str) -> tuple[int, int]:
        """Where the bytes of a stored member are: offset in the package and size."""
        m = self.members[name]
        if m.method:
            raise ValueError(f"member {name} is compressed; only stored members can be read by ranges")
        head = self.file.read_at(30, m.header)
        if head[:4] != LOCAL:
            raise ValueError(f"member {name} has no local header")
        name_len, extra_len = struct.unpack_from("<2H", head, 26)
        return m.header + 30 + name_len + extra_len, m.size

    def archives(self) -> list[tuple[str, str | None]]:
        """Archive members and their indexes: one index for all, or one of each archive's name."""
        found = sorted(n for n in self.members if n.startswith("archive/") and n.endswith((".warc.gz", ".warc")))
        indexes = sorted(n for n in self.members if n.startswith("indexes/") and n.endswith(".cdxj"))
        stem = lambda n: n.rpartition("/")[2].split(".")[0]
        own = {stem(n): n for n in indexes}
        return [(a, own.get(stem(a)) or (indexes[0] if len(indexes) == 1 and len(found) == 1 else None)) for a in found]


# ---------------------------------------------------------------- records

def sha1_label(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _id(page_id: int | None, digest: str) -> str:
    return f"urn:page:{'null' if page_id is None else page_id}:{digest}"


def packed_record(page_id: int | None, url: str | None, payload: bytes, keep: int | None, revisit: bool) -> tuple[bytes, str, str]:
    """A record as a gzip member, its type and the payload's label; a revisit has the response's headers alone."""
    digest = sha1_label(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind, block = ("revisit", http) if revisit else ("response", http + payload)
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{_id(page_id, digest)}{':revisit' * revisit}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{_id(keep, digest)}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = b"WARC/1.1\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, 6, mtime=0), kind, digest


def _fields(head: bytes) -> dict[str, str]:
    lines = (x.partition(":") for x in head.decode("utf-8").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in lines}


def _page(urn: str | None) -> int | None:
    value = (urn or "").strip("<>").split(":")[2:3]
    return int(value[0]) if value and value[0] not in ("", "null") else None


def parsed_record(member: bytes) -> dict:
    """The fields of ``RECORD`` from a gzip member; a payload that doesn't match its label is an error."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1."):
        raise ValueError("no WARC record")
    h = _fields(head)
    block = rest[: int(h["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size, label = int(_fields(http)["content-length"]), h["warc-payload-digest"].removeprefix("sha1:")
    if h["warc-type"] == "response" and (len(payload) != size or sha1_label(payload) != label):
        raise ValueError(f"payload of {h['warc-record-id']} doesn't match its digest")
    revisit = h["warc-type"] == "revisit"
    return {
        "page_id": _page(h["warc-record-id"]), "url": h.get("warc-target-uri"), "record_type": h["warc-type"], "payload_digest": label, "payload_bytes": size,
        "refers_to": _page(h.get("warc-refers-to")) if revisit else None, "payload": None if revisit else payload,
    }


# ---------------------------------------------------------------- Spark jobs

def choices(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html") -> DataFrame:
    """``pages`` with ``_sha``, ``_keep`` (the largest id of an equal payload, null for a payload that stands once) and ``_n``.

    Only payloads that stand more than once are joined: those of a great part
    of the rows by a broadcast, which is bounded by their share; the others by
    a broadcast if they are few, else by a shuffle on the digest, in which no
    key is hot any more.
    """
    sha = F.unhex(F.sha2(text_of(payload_col), 256))
    groups = pages.select(sha.alias("sha"), F.col(id_col).cast("long").alias("id")).groupBy("sha").agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("n"))
    copied = written(groups.where("n > 1"), "copied")
    total = copied.agg(F.sum("n")).head()[0] or 0
    hot = F.broadcast(copied.where(F.col("n") > max(1000, total // HOT_SHARE)).select(F.col("sha").alias("_sha"), F.col("keep").alias("_k1"), F.col("n").alias("_n1")))
    cold = sized(copied.where(F.col("n") <= max(1000, total // HOT_SHARE)))
    rows = pages.withColumn("_sha", sha).join(hot, "_sha", "left")
    # what is found goes anywhere in the second join, not to its own digest's task
    key = F.when(F.col("_n1").isNull(), F.col("_sha")).otherwise(F.concat(F.lit("-").cast("binary"), F.unhex(F.sha2(F.coalesce(F.col(id_col).cast("string"), F.lit("")), 256))))
    both = rows.withColumn("_key", key).join(cold.select(F.col("sha").alias("_key"), F.col("keep").alias("_k2"), F.col("n").alias("_n2")), "_key", "left")
    return both.select(*pages.columns, "_sha", F.coalesce("_k1", "_k2").alias("_keep"), F.coalesce("_n1", "_n2").alias("_n"))


def write(pages: DataFrame, out: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Archive every row under ``out``; returns ``path, n_records, n_bytes`` of each package.

    The payload is the text in UTF-8, null is empty. Of rows with equal payloads
    that of the largest id is a response and the others revisit it; a null id is
    less than all. Rows that repeat the largest id and the payload are all
    responses. A null url is left out. Other columns aren't read, whatever their
    names. A task without rows writes no package.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), text_of(payload_col).alias("html"))
    chosen = choices(rows)
    revisit = F.coalesce(F.col("_n") > 1, F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("_keep"))
    ready = chosen.select("page_id", "url", "html", F.col("_keep").alias("keep"), revisit.alias("revisit"))
    schema = pa.schema([("path", pa.string()), ("n_records", pa.int64()), ("n_bytes", pa.int64())])

    def save(batches):
        fs, folder = pyarrow.fs.FileSystem.from_uri(out)
        fs.create_dir(folder, recursive=True)
        task, k, package, lines = TaskContext.get(), 0, None, []

        def ended():
            package.end()
            package.begin(INDEX)
            for line in sorted(lines):
                package.write(line)
            package.end()
            package.close()
            package.out.close()
            return pa.RecordBatch.from_pylist([{"path": f"{out}/{name}", "n_records": len(lines), "n_bytes": package.at}], schema)

        for b in batches:
            payloads = b.column(2).cast(pa.binary())
            for page_id, url, html, keep, again in zip(*(c.to_pylist() for c in b.columns[:2]), payloads, *(c.to_pylist() for c in b.columns[3:]), strict=True):
                if package is None:
                    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{k:04d}.wacz"
                    package, k, lines = Package(fs.open_output_stream(f"{folder}/{name}")), k + 1, []
                    package.begin(ARCHIVE)
                record, kind, digest = packed_record(page_id, url, html.as_py(), keep, again)
                at = {"url": url, "page": page_id, "type": kind, "digest": f"sha1:{digest}", "offset": package.open[3], "length": len(record)}
                lines.append(f"{re.sub(r'\s', '%20', url or '-')} {re.sub('[^0-9]', '', DATE)} {json.dumps(at)}\n".encode())
                package.write(record)
                if package.at >= package_bytes:
                    yield ended()
                    package = None
        if package is not None:
            yield ended()

    return written(ready.mapInArrow(save, "path string, n_records long, n_bytes long"), "packages")


def _opened(path: str):
    fs, p = pyarrow.fs.FileSystem.from_uri(path)
    return fs.open_input_file(p)


def _index_lines(file, at: int, size: int, block: int = 1 << 20) -> Iterator[bytes]:
    """Lines of an index, a block of it at a time."""
    rest = b""
    for lo in range(0, size, block):
        *lines, rest = (rest + file.read_at(min(block, size - lo), at + lo)).split(b"\n")
        yield from lines
    if rest:
        yield rest


def index(packages: DataFrame) -> DataFrame:
    """A row for each record that the packages (``path``) list: ``INDEX_ROW``, with its place in the package.

    Any rows of it, chosen by filters or joins, can be given to ``read``. An
    archive member without an index is an error; a package without archives has
    no rows.
    """

    def run(batches):
        schema = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string())])
        for b in batches:
            for path in b.column(0).to_pylist():
                with _opened(path) as file:
                    directory = Directory(file)
                    for archive, listing in directory.archives():
                        if listing is None:
                            raise ValueError(f"{path}: {archive} has no index")
                        base, total = directory.place(archive)
                        rows = []
                        for line in _index_lines(file, *directory.place(listing)):
                            at = json.loads(line.split(b" ", 2)[2])
                            if at["offset"] + at["length"] > total:
                                raise ValueError(f"{path}: a record lies outside {archive}")
                            rows.append((path, base + at["offset"], at["length"], at["page"], at["url"], at["type"], at["digest"].removeprefix("sha1:")))
                            if len(rows) == 10_000:
                                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                                rows = []
                        if rows:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    n = int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return packages.select("path").repartition(n, "path").mapInArrow(run, INDEX_ROW)


def read(rows: DataFrame, slice_bytes: int = SLICE_BYTES, payload: bool = True) -> DataFrame:
    """The records that ``rows`` of ``index`` name: ``RECORD``, with the payload as text only if asked for.

    Neighbours in a package are read by one range of about ``slice_bytes``; a
    large package is read by many tasks. A record that isn't what its index says
    or whose payload doesn't match its digest fails the task.
    """
    names = [x.split()[0] for x in RECORD.split(", ")][: None if payload else -1]

    def made(records):
        kinds = [pa.int64() if c in ("page_id", "payload_bytes", "refers_to") else pa.string() for c in names]
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in records], t) for c, t in zip(names, kinds, strict=True)], names)

    def run(batches):
        at, file, records, held = None, None, [], 0
        for b in batches:
            todo = list(zip(*(b.column(k).to_pylist() for k in range(3)), strict=True))
            k = 0
            while k < len(todo):
                path, lo, length = todo[k]
                hi, last = lo + length, k + 1
                while last < len(todo) and todo[last][0] == path and todo[last][1] == hi and hi - lo < slice_bytes:
                    hi, last = hi + todo[last][2], last + 1
                if path != at:
                    if file is not None:
                        file.close()
                    at, file = path, _opened(path)
                data = memoryview(file.read_at(hi - lo, lo))
                for _, offset, size in todo[k:last]:
                    record = parsed_record(data[offset - lo : offset - lo + size])
                    records.append({c: record[c] for c in names})
                    held += 200 + (record["payload_bytes"] if payload else 0)
                    if held > slice_bytes:  # payloads of one batch
                        yield made(records)
                        records, held = [], 0
                k = last
        if records:
            yield made(records)
        if file is not None:
            file.close()

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select("path", "offset", "length").repartition(n, "path", F.floor(F.col("offset") / slice_bytes)).sortWithinPartitions("path", "offset")
    return dealt.mapInArrow(run, RECORD if payload else RECORD.rpartition(",")[0])


def archived(pages: DataFrame) -> DataFrame:
    """Archive all rows under the shared folder and read every record back: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    packages = write(pages, new_path(pages.sparkSession, "warc"))
    return read(index(packages), payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
