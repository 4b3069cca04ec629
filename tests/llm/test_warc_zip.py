"""ZIP-packaged web archives: the format against the standard library, ZIP64, ranges, and records against brute force."""

import base64
import gzip
import hashlib
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from quillfold.llm import warc_zip
from quillfold.llm.warc_zip import Directory, Package

SF = "/root/testdata/sf0.001"


class Memory:
    """A file in memory that tells how much of it was read."""

    def __init__(self, raw):
        self.raw, self.got = raw, 0

    def size(self):
        return len(self.raw)

    def read_at(self, n, at):
        self.got += n
        return self.raw[at : at + n]


def packaged(members, zip64=False):
    out = io.BytesIO()
    p = Package(out)
    for name, data in members:
        p.begin(name)
        p.write(data[:3])
        p.write(data[3:])
        p.end()
    p.close(zip64)
    return out.getvalue()


@pytest.mark.parametrize("zip64", [False, True])
def test_packages_are_zip_files(zip64):
    members = [("archive/data.warc.gz", b"abc" * 1000), ("indexes/ü.cdxj", b""), ("c", b"x")]
    raw = packaged(members, zip64)
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        assert z.testzip() is None and [(i.filename, z.read(i)) for i in z.infolist()] == members
        assert all(i.compress_type == zipfile.ZIP_STORED for i in z.infolist())
    d = Directory(Memory(raw))
    for name, data in members:
        at, size = d.place(name)
        assert raw[at : at + size] == data


def test_reads_packages_of_the_standard_library():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("archive/a.warc.gz", b"one")
        z.writestr("archive/b.warc.gz", b"two")
        z.writestr("indexes/b.cdxj", b"line")
        z.writestr("packed", b"x" * 999, zipfile.ZIP_DEFLATED)
        z.comment = b"PK\x05\x06 a comment that looks like an end" + bytes(40)
    d = Directory(Memory(out.getvalue()))
    at, size = d.place("archive/b.warc.gz")
    assert out.getvalue()[at : at + size] == b"two"
    assert d.archives() == [("archive/a.warc.gz", None), ("archive/b.warc.gz", "indexes/b.cdxj")]
    with pytest.raises(ValueError, match="compressed"):
        d.place("packed")
    for broken in (b"", b"nothing", out.getvalue()[:-80]):
        with pytest.raises(ValueError):
            Directory(Memory(broken))


def test_many_members_need_zip64():
    raw = packaged([(f"m{k}", b"") for k in range(70_000)])
    d = Directory(Memory(raw))
    assert len(d.members) == 70_000 and d.place("m69999")[1] == 0
    assert len(zipfile.ZipFile(io.BytesIO(raw)).namelist()) == 70_000


def test_offsets_beyond_four_gigabytes(tmp_path):
    """A sparse file: the first member is a hole of 5 GB, so the second is found through ZIP64 fields alone."""
    path, hole = tmp_path / "large.zip", 5 << 30
    with open(path, "wb") as f:
        p = Package(f)
        p.begin("hole")
        f.seek(hole, 1)
        p.at += hole
        p.open[3] = hole
        p.end()
        p.begin("indexes/i.cdxj")
        p.write(b"found")
        p.end()
        p.close()
    with warc_zip._opened(f"file://{path}") as file:
        d = Directory(file)
        assert d.place("hole")[1] == hole
        at, size = d.place("indexes/i.cdxj")
        assert at > hole and file.read_at(size, at) == b"found"


def brute(rows):
    keep = {}
    for i, t in rows:
        t = t or ""
        keep[t] = i if t not in keep or keep[t] is None or (i is not None and i > keep[t]) else keep[t]
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        same = keep[t or ""] == i
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if same else "revisit", None if same else keep[t or ""]))
    return sorted(out, key=str)


def test_pages_and_copies(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    more = [(10_000 + k, f"http://h/{k}", "copy" if k % 3 else None) for k in range(3000)] + [(20_000 + k, None, f"two {k // 2}") for k in range(400)]
    rows = pages.unionByName(spark.createDataFrame(more, pages.schema))
    got = sorted(map(tuple, warc_zip.archived(rows).collect()), key=str)
    assert got == brute([(r.page_id, r.html) for r in rows.collect()])
    assert sum(r[3] == "revisit" for r in got) == 3000 - 2 + 200


def test_edges(spark):
    rows = [(1, "u", None), (2, "u\r\nx: y", ""), (3, None, "é\x00😀"), (3, None, "é\x00😀"), (None, "n", "é\x00😀"), (None, "n", "alone"), (None, "n", "alone"), (4, "u v", "x" * 3_000_000), (4, "u", "other"), (5, "u", "other\r\n\r\nWARC/1.1\r\n\r\n")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").select("*", *[F.lit(1).alias(c) for c in ("_sha", "_keep", "_n", "path", "offset", "keep", "revisit")])
    got = sorted(map(tuple, warc_zip.archived(df).collect()), key=str)
    assert got == brute([(r[0], r[2]) for r in rows])
    assert warc_zip.archived(df.limit(0)).count() == 0


def test_ranges_packages_and_damage(spark, tmp_path):
    pages = spark.range(300).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), "id").alias("url"), F.repeat(F.sha2(F.col("id").cast("string"), 512), 50).alias("html"))
    packages = warc_zip.write(pages.repartition(3, "page_id"), f"file://{tmp_path}/w", package_bytes=4000)
    listed = packages.collect()
    assert sum(r.n_records for r in listed) == 300 and len(listed) > 6
    for r in listed[:3]:
        with zipfile.ZipFile(r.path.removeprefix("file://")) as z:
            assert z.testzip() is None and z.namelist() == [warc_zip.ARCHIVE, warc_zip.INDEX]
            assert gzip.decompress(z.read(warc_zip.ARCHIVE)).count(b"WARC/1.1\r\n") == r.n_records
    wanted = warc_zip.index(packages).where("url in ('http://h/7', 'http://h/250')")
    got = {r.page_id: r.payload for r in warc_zip.read(wanted).collect()}
    assert got == {k: hashlib.sha512(str(k).encode()).hexdigest() * 50 for k in (7, 250)}
    assert warc_zip.read(warc_zip.index(packages), slice_bytes=1000).count() == 300
    place = warc_zip.index(packages).where("page_id = 7").head()
    with open(place.path.removeprefix("file://"), "r+b") as f:
        f.seek(place.offset + place.length - 12)
        f.write(b"\xff\xff\xff")
    with pytest.raises(Exception, match="(?i)error|digest"):
        warc_zip.read(warc_zip.index(packages).where("page_id = 7")).collect()


def test_one_record_is_read_without_the_others():
    records = [warc_zip.packed_record(k, f"u{k}", bytes(range(256)) * 400, None, False)[0] for k in range(50)]
    raw = Memory(packaged([(warc_zip.ARCHIVE, b"".join(records)), (warc_zip.INDEX, b"")]))
    at, _ = Directory(raw).place(warc_zip.ARCHIVE)
    raw.got = 0
    lo = at + sum(map(len, records[:20]))
    assert warc_zip.parsed_record(raw.read_at(len(records[20]), lo))["page_id"] == 20 and raw.got == len(records[20])
