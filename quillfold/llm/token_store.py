"""Token ids in seekable files of independent zstandard frames.

A shard file is: one zstandard frame per document (little-endian unsigned ids,
each frame with its own content checksum), then a skippable frame with the
document index (ids of the documents, width of a token id), then the seek table
of the public seekable format: a skippable frame with, for each frame, its
compressed size, its decompressed size and the low 32 bits of its XXH64 (four
bytes each), and a footer of nine bytes (number of frames, a descriptor whose
high bit says that there are checksums, the format's magic). The index is listed
in it as a last frame without content, as the format wants every byte listed. A
reader takes the footer, the two tables, and then only the frames it wants; any
other reader of the format can open the file, too. A document of 4 GB of ids or
more is an error, as the format has no place for it.

Documents are dealt to ranges of their id, and a range's task begins a new shard
whenever the one it writes is full, so shards don't grow with the corpus or with
an id that repeats; the shards in order, and the documents in each, ascend. A task that runs again writes the same bytes to
another temporary name and renames it, so a lost executor leaves no half file.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import new_path, written

SKIPPABLE = 0x184D2A5E
FOOTER = 0x8F92EAB1
INDEX = 0x184D2A51
CACHE = 1_000_000
#: Ranges of ids at most: their bounds are numbers that every task has.
MAX_RANGES = 10_000
#: Bytes of text that a range is meant for, and bytes of ids after which a range's next file begins.
SHARD_BYTES = 64 << 20
#: Documents after which a range's next file begins: a file's index is held in memory.
SHARD_DOCS = 1_000_000


class WordEncoder:
    """The tokenizers library with a cache of words.

    Texts of printable ASCII and Latin-1 without special strings are cut into
    words here, as the vocabulary's own rules do it, and only new words go to
    the library; all other texts go to it whole.
    """

    #: How the vocabulary's pre-tokenizer cuts lower-cased text; fixed by its file.
    CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    PLAIN = r"[\t\n\r\x20-\x7e¡-¬®-ÿ]*"
    #: The lower-case letters and the numbers of Latin-1, for the standard library's faster matcher.
    LETTERS, NUMBERS = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾"

    def __init__(self, path: str, width: int, end_id: int | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each task one core
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.dtype = f"<u{width}"
        self.end = b"" if end_id is None else np.array([end_id], self.dtype).tobytes()
        import json

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_word = self._cut_here(spec)
        self.special = [t["content"] for t in spec["added_tokens"]]
        pattern = self.CUT.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{self.LETTERS}{self.NUMBERS}]").replace(r"[\p{L}]", f"[{self.LETTERS}]").replace(r"[\p{N}]", f"[{self.NUMBERS}]")
        self.cut = re.compile(pattern).findall
        self.plain = re.compile(self.PLAIN).fullmatch
        self.cache: dict[str, bytes] = {}

    def _cut_here(self, spec: dict) -> bool:
        """Whether words can be encoded apart: the file cuts as ``CUT`` does, and of plain text its normaliser changes letters to lower case alone."""
        first, *rest = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        cut = (first.get("pattern") or {}).get("Regex") == self.CUT and first.get("behavior") == "Removed" and first.get("invert") is True
        to_bytes = all(p.get("type") == "ByteLevel" and not p.get("add_prefix_space") and not p.get("use_regex") for p in rest)
        tokens = not any(t.get(k) for t in spec["added_tokens"] for k in ("normalized", "lstrip", "rstrip", "single_word"))
        whole = not (spec.get("model") or {}).get("dropout") and not spec.get("truncation") and not spec.get("padding")
        normal = self.tok.normalizer.normalize_str if self.tok.normalizer else str
        letters = "".join(map(chr, [*range(33, 127), *range(161, 173), *range(174, 256)]))
        return cut and to_bytes and tokens and whole and normal(letters) == letters.lower() and normal("A \t\r\n B").split() == ["a", "b"]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` and the end id, as little-endian integers."""
        if not self.by_word or not self.plain(text) or any(s in text for s in self.special):
            return self._whole(text) + self.end
        words = self.cut(text.lower())
        known = self.cache
        found = list(map(known.get, words))
        if None in found:
            if len(known) > CACHE:
                known.clear()
            new = list({w for w in words if w not in known})
            for w, e in zip(new, self.tok.encode_batch_fast(new, add_special_tokens=False), strict=True):
                known[w] = np.array(e.ids, self.dtype).tobytes()
            found = map(known.__getitem__, words)
        return b"".join(found) + self.end


@lru_cache(4)
def loaded(path: str, width: int, end_id: int | None) -> WordEncoder:
    return WordEncoder(path, width, end_id)


class ShardWriter:
    def __init__(self, path: str, width: int):
        self.fs, self.path = pyarrow.fs.FileSystem.from_uri(path)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.tmp = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.out = self.fs.open_output_stream(self.tmp)
        self.width, self.ids, self.table, self.n_ids = width, [], [], 0

    def add(self, doc_id: int | None, frame: bytes, size: int, check: int) -> None:
        self.out.write(frame)
        self.ids.append(doc_id)
        self.table.append((len(frame), size, check))
        self.n_ids += size // self.width

    def close(self) -> None:
        null = np.array([i is None for i in self.ids], np.uint8)
        index = zstandard.compress(struct.pack("<BI", self.width, len(self.ids)) + null.tobytes() + np.array([i or 0 for i in self.ids], "<i8").tobytes())
        self.out.write(struct.pack("<II", INDEX, len(index)) + index)
        rows = [*self.table, (len(index) + 8, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)]
        body = b"".join(struct.pack("<III", *x) for x in rows) + struct.pack("<IBI", len(rows), 1 << 7, FOOTER)
        self.out.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.out.close()
        self.fs.move(self.tmp, self.path)


class ShardReader:
    """Opens a shard; reads any document by its place or id without the others."""

    def __init__(self, path: str):
        self.fs, p = pyarrow.fs.FileSystem.from_uri(path)
        self.file = self.fs.open_input_file(p)
        end = self.file.size()
        n, told, magic = struct.unpack("<IBI", self.file.read_at(9, end - 9))
        if magic != FOOTER or told != 1 << 7:
            raise ValueError(f"{path} has no seek table with checksums")
        start = end - 9 - 12 * n
        table = np.frombuffer(self.file.read_at(12 * n, start), np.dtype([("c", "<u4"), ("d", "<u4"), ("x", "<u4")])).astype([("c", "<u8"), ("d", "<u8"), ("x", "<u4")])
        index_size, table = int(table["c"][-1]), table[:-1]
        index = zstandard.decompress(self.file.read_at(index_size - 8, start - index_size))
        self.width, count = struct.unpack_from("<BI", index)
        null = np.frombuffer(index, np.uint8, count, 5)
        ids = np.frombuffer(index, "<i8", count, 5 + count)
        self.doc_ids = [None if z else int(i) for i, z in zip(ids, null, strict=True)]
        self.sizes, self.checks, self.counts = table["c"], table["x"], table["d"] // self.width
        self.offsets = np.concatenate([[0], np.cumsum(table["c"])]).astype(np.int64)[:-1]
        self.places = {i: k for k, i in reversed(list(enumerate(self.doc_ids)))}
        self.decompress = zstandard.ZstdDecompressor().decompress

    def read(self, k: int) -> np.ndarray:
        """The ids of the k-th document; a frame that doesn't match its checksum is an error."""
        raw = self.decompress(self.file.read_at(int(self.sizes[k]), int(self.offsets[k])))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.checks[k]:
            raise ValueError(f"frame {k} doesn't match its checksum")
        return np.frombuffer(raw, f"<u{self.width}")

    def read_id(self, doc_id: int | None) -> np.ndarray:
        """The ids of the first document with this id; an id that isn't here is a ``KeyError``."""
        return self.read(self.places[doc_id])

    def close(self) -> None:
        self.file.close()


def write_tokens(docs: DataFrame, vocabulary: str, out: str, end_id: int | None = 1, width: int = 2,
                 n_shards: int | None = None, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Encode every text, append ``end_id``, write shards under ``out``; ``shard, part, path, n_docs, n_ids, start``.

    ``shard`` is a range of ids (``n_shards`` of them, or by bytes of text) and
    ``part`` the file in it: another begins before a document that would bring a
    file above ``shard_bytes`` of ids or ``shard_docs`` documents.

    ``width`` is the bytes of an id in the file (2 holds vocabularies up to
    65,536). A null text is empty: its document holds the end id alone. Null ids
    come first; rows that repeat an id are all kept, in the order of their
    tokens. Other columns aren't read. An empty table gives no file and no row.
    ``start`` is the number of ids in all shards before.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = 0 if n_shards else rows.agg(F.sum(F.octet_length("text").cast("long"))).head()[0] or 0
    n = min(MAX_RANGES, n_shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES)))
    # at most MAX_RANGES numbers
    cuts = (rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 100 * n)).head()[0] or []) if n > 1 else []
    bounds = np.array(sorted(set(cuts)), np.int64)

    def encoded(batches):
        enc = loaded(vocabulary, width, end_id)
        pack = zstandard.ZstdCompressor(level=1, write_checksum=True).compress
        for b in batches:
            ids = b.column(0).to_pylist()
            frames, sizes, checks = [], [], []
            for t in b.column(1):
                raw = enc.encode(t.as_py() or "")
                frames.append(pack(raw))
                sizes.append(len(raw))
                checks.append(xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF)
            shard = [0 if i is None else int(np.searchsorted(bounds, i)) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), b.column(0), pa.array(frames, pa.binary()), pa.array(sizes, pa.int64()), pa.array(checks, pa.int64())],
                ["shard", "doc_id", "frame", "size", "check"],
            )

    def save(batches):
        writer, at, part = None, None, 0

        def ended():
            writer.close()
            return pa.RecordBatch.from_pylist([{"shard": at, "part": part, "path": f"{out}/shard-{at:06d}-{part:06d}.zst", "n_docs": len(writer.ids), "n_ids": writer.n_ids}], schema)

        for b in batches:
            for shard, doc_id, frame, size, check in zip(*(c.to_pylist() for c in b.columns), strict=True):
                full = writer and (len(writer.ids) >= shard_docs or writer.n_ids * width + size > shard_bytes)
                if shard != at or full:
                    if writer:
                        yield ended()
                    at, part = shard, part + 1 if shard == at else 0
                    writer = ShardWriter(f"{out}/shard-{at:06d}-{part:06d}.zst", width)
                writer.add(doc_id, frame, size, check)
        if writer:
            yield ended()

    schema = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])
    sorted_rows = (
        rows.mapInArrow(encoded, "shard int, doc_id long, frame binary, size long, check long")
        .repartition(n, "shard").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "size", "frame")
    )
    shards = written(sorted_rows.mapInArrow(save, "shard int, part int, path string, n_docs long, n_ids long"), "shards")
    # one row per shard
    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_tokens(shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back from the files.

    ``ids_crc32`` is of the ids as little-endian 32-bit integers. A frame whose
    checksum is wrong fails the task.
    """

    def run(batches):
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                shard = ShardReader(path)
                counts = shard.counts.astype(np.int64)
                starts = start + np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
                crc = [zlib.crc32(shard.read(k).astype("<u4").tobytes()) for k in range(len(counts))]
                shard.close()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids, pa.int64()), pa.array(starts), pa.array(counts), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    n = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return shards.select("path", "start").repartition(n, "path").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def store(spark: SparkSession, docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write all documents under the shared folder and read them back."""
    return read_tokens(write_tokens(docs, vocabulary, new_path(spark, "tokens")))
