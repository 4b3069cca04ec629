"""Fill-in-middle transformation of whole texts, cut through a sparse checkpoint index.

A text is a run of units: code points, words or lines. While its units are
counted, the byte and code-point offsets of every ``STEP``-th unit are kept. A
cut "after k units" looks up the last checkpoint at or before unit k by binary
search and rescans the few bytes from there, so a text is never turned into an
array of its units: a cut costs ``STEP`` units at most, and the index of a text
of a gigabyte is some megabytes. Everything works on the UTF-8 bytes; texts are
scanned in blocks of ``BLOCK`` bytes.

Where the cuts fall and which form a document takes are functions of its id
alone (``draws``), so a task that runs again gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

STEP = 1024
BLOCK = 1 << 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def _points(block: np.ndarray, before: int) -> np.ndarray:
    return (block & 0xC0) != 0x80


def _words(block: np.ndarray, before: int) -> np.ndarray:
    """A word begins after ASCII white space; white space belongs to the word before it."""
    space = (block == 32) | ((block >= 9) & (block <= 13))
    return ~space & np.concatenate(([before == 32 or 9 <= before <= 13], space[:-1]))


def _lines(block: np.ndarray, before: int) -> np.ndarray:
    return np.concatenate(([before == 10], block[:-1] == 10))


#: Where units begin in a block of bytes, given the byte before it; the first byte of a text always begins one.
UNITS: dict[str, Callable[[np.ndarray, int], np.ndarray]] = {"code_point": _points, "word": _words, "line": _lines}


class Checkpoints:
    """The number of units of a text and the places of every ``step``-th of them."""

    def __init__(self, raw: bytes, unit: str = "code_point", step: int = STEP, block: int = BLOCK):
        self.raw, self.starts, self.step, self.block = raw, UNITS[unit], step, block
        self.n = self.n_points = 0
        at_byte, at_point = [], []
        for base in range(0, len(raw), block):
            places = self._places(base, min(base + block, len(raw)))
            points = places if unit == "code_point" else np.flatnonzero(_points(np.frombuffer(raw, np.uint8, min(block, len(raw) - base), base), 0))
            kept = places[-self.n % step :: step]  # units whose number is a multiple of the step
            at_byte.append(kept + base)
            at_point.append(self.n_points + np.searchsorted(points, kept))
            self.n += len(places)
            self.n_points += len(points)
        self.bytes = np.concatenate(at_byte) if at_byte else np.zeros(0, np.int64)
        self.points = np.concatenate(at_point) if at_point else np.zeros(0, np.int64)
        self.units = np.arange(len(self.bytes)) * step

    def _places(self, lo: int, hi: int) -> np.ndarray:
        """The units that begin in ``raw[lo:hi]``, as offsets from ``lo``."""
        mask = self.starts(np.frombuffer(self.raw, np.uint8, hi - lo, lo), self.raw[lo - 1] if lo else 0)
        if lo == 0 and hi:
            mask[0] = True
        return np.flatnonzero(mask)

    def cut(self, k: int) -> tuple[int, int]:
        """Byte and code-point offsets of the end of the first ``k`` units."""
        if k >= self.n:
            return len(self.raw), self.n_points
        c = int(np.searchsorted(self.units, k, "right")) - 1
        lo, left = int(self.bytes[c]), k - int(self.units[c])
        at, hi = lo, lo
        while True:  # from the checkpoint to the unit, a short way
            hi = min(at + 4 * self.step, len(self.raw))
            places = self._places(at, hi)
            if left < len(places):
                at += int(places[left])
                break
            left -= len(places)
            at = hi
        seen = np.frombuffer(self.raw, np.uint8, at - lo, lo)
        return at, int(self.points[c]) + int(np.count_nonzero((seen & 0xC0) != 0x80))


def draws(id_col: Column, seed: int = 1) -> Column:
    """Four unsigned 32-bit numbers of a document, from SHA-256 of ``seed:id``; those of a null id are of ``seed:``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)])


def infilled(docs: DataFrame, seed: int = 1, rate: int = 90, spm: int = 20, unit: str = "code_point", step: int = STEP, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row, and the columns in ``keep``.

    ``n`` counts units. Of a hundred documents about ``rate`` are cut, of these
    ``spm`` of a hundred as suffix, prefix, middle and the others as prefix,
    suffix, middle. Null texts are empty; empty texts and those that hold one of
    the three marks stay ``plain``, with null lengths. Rows that repeat an id
    are cut at the same draws. Rows of a null id are cut alike. Lengths are in
    code points. Other columns aren't read; an empty table gives an empty one.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("_text"), draws(F.col(id_col), seed).alias("_h"), *[F.col(c).alias(f"_keep_{c}") for c in keep])
    marks = (PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode())

    def cut(raw: bytes, h: list[int]) -> tuple:
        index = Checkpoints(raw, unit, step)
        n = index.n
        if not raw or h[2] % 100 >= rate or any(m in raw for m in marks):
            return n, "plain", None, None, raw
        (b1, p1), (b2, p2) = (index.cut(k) for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
        prefix, middle, suffix = raw[:b1], raw[b1:b2], raw[b2:]
        form, parts = ("spm", (marks[1], suffix, marks[0], prefix)) if h[3] % 100 < spm else ("psm", (marks[0], prefix, marks[1], suffix))
        return n, form, p1, p2 - p1, b"".join((*parts, marks[2], middle))

    def run(batches):
        for b in batches:
            texts = b.column(1).cast(pa.binary())
            made = [cut(t.as_py(), h) for t, h in zip(texts, b.column(2).to_pylist(), strict=True)]
            n, form, first, mid, out = zip(*made, strict=True) if made else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(first, pa.int64()), pa.array(mid, pa.int64()), pa.array(out, pa.string()), *b.columns[3:]],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", *b.schema.names[3:]],
            )

    kept = "".join(f", `_keep_{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    made = rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string" + kept)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", *[F.col(f"_keep_{c}").alias(c) for c in keep])


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of: a mark can't arise where parts meet, so the three marks part it without doubt."""
    parts = F.split(output, "<[PSM]>", 4)
    part = lambda *order: F.concat(*[F.get(parts, F.lit(k)) for k in order])
    return F.when(form == "psm", part(1, 3, 2)).when(form == "spm", part(2, 3, 1)).otherwise(output)


def digests(made: DataFrame) -> DataFrame:
    """The rows of ``infilled`` with digests of the output and of the text restored from it instead of the output."""
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
