"""Byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

The merges of one pre-token: each leaf of the tree holds ``rank << 32 | place``
of the pair that starts at that place, each inner node the least of its two
children. So the root is the leftmost pair of lowest rank. Merging it changes
three leaves, each in logarithmic time, until the root holds no pair. A run of
a million characters without a break costs n log n, not n squared.

Pre-tokens repeat, so each Python worker keeps a bounded cache of encoded ones.
The vocabulary's path is a parameter; every executor must be able to read it.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cached pre-tokens in a worker; a full cache is emptied.
CACHE = 400_000
#: Longer pre-tokens aren't cached.
CACHED_LENGTH = 64
NONE = 1 << 62


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


def merge(symbols: list[int], pairs: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Apply merges to ``symbols``; ``pairs`` gives (rank, new id) of a pair of ids."""
    n = len(symbols)
    if n < 2:
        return symbols
    ids = symbols[:]
    size = 1 << (n - 2).bit_length() if n > 2 else 1
    tree = [NONE] * (2 * size)
    get = pairs.get
    for i in range(n - 1):
        if p := get((ids[i], ids[i + 1])):
            tree[size + i] = p[0] << 32 | i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def put(place: int, value: int) -> None:
        k = size + place
        tree[k] = value
        while k > 1:
            a, b = tree[k], tree[k ^ 1]
            k >>= 1
            least = a if a < b else b
            if tree[k] == least:
                break
            tree[k] = least

    while (root := tree[1]) != NONE:
        i = root & 0xFFFFFFFF
        j = after[i]
        ids[i] = pairs[ids[i], ids[j]][1]
        ids[j] = -1
        k = after[j]
        after[i] = k
        if j < n - 1:
            put(j, NONE)
        if k < n:
            before[k] = i
            p = get((ids[i], ids[k]))
            put(i, p[0] << 32 | i if p else NONE)
        else:
            put(i, NONE)
        if (h := before[i]) >= 0:
            p = get((ids[h], ids[i]))
            put(h, p[0] << 32 | h if p else NONE)
    return [x for x in ids if x >= 0]


class ByteBPE:
    """Encoder and decoder for a byte-level vocabulary file of the tokenizers library."""

    #: How text is cut before the merges; fixed by the vocabulary's pre-tokenizer.
    CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    #: Printable ASCII and Latin-1, and in it the same letters and numbers for the faster standard library.
    PLAIN = r"[\t\n\r\x20-\x7e¡-¬®-ÿ]*"
    LETTERS, NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾"

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        if pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or spec["normalizer"]:
            raise ValueError(f"{path} isn't a plain byte-level vocabulary")
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges") if spec["model"].get(k)]
        odd += [f"{k} of {t['content']}" for t in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word", "normalized") if t.get(k)]
        odd += [k for k in ("truncation", "padding") if spec.get(k)]
        if odd:
            raise ValueError(f"{path} asks for what isn't done here: {', '.join(odd)}")
        vocab = spec["model"]["vocab"]
        alphabet = byte_alphabet()
        back = {c: b for b, c in enumerate(alphabet)}
        self.byte_ids = [vocab[c] for c in alphabet]
        self.pairs = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.pairs[vocab[a], vocab[b]] = rank, vocab[a + b]
        self.token_bytes = {i: bytes(back[c] for c in t) for t, i in vocab.items() if all(c in back for c in t)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes |= {i: t.encode() for t, i in self.special.items()}
        self.cut_any = regex.compile(self.CUT).findall
        plain = self.CUT.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{self.LETTERS}{self.NUMBERS}]").replace(r"\p{L}", f"[{self.LETTERS}]").replace(r"\p{N}", f"[{self.NUMBERS}]")
        self.cut_plain = re.compile(plain).findall
        self.is_plain = re.compile(self.PLAIN).fullmatch
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None
        self.cache: dict[str, tuple[int, ...]] = {}

    def cut(self, text: str) -> list[str]:
        return self.cut_plain(text) if self.is_plain(text) else self.cut_any(text)

    def _new(self, word: str) -> tuple[int, ...]:
        byte_ids = self.byte_ids
        return tuple(merge([byte_ids[b] for b in word.encode()], self.pairs))

    def _words(self, words: list[str]) -> list[int]:
        cache = self.cache
        try:
            return list(chain.from_iterable(map(cache.__getitem__, words)))
        except KeyError:
            if len(cache) >= CACHE:
                cache.clear()
            long_ones = {}
            for word in words:
                if word not in cache:
                    (cache if len(word) <= CACHED_LENGTH else long_ones)[word] = self._new(word)
            return [i for w in words for i in (cache.get(w) or long_ones[w])]

    def encode(self, text: str) -> list[int]:
        """The ids of ``text``; strings of special tokens become these tokens."""
        parts = self.split_special(text) if self.split_special else [text]
        out = self._words(self.cut(parts[0]))
        for k, part in enumerate(parts[1:]):
            if k % 2:
                out += self._words(self.cut(part))
            else:
                out.append(self.special[part])
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``, special tokens included; broken UTF-8 is replaced."""
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(4)
def loaded(path: str) -> ByteBPE:
    return ByteBPE(path)


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>`` for each row of ``docs``, in no order.

    A null or empty text has no ids. Each row is encoded by itself, so repeated
    rows and ids repeat. Other columns aren't read. An empty table gives none.
    """

    def run(batches):
        bpe = loaded(vocabulary)
        for b in batches:
            ids = [bpe.encode(t) if t else [] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema[0].dataType.simpleString()}, ids array<int>")


def decode(rows: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` for each row; null ids give the empty text."""

    def run(batches):
        bpe = loaded(vocabulary)
        for b in batches:
            texts = [bpe.decode(x) if x else "" for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = rows.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"doc_id {rows.schema[0].dataType.simpleString()}, text string")


def encode_decode_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` in one pass: what ``encode`` then ``decode`` give.

    The ids of a text never leave its task, so this moves nothing. Nulls and
    repeated rows as in ``encode``.
    """

    def run(batches):
        bpe = loaded(vocabulary)
        number = [str(i) for i in range(max(bpe.token_bytes) + 1)].__getitem__
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for t in b.column(1):
                ids = bpe.encode(t.as_py() or "")
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(number, ids)).encode()).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema[0].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
