"""Byte-level BPE: encode with merge ranks, decode by vocabulary strings.

A text is cut at the added tokens' strings, then by the tokenizer's pattern
into pieces.  In a piece the symbols (at first one per UTF-8 byte) form a
doubly linked list; adjacent pairs that can merge wait in a priority queue
ordered by (rank, position).  An entry whose symbols have changed since it
was queued is stale and skipped.  Pieces repeat a lot, so each Python worker keeps a
bounded memory of those it has encoded, from one task to the next.

The vocabulary file is read once on the driver (its path is a parameter) and
broadcast; its size is that of the file, whatever the data.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The pattern by which byte-level BPE vocabularies cut text, and
# what it comes to on text of ASCII characters only.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ASCII_PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"""

REMEMBERED_PIECES = 150_000  # of the last ones, and as many at most of those before
REMEMBERED_LENGTH = 64
ROWS = 500  # texts whose tokens are held at once


def byte_letters() -> list[str]:
    """The character that stands for each byte in the vocabulary's strings:
    printable Latin-1 bytes stand for themselves, the others follow from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in printable}
    for n, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + n)
    return [letters[b] for b in range(256)]


class ByteBPE:
    """A vocabulary in the tokenizers library's JSON form (byte-level BPE)."""

    def __init__(self, spec: str) -> None:
        tree = json.loads(spec)
        model, pre = tree["model"], tree["pre_tokenizer"] or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or tree["normalizer"]:
            raise ValueError("only byte-level BPE without a normalizer or prefix space is supported")
        added = tree["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens that strip or match single words are not supported")
        self.vocab: dict[str, int] = model["vocab"]
        self.letters = byte_letters()
        self.byte_ids = [self.vocab[c] for c in self.letters]
        self.width = max(self.vocab.values()) + 1
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {self.vocab[a] * self.width + self.vocab[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.merged = [self.vocab[a + b] for a, b in pairs]
        self.added = {t["content"]: t["id"] for t in added}
        byte_of = {c: b for b, c in enumerate(self.letters)}
        self.strings = {i: bytes(byte_of[c] for c in s) for s, i in self.vocab.items()}
        self.strings |= {i: s.encode() for s, i in self.added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        self.pieces = regex.compile(PIECES)
        self.ascii_pieces = re.compile(ASCII_PIECES, re.ASCII)
        self.known: dict[str, list[int]] = {}
        self.before: dict[str, list[int]] = {}

    def merge(self, piece: str) -> list[int]:
        """Token ids of one piece."""
        ids, width, rank_of = [self.byte_ids[b] for b in piece.encode()], self.width, self.ranks.get
        n = len(ids)
        if n == 1:
            return ids
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        # rank[i]: of the pair that begins at i now; -1 if it has none. A queue
        # entry is rank * n + i, so that entries order by rank, then position.
        rank = [rank_of(a * width + b, -1) for a, b in zip(ids, ids[1:], strict=False)]
        rank.append(-1)
        queue = [r * n + i for i, r in enumerate(rank) if r >= 0]
        heapq.heapify(queue)
        while queue:
            r, i = divmod(heapq.heappop(queue), n)
            if rank[i] != r:
                continue  # stale: one of its symbols has merged otherwise since
            j = after[i]
            ids[i], ids[j], rank[j] = self.merged[r], -1, -1
            k = after[i] = after[j]
            rank[i] = -1
            if k < n:
                before[k] = i
                if (r := rank_of(ids[i] * width + ids[k], -1)) >= 0:
                    rank[i] = r
                    heapq.heappush(queue, r * n + i)
            if (h := before[i]) >= 0:
                rank[h] = r = rank_of(ids[h] * width + ids[i], -1)
                if r >= 0:
                    heapq.heappush(queue, r * n + h)
        return [t for t in ids if t >= 0]

    def _encode_plain(self, text: str, out: list[int]) -> None:
        known, before = self.known, self.before
        for piece in (self.ascii_pieces if text.isascii() else self.pieces).findall(text):
            ids = known.get(piece)
            if ids is None:
                ids = before.get(piece) or self.merge(piece)
                if len(piece) <= REMEMBERED_LENGTH:
                    if len(known) >= REMEMBERED_PIECES:
                        known, before = {}, known
                        self.known, self.before = known, before
                    known[piece] = ids
            out += ids

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        if self.cut is None:
            self._encode_plain(text, out)
            return out
        for k, part in enumerate(self.cut.split(text)):
            if k % 2:
                out.append(self.added[part])
            elif part:
                self._encode_plain(part, out)
        return out

    def decode(self, ids: list[int]) -> str:
        """Ids outside the vocabulary are left out."""
        strings = self.strings
        return b"".join([strings.get(i, b"") for i in ids]).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def loaded(spec: str) -> ByteBPE:
    """One for all tasks of a Python worker."""
    return ByteBPE(spec)


def _shared(df: DataFrame, path: str) -> Broadcast[str]:
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _by_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            yield batch.slice(i, ROWS)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``df`` with ``ids array<int>``, the token ids of column ``text``, and, if
    a name is given, ``decoded``, the string that these ids stand for.

    A null or empty text has no tokens and decodes to ''.  Columns already
    named so are replaced; all other columns and repeated rows stay; whole
    texts are encoded.  An empty table gives an empty result.
    """
    spec = _shared(df, path)
    added = [ids] if decoded is None else [ids, decoded]
    kept = [f for f in df.schema.fields if f.name not in added]
    names = [f.name for f in kept]
    fields = [*kept, T.StructField(ids, T.ArrayType(T.IntegerType())), *(T.StructField(c, T.StringType()) for c in added[1:])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(spec.value)
        for batch in _by_rows(batches):
            ends, flat, texts = [0], array("i"), []
            for t in batch.column(text):
                found = bpe.encode(t.as_py() or "")
                flat.extend(found)
                ends.append(len(flat))
                if decoded is not None:
                    texts.append(bpe.decode(found))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32) if flat else [], pa.int32()))
            new = [lists] if decoded is None else [lists, pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *new], [*names, *added])

    return df.mapInArrow(run, T.StructType(fields))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with ``text``, the string its token ids stand for ('' for null).

    Bytes that are no UTF-8 become U+FFFD.  Other columns stay as they are; a
    column already named ``text`` is replaced.
    """
    spec = _shared(df, path)
    kept = [f for f in df.schema.fields if f.name != text]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(spec.value)
        for batch in _by_rows(batches):
            texts = [bpe.decode(v.as_py() or []) for v in batch.column(ids)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(texts, pa.string())], [*names, text])

    return df.mapInArrow(run, T.StructType([*kept, T.StructField(text, T.StringType())]))


def digests(df: DataFrame, path: str) -> DataFrame:
    """Per document of ``documents``: token count, digest of the ids, digest of
    the text decoded from them."""
    coded = encode(df.select("doc_id", "text"), path, decoded="decoded").drop("text")
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
