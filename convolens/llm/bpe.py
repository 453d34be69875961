"""Byte-level BPE over a balanced reduction tree.

Encoding is a monoid: a node holds the tokens of its stretch of text, and two neighbours join by re-encoding only a
window around the seam. The window grows until both of its ends are stable, that is until
  * the end is a cut of the pre-tokenizer whatever stands around it: between a visible ASCII character and a blank or
    line feed no pattern match can continue, and no match looks back; or
  * the window meets the end of the node.
Tokens outside a window with stable ends are the tokens of the whole, so they are kept. Where a stretch has no white
space at all, the window grows to the whole stretch, so the result is exact for every text.

Decoding concatenates the tokens' bytes up a tree of the same shape.

Null texts are empty. Repeated rows are encoded each, empty tables give empty results, extra columns are ignored. A very
long text is one task's, in memory of its own size; one without white space is encoded anew at every seam. The
tokenizer's file is a parameter; each Python worker loads it once.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Code points of a leaf, and of the first window on either side of a seam.
LEAF, WINDOW = 512, 64


class Codec:
    """A vocabulary of ranks with the tree-shaped encoder and decoder."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import tiktoken

        self.leaf = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.piece = dict(zip(ranks.values(), ranks.keys(), strict=True))
        self.decimal = {i: str(i) for i in self.piece}

    def encode(self, text: str, leaf: int = LEAF, window: int = WINDOW) -> list[int]:
        return self._node(text, 0, len(text), leaf, window)

    def _node(self, text: str, start: int, end: int, leaf: int, window: int) -> list[int]:
        if end - start <= leaf:
            return self.leaf(text[start:end])
        middle = (start + end) // 2
        return self._join(text, start, middle, end, self._node(text, start, middle, leaf, window), self._node(text, middle, end, leaf, window), window)

    def _join(self, text: str, start: int, middle: int, end: int, left: list[int], right: list[int], window: int) -> list[int]:
        """The tokens of text[start:end] from those of its halves."""
        a = b = None
        while a is None or b is None:
            if a is None:
                a = _last_cut(text, max(start, middle - window), middle, start)
            if b is None:
                b = _first_cut(text, middle, min(end, middle + window), end)
            window *= 4
        keep = len(left) - self._covering(reversed(left), len(text[a:middle].encode()))
        skip = self._covering(right, len(text[middle:b].encode()))
        return left[:keep] + self.leaf(text[a:b]) + right[skip:]

    def _covering(self, tokens, size: int) -> int:
        """How many of the tokens make up exactly `size` bytes."""
        n = 0
        for token in tokens:
            if size <= 0:
                break
            size -= len(self.piece[token])
            n += 1
        assert size == 0, "a stable cut falls inside a token"
        return n

    def decode(self, ids: list[int], leaf: int = LEAF) -> bytes:
        if len(ids) <= leaf:
            return b"".join(map(self.piece.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle], leaf) + self.decode(ids[middle:], leaf)

    def spell(self, ids: list[int]) -> str:
        return " ".join(map(self.decimal.__getitem__, ids))


def _stable(text: str, i: int) -> bool:
    return text[i] in " \n" and "!" <= text[i - 1] <= "~"


def _last_cut(text: str, low: int, middle: int, start: int) -> int | None:
    """The last stable cut in text[low:middle], or the node's start once the window reaches it."""
    for i in range(middle, max(low, start + 1) - 1, -1):
        if 0 < i < len(text) and _stable(text, i):
            return i
    return start if low == start else None


def _first_cut(text: str, middle: int, high: int, end: int) -> int | None:
    for i in range(middle, min(high, end - 1) + 1):
        if 0 < i < len(text) and _stable(text, i):
            return i
    return end if high == end else None


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(read_ranks(path), pattern)


def _over_texts(docs: DataFrame, doc_id: str, text: str, schema: str, row, path: str, pattern: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), *row(own, part.column(1))], names=names)

    names = [x.split()[0] for x in schema.split(", ")]
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema[0].dataType.simpleString()}, {schema.partition(', ')[2]}")


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the text's token ids, as an array of int."""

    def row(own: Codec, texts) -> list[pa.Array]:
        return [pa.array([own.encode(x or "") for x in texts.to_pylist()], pa.list_(pa.int32()))]

    return _over_texts(docs, doc_id, text, "doc_id -, ids array<int>", row, path, pattern)


def digests(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes every text and decodes the ids again."""

    def row(own: Codec, texts) -> list[pa.Array]:
        n, ids_sha, decoded_sha = [], [], []
        for x in texts.to_pylist():
            ids = own.encode(x or "")
            n.append(len(ids))
            ids_sha.append(hashlib.sha256(own.spell(ids).encode()).hexdigest())
            decoded_sha.append(hashlib.sha256(own.decode(ids)).hexdigest())
        return [pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(decoded_sha)]

    return _over_texts(docs, doc_id, text, "doc_id -, n_tokens bigint, ids_sha256 string, decoded_sha256 string", row, path, pattern)
