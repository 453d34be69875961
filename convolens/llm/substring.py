"""Removal of long repeated word runs by recompression.

Words get content hashes as names. A round names runs of equal symbols and then pairs of neighbours, a pair being
joined where the hash of the left name falls on one side and that of the right name on the other. Names are hashes of
what they stand for, so they are global: every task gives equal words equal symbols and no round has to shuffle.
Every symbol carries its reach, the stretch of words that decided about it. Wherever the same words cover a reach,
there is the same symbol; so two equal windows of words hold the same interior symbols.

A window's key is the least symbol of the highest level whose reach lies inside the window (a single word always
does), hashed over its reach. Equal windows have equal keys, so only windows whose key is shared by two documents can
repeat; about one key in fifteen words is shuffled, and windows themselves only where a key is shared. Those windows
are verified by 128-bit hashes of all their words, and the smallest document of each is found.

A task looks at a text in stretches of bounded length, which overlap by a window, so very long texts cost time, not
memory. Documents with equal word sequences (the same SHA-256 of their words) are settled first: only the smallest goes on.

Null texts have no words. Rows without a doc_id keep their words unless a row with an id has the same ones; they
are nobody's earlier document. Repeated rows are judged alike. Empty tables give empty results. Extra columns are
ignored. Hot keys and hot windows are pre-aggregated and attached without gathering them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convolens.llm.common import attach, materialise, within

#: Words of a window; the longest symbol that each round still joins.
WINDOW, ROUNDS = 50, (1, 2, 4)
#: Words in one numpy pass, bytes of text split into words at once, and rows looked at together: what bounds a task's memory.
BATCH, PIECE, ROWS = 131_072, 1 << 20, 512
SPACE = re.compile(rb"[\x20\x09-\x0D]")

U = np.uint64
_A, _B, _C = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * _B
    x = (x ^ (x >> U(27))) * _C
    return x ^ (x >> U(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i below n."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        m = 1 << (n - 1).bit_length()
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            x = np.full(m, U(b))
            x[0] = U(1)
            both.append(np.multiply.accumulate(x))
        _POWERS[base] = tuple(both)
    return tuple(x[:n] for x in _POWERS[base])


class Hashes:
    """Hashes of any stretch of a sequence of names."""

    def __init__(self, names: np.ndarray, base: int):
        up, self.down = _powers(base, len(names) + 1)
        self.sums = np.zeros(len(names) + 1, U)
        np.cumsum(names * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start])


BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)


def word_names(words: list[bytes]) -> np.ndarray:
    """Two 64-bit names a word, none of them zero."""
    from xxhash import xxh3_128_digest

    return np.frombuffer(b"".join(map(xxh3_128_digest, words)), "<u8").reshape(-1, 2) | U(1)


class Symbols:
    """A sequence of symbols: where each begins and ends, its name, and its reach from low to high."""

    def __init__(self, start, end, name, low, high):
        self.start, self.end, self.name, self.low, self.high = start, end, name, low, high

    def _open(self, longest: int) -> np.ndarray:
        return (self.name != 0) & (self.end - self.start <= longest)

    def runs(self, longest: int, salt: int) -> Symbols:
        """Joins maximal runs of equal symbols of at most twice `longest` words."""
        open_ = self._open(longest)
        equal = np.r_[False, (self.name[1:] == self.name[:-1]) & open_[1:] & open_[:-1]]
        first = np.flatnonzero(~equal)
        size = np.diff(first, append=len(equal))
        last = first + size - 1
        low, high = np.minimum.reduceat(self.low, first), np.maximum.reduceat(self.high, first)
        asks = open_[first]  # the others join nothing, whatever stands beside them
        before, after = np.maximum(first - 1, 0), np.minimum(last + 1, len(equal) - 1)
        low = np.where(asks, np.minimum(low, np.minimum(self.low[before], self.low[after])), low)
        high = np.where(asks, np.maximum(high, np.maximum(self.high[before], self.high[after])), high)
        whole = (size > 1) & (self.end[last] - self.start[first] <= 2 * longest)
        keep = np.repeat(~whole, size)
        keep[first] = True
        group = np.repeat(np.arange(len(first)), size)[keep]
        joined = whole[group]
        name = np.where(joined, _mix(self.name[keep] * _A + size[group].astype(U) + U(salt)) | U(1), self.name[keep])
        return Symbols(self.start[keep], np.where(joined, self.end[last][group], self.end[keep]), name, low[group], high[group])

    def pairs(self, longest: int, salt: int) -> Symbols:
        """Joins each open symbol of the left kind with an open one of the right kind after it."""
        open_ = self._open(longest)
        right = (_mix(self.name + U(salt * int(_A) % 2**64)) >> U(63)) == 1
        joins = np.r_[open_[:-1] & ~right[:-1] & open_[1:] & right[1:], False]
        joined = np.r_[False, joins[:-1]]
        # an open symbol looks at the neighbour that it could have joined
        beside = np.clip(np.arange(len(right)) + np.where(right, -1, 1), 0, len(right) - 1)
        low = np.where(open_, np.minimum(self.low, self.low[beside]), self.low)
        high = np.where(open_, np.maximum(self.high, self.high[beside]), self.high)
        keep = np.flatnonzero(~joined)
        two = joins[keep]
        next_ = np.minimum(keep + 1, len(right) - 1)
        name = np.where(two, _mix(self.name[keep] * _A + self.name[next_] * _B + U(salt)) | U(1), self.name[keep])
        # the halves of a pair look at each other, so both reaches are that of the pair
        return Symbols(self.start[keep], np.where(two, self.end[next_], self.end[keep]), name, low[keep], high[keep])


def window_keys(names: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The key of the window that starts at each word. names: of words, 0 at the seams between documents.

    A key's top bits hold the level (0 for the highest), so the least key is that of the highest level.
    """
    n = len(names)
    at = np.arange(n, dtype=np.int32)
    hashes = Hashes(names, BASES[0])
    top = (window - 1).bit_length()
    least = [np.full(n, U(2**64 - 1)) for _ in range(top)]
    x = Symbols(at, at + 1, names, at, at + 1)
    for level in range(len(ROUNDS) + 1):
        if level:
            x = x.runs(ROUNDS[level - 1], 2 * level - 1).pairs(ROUNDS[level - 1], 2 * level)
        fits = (x.high - x.low <= window) & (x.name != 0)
        low, high = x.low[fits], x.high[fits]
        key = (hashes.of(low, high) >> U(2)) | (U(len(ROUNDS) - level) << U(62))
        start, end = np.maximum(high - window, 0), low + 1  # windows that hold the reach
        power = np.frexp((end - start).astype(np.float64))[1] - 1
        for p in range(top):
            of = power == p
            np.minimum.at(least[p], start[of], key[of])
            np.minimum.at(least[p], end[of] - (1 << p), key[of])
    for p in range(top - 1, 0, -1):
        half = 1 << (p - 1)
        np.minimum(least[p - 1], least[p], out=least[p - 1])
        np.minimum(least[p - 1][half:], least[p][:-half], out=least[p - 1][half:])
    return least[0]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _pieces(text: str | None) -> Iterator[list[bytes]]:
    """The text's words in order, in lists from about PIECE bytes of text each."""
    data = memoryview((text or "").encode())
    at = 0
    while at < len(data):
        space = SPACE.search(data, at + PIECE)
        end = space.start() if space else len(data)
        yield bytes(data[at:end]).split()
        at = end


def stretches(text: str | None) -> Iterator[tuple[int, list[bytes]]]:
    """Stretches of the text's words that overlap by a window less one word, each with the number of its first word.

    Every window lies in exactly one stretch, and its key depends on its own words only.
    """
    first, held = 0, []
    for words in _pieces(text):
        held += words
        if len(held) >= WINDOW:
            yield first, held
            first, held = first + len(held) - WINDOW + 1, held[len(held) - WINDOW + 1 :]


class Batch:
    """Some stretches of words in one sequence, with a seam after each."""

    def __init__(self, parts: list[list[bytes]]):
        self.sizes = [len(x) for x in parts]
        two = np.zeros((sum(self.sizes) + len(parts) + 1, 2), U)
        at = 1
        self.starts = []
        for words in parts:
            self.starts.append(at)
            if words:
                two[at : at + len(words)] = word_names(words)
            at += len(words) + 1
        self.names = two

    def keys(self) -> list[np.ndarray]:
        """The window keys of each stretch; none for one shorter than a window."""
        keys = window_keys(np.ascontiguousarray(self.names[:, 0]))
        return [keys[a : a + max(0, n - WINDOW + 1)] for a, n in zip(self.starts, self.sizes, strict=True)]

    def windows(self, starts: np.ndarray) -> np.ndarray:
        """128-bit hashes of the windows at these places of the sequence."""
        out = np.empty((len(starts), 2), U)
        for i in (0, 1):
            out[:, i] = Hashes(np.ascontiguousarray(self.names[:, i]), BASES[i]).of(starts, starts + WINDOW)
        return out


def _batched(texts: Iterator[tuple[int, str | None]]) -> Iterator[list[tuple[int, int, list[bytes]]]]:
    """Stretches of numbered texts (number, first word, words) in lists of about BATCH words."""
    held, size = [], 0
    for i, text in texts:
        for first, words in stretches(text):
            held.append((i, first, words))
            size += len(words)
            if size >= BATCH:
                yield held
                held, size = [], 0
    if held:
        yield held


def _rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, ROWS):
        yield batch.slice(at, ROWS)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text -> doc_id, n_words, sha, anchors (the distinct keys of the text's windows)."""
    for whole in batches:
        for batch in _rows(whole):
            texts = batch.column(1)
            n_words, shas = [], []
            anchors: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
            for text in texts:
                sha, n = hashlib.sha256(), 0
                for words in _pieces(text.as_py()):
                    if words:
                        sha.update(b" " * (n > 0) + b" ".join(words))
                        n += len(words)
                n_words.append(n)
                shas.append(sha.hexdigest())
            for part in _batched((i, texts[i].as_py()) for i, n in enumerate(n_words) if n >= WINDOW):
                for (i, _, _), keys in zip(part, Batch([x[2] for x in part]).keys(), strict=True):
                    anchors[i].append(np.unique(keys))
            merged = [np.unique(np.concatenate(x)).view(np.int64) if x else np.empty(0, np.int64) for x in anchors]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(shas, pa.string()), pa.array(merged, pa.list_(pa.int64()))], names=["doc_id", "n_words", "sha", "anchors"])


def _sha(text: str | None) -> str:
    sha, some = hashlib.sha256(), False
    for words in _pieces(text):
        if words:
            sha.update(b" " * some + b" ".join(words))
            some = True
    return sha.hexdigest()


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text, tag, shared -> window, doc_id, tag, at: every window whose key is shared."""
    for whole in batches:
        for batch in _rows(whole):
            ids, texts, tags = batch.column(0), batch.column(1), batch.column(2)
            shared = [x.values.to_numpy().view(U) for x in batch.column(3)]
            right = ((i, text) for i, text in ((i, texts[i].as_py()) for i in range(batch.num_rows)) if tag(_sha(text)) == tags[i].as_py())
            for part in _batched(right):
                own = Batch([x[2] for x in part])
                for (i, first, _), start, keys in zip(part, own.starts, own.keys(), strict=True):
                    at = np.flatnonzero(np.isin(keys, shared[i]))
                    for a in range(0, len(at), BATCH):
                        some = at[a : a + BATCH]
                        window = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(some), [None, pa.py_buffer(own.windows(start + some))]).cast(pa.binary())
                        same = pa.array(np.full(len(some), i))
                        yield pa.RecordBatch.from_arrays([window, ids.take(same), tags.take(same), pa.array((first + some).astype(np.int64))], names=["window", "doc_id", "tag", "at"])


def tag(sha: str) -> int:
    """The first 64 bits of a digest as a signed long: tells the texts of one doc_id apart."""
    return int(np.uint64(int(sha[:16], 16)).view(np.int64))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text, tag, starts -> doc_id, tag, n_removed, kept_sha: the text without the words of the windows at `starts`."""
    for whole in batches:
        for batch in _rows(whole):
            right, n_removed, shas = [], [], []
            for i, (text, own, starts) in enumerate(zip(*batch.columns[1:], strict=True)):
                if tag(_sha(text.as_py())) == own.as_py():
                    removed, sha = cut_words(text.as_py(), np.sort(starts.values.to_numpy()))
                    right.append(i)
                    n_removed.append(removed)
                    shas.append(sha)
            same = pa.array(right, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(same), batch.column(2).take(same), pa.array(n_removed, pa.int64()), pa.array(shas, pa.string())], names=["doc_id", "tag", "n_removed", "kept_sha"])


def cut_words(text: str | None, starts: np.ndarray) -> tuple[int, str]:
    """The number of words in the windows at the sorted `starts`, and the digest of all other words."""
    sha, some, at, removed = hashlib.sha256(), False, 0, 0
    for words in _pieces(text):
        place = np.arange(at, at + len(words))
        last = np.searchsorted(starts, place, "right") - 1  # the window that starts here or last before
        gone = (last >= 0) & (place - starts[np.maximum(last, 0)] < WINDOW) if len(starts) else np.zeros(len(words), bool)
        kept = [w for w, x in zip(words, gone.tolist(), strict=True) if not x]
        if kept:
            sha.update(b" " * some + b" ".join(kept))
            some = True
        removed += int(gone.sum())
        at += len(words)
    return removed, sha.hexdigest()


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(every row: doc_id, n_words, sha, tag, first; repeated windows by word sequence: tag, doc_id, starts).

    first is the smallest doc_id of the same word sequence. starts are the places of the windows that also start in a
    document with a smaller doc_id than first; sequences without any have no row.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    read = materialise(rows.mapInArrow(_read, f"doc_id {kind}, n_words long, sha string, anchors array<long>"), "anchors")
    n = read.count()
    firsts = read.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    base = materialise(attach(read, firsts, "sha", n, "n").withColumns({"anchors": F.when(F.col("doc_id") == F.col("first"), F.col("anchors")), "tag": _tag("sha")}), "firsts")
    keys = base.where("anchors is not null").select("doc_id", "tag", F.explode("anchors").alias("key"))
    shared = keys.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("n")).where("low < high").select("key", "n")
    shared = materialise(shared, "shared-keys")
    of_doc = attach(keys, shared, "key", keys.count(), "n").groupBy("doc_id", "tag").agg(F.collect_set("key").alias("shared"))
    of_doc = materialise(of_doc, "keys-of-documents")
    suspects = within(rows, of_doc.select("doc_id").distinct(), "doc_id")
    windows = materialise(suspects.join(of_doc, "doc_id").select("doc_id", "text", "tag", "shared").mapInArrow(_emit, f"window binary, doc_id {kind}, tag long, at long"), "windows")
    least = windows.groupBy("window").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count(F.lit(1)).alias("n")).where("least < most").drop("most")
    later = attach(windows, materialise(least, "least"), "window", windows.count(), "n").where("doc_id > least")
    return base.select("doc_id", "n_words", "sha", "tag", "first"), later.groupBy("tag", "doc_id").agg(F.collect_set("at").alias("starts"))


def _tag(sha: str) -> Column:
    """`tag` of a column of digests."""
    high, low = (F.conv(F.substring(sha, at, 8), 16, 10).cast("long") for at in (1, 9))
    return F.shiftleft(high, 32).bitwiseOR(low)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of docs."""
    base, starts = repeats(docs, doc_id, text)
    starts = materialise(starts, "starts")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    suspects = within(rows, starts.select("doc_id").distinct(), "doc_id")
    kind = rows.schema["doc_id"].dataType.simpleString()
    cut = suspects.join(starts, "doc_id").select("doc_id", "text", "tag", "starts").mapInArrow(_cut, f"doc_id {kind}, tag long, n_removed long, kept_sha string")
    cut = materialise(cut.groupBy(F.col("doc_id").alias("first"), "tag").agg(F.first("n_removed").alias("n_removed"), F.first("kept_sha").alias("kept_sha")), "cut")
    copy = F.coalesce((F.col("n_words") >= WINDOW) & (F.col("doc_id") > F.col("first")), F.lit(False))
    gone = base.where(copy).select("doc_id", "n_words", F.col("n_words").alias("n_removed"), F.sha2(F.lit(""), 256).alias("kept_sha256"))
    rest = base.where(~copy).join(cut, ["first", "tag"], "left")
    return gone.unionByName(rest.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("kept_sha", "sha").alias("kept_sha256")))
