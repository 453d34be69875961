"""One JSON document of any size, read by many tasks and cut into its users.

Spark's text reader cuts the file into blocks and each block at every closing brace. Where a block begins, inside a
string or not and how deep, follows from the blocks before: each task counts the quotes of its block, and its brackets
for either case, and prefix sums over the blocks give every block its start. Then each task walks its own block: a
user is an object in the list under `users` (or another root), so it ends where a piece ends. Users that lie in one
block are done there; only the ends of a block, two pieces at most, are shuffled and joined.

Nothing passes through the driver, and memory is that of one user and one batch of pieces. Elements of the list that
are no objects come out as they are, for `conversation_log.damage` to count. Blocks must be cut alike in both reads,
so `spark.sql.files.maxPartitionBytes` must not change between them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from convolens.operators.stages import settle

ROOTS = ("users", "analysis_results", "data")
ESCAPE = re.compile(r"\\.", re.DOTALL)
TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]:,]|[^\s{}\[\]:,"]+', re.DOTALL)
#: Depth of the list of users, where the root object is 1 deep.
LIST = 2


def _net(parts: list[str]) -> int:
    text = "".join(parts)
    return text.count("{") + text.count("[") - text.count("}") - text.count("]")


def _counts(piece: str) -> tuple[int, int, int]:
    """Quotes, and the change of depth if the piece begins outside or inside of a string."""
    parts = ESCAPE.sub("", piece).split('"')
    return len(parts) - 1, _net(parts[::2]), _net(parts[1::2])


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """file, block, quotes, outside, inside of every run of rows of one block."""
    held, out = None, []
    for batch in batches:
        for value, file, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held is None or held[:2] != [file, block]:
                out += [held] if held else []
                held = [file, block, 0, 0, 0]
            quotes, even, odd = _counts(value + "}")
            swap = held[2] % 2
            held[2:] = held[2] + quotes, held[3] + (odd if swap else even), held[4] + (even if swap else odd)
    out += [held] if held else []
    yield pa.RecordBatch.from_pylist([dict(zip(("file", "block", "quotes", "outside", "inside"), x, strict=True)) for x in out], schema=pa.schema([("file", pa.string()), ("block", pa.int64()), ("quotes", pa.int64()), ("outside", pa.int64()), ("inside", pa.int64())]))


class _Walk:
    """Through the pieces of one block, from its start."""

    def __init__(self, file: str, block: int, inside: bool, depth: int):
        self.file, self.block, self.inside, self.depth = file, block, inside, depth
        self.root: str | None = None if depth >= LIST else ""  # the list that is open; none: as the block before ended
        self.key, self.users, self.open = "", 0, depth > LIST
        self.parts: list[str] = []

    def piece(self, text: str) -> list[tuple]:
        """Users and parts of users that end with this piece: user number in the block, begun here, ended here, root, text."""
        if self.depth > LIST or self.inside:
            quotes, even, odd = _counts(text)
            self.depth += odd if self.inside else even
            self.inside ^= quotes % 2 == 1
            self.parts += [text] if self.open else []
            return self._close() if self.open and self.depth <= LIST else []
        out, last = [], ""
        for token in TOKEN.finditer(text):
            t = token.group()
            if t == ":":
                self.key = last.strip('"') if self.depth == 1 else self.key
            elif t in "{[":
                self.depth += 1
                if self.depth == LIST:
                    self.root = self.key if t == "[" else ""
                elif self.depth == LIST + 1 and t == "{" and self.root != "":
                    rest = text[token.start() :]
                    quotes, even, _ = _counts(rest)
                    self.depth, self.inside = self.depth - 1 + even, quotes % 2 == 1
                    self.users, self.open, self.parts, self.begun = self.users + 1, True, [rest], True
                    return out + (self._close() if self.depth <= LIST else [])
            elif t in "}]":
                self.depth -= 1
                self.root = "" if self.depth < LIST else self.root
            elif t == '"':  # a string that goes on behind this piece
                self.inside = True
                return out
            elif t != "," and self.depth == LIST and self.root != "":
                self.users += 1
                out.append((self.users, True, True, self.root, t))
            last = t
        if ESCAPE.sub("", text).count('"') % 2:
            self.inside = True
        return out

    begun = False

    def _close(self, ended: bool = True) -> list[tuple]:
        out = [(self.users, self.begun, ended, self.root, "".join(self.parts))] if self.parts else []
        self.open, self.parts, self.begun = False, [], False
        return out

    def end(self) -> list[tuple]:
        """What is left open, and a last row that tells how the block ended."""
        return [*self._close(False), (self.users, None, None, self.root, None)]


OUT = "file string, block long, user long, begun boolean, ended boolean, root string, text string"


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    walk: _Walk | None = None
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("user", pa.int64()), ("begun", pa.bool_()), ("ended", pa.bool_()), ("root", pa.string()), ("text", pa.string())])

    def rows(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, (walk.file, walk.block, *x), strict=True)) for x in found], schema=schema)

    for batch in batches:
        found: list[tuple] = []
        for value, file, block, inside, depth in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if walk is None or (walk.file, walk.block) != (file, block):
                if walk is not None:
                    yield rows(found + walk.end())
                    found = []
                walk = _Walk(file, block, inside, depth)
            found += walk.piece(value + "}")
        if found:
            yield rows(found)
    if walk is not None:
        yield rows(walk.end())


def users(spark: SparkSession, path: str) -> DataFrame:
    """place (of the user: file, number) and value (JSON text) of every user of the documents under a path."""
    pieces = spark.read.option("lineSep", "}").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = pieces.mapInArrow(_summaries, "file string, block long, quotes long, outside long, inside long")
    blocks = sums.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"), F.sum("outside").alias("outside"), F.sum("inside").alias("inside"))
    starts = blocks.withColumn("start_inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    starts = starts.withColumn("start_depth", F.coalesce(F.sum(F.when(F.col("start_inside"), F.col("inside")).otherwise(F.col("outside"))).over(before), F.lit(0)).cast("int"))
    # a few numbers for each block of maxPartitionBytes, so they can be broadcast; the pieces stay in their order
    starts = settle(starts.select("file", "block", "start_inside", "start_depth"))
    walked = settle(pieces.join(F.broadcast(starts), ["file", "block"]).select("value", "file", "block", "start_inside", "start_depth").mapInArrow(_walks, OUT))
    ends = walked.where("ended is null").select("file", "block", F.coalesce(F.sum("user").over(before), F.lit(0)).alias("earlier"), F.last("root", True).over(before).alias("inherited"))
    placed = walked.where("ended is not null").join(F.broadcast(ends), ["file", "block"])
    placed = placed.select(F.struct("file", (F.col("earlier") + F.col("user")).alias("number")).alias("place"), "block", "begun", "ended", F.coalesce("root", "inherited").alias("root"), "text").where(F.col("root").isin(*ROOTS))
    whole = placed.where("begun and ended").select("place", F.col("text").alias("value"))
    parts = placed.where("not (begun and ended)").groupBy("place").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("parts"))
    return whole.unionByName(parts.select("place", F.array_join(F.col("parts.text"), "").alias("value")))
