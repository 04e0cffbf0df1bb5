"""Concatenate and cut: documents as one stream of tokens, cut into fixed windows.

The first pass encodes every document and writes its token ids with the number of the
partition it was in and its place there. Sums of the partitions' totals, taken in two
levels, then give each partition's place in the whole stream, so that a document's
windows follow by arithmetic. The second pass reads the ids in the order they were
written: windows that lie wholly in what a task reads are cut out of its ids as they
are; of the others each task gives its share as a boundary record, and only these, two
for each run of rows, are shuffled and joined. Only the last window may be short.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    LongType,
    StructField,
    StructType,
)
from tokenizers import Tokenizer

from marketlane.llm.common import scratch, slices, stored, stored_counted
from marketlane.llm.token_counts import PRE_TOKENS, Vocabulary

#: Partitions whose places are summed together in the first level.
GROUP = 1024
#: Rows of (partition, place), 16 bytes each, up to which they are broadcast.
MOST_BROADCAST = 1 << 20

_SEGMENT = 1 << 16


@dataclass(frozen=True)
class Cutting:
    """Sequences of ``width`` tokens; ``end`` closes each document, ``pad`` fills up the last one."""

    width: int = 2048
    end: int = 1
    pad: int = 0


# --- encoding --------------------------------------------------------------------------


@dataclass(frozen=True)
class TokenFile:
    """A tokenizer file, and its tokens as ranks where it is a plain byte-level BPE."""

    content: str
    digest: str
    ranks: dict[bytes, int] | None
    specials: tuple[str, ...]

    @staticmethod
    def read(path: str) -> TokenFile:
        content = Path(path).read_text(encoding="utf-8")
        digest = hashlib.sha256(content.encode()).hexdigest()
        try:
            told = Vocabulary.load(path)
        except ValueError:
            return TokenFile(content, digest, None, ())
        made = [told.tokens.get(a + b, -1) for a, b in sorted(told.merges, key=told.merges.get)]
        tokens = {t: i for t, i in told.tokens.items() if t.decode("utf-8", "replace") not in told.specials}
        # Ranks decide as the merges do if the merges made the tokens in the order of their ids.
        ordered = all(0 <= a < b for a, b in pairwise(made)) and len(tokens) == len(made) + 256
        return TokenFile(content, digest, tokens if ordered else None, told.specials)


class Encoder:
    """Token ids as the tokenizers library gives them for a file, without added special tokens.

    Plain byte-level BPE goes by ranks, which gives the same ids at a fifth of the time,
    for texts up to U+024F, where all Unicode versions cut alike, in segments that end
    before white space after a letter or digit, where no token can cross. The library
    itself encodes other texts, those with special strings, runs of letters longer than a
    segment, and whole texts for other kinds of files.
    """

    _break = regex.compile(r"(?<=[0-9A-Za-z])(?=[ \n])")
    _wide = regex.compile("[^\x00-\u024f]")

    def __init__(self, file: TokenFile):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_str(file.content)
        self.ranked = None
        if file.ranks:
            self.ranked = tiktoken.Encoding(file.digest, pat_str=PRE_TOKENS, mergeable_ranks=file.ranks, special_tokens={})
        self.special = regex.compile("|".join(map(regex.escape, file.specials))) if file.specials else None

    def _encoded(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _segments(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > _SEGMENT:
            hit = self._break.search(text, start + _SEGMENT)
            if not hit:
                break
            yield text[start : hit.start()]
            start = hit.start()
        yield text[start:]

    def ids(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if self.ranked is None or (self.special and self.special.search(text)):
            return self._encoded(text)
        out = []
        for part in self._segments(text):
            if len(part) > 2 * _SEGMENT or self._wide.search(part):
                out.append(self._encoded(part))
            else:
                out.append(array("I", self.ranked.encode_ordinary(part)).tobytes())
        return b"".join(out)


_encoders: dict[str, Encoder] = {}


def _encoder(file: TokenFile) -> Encoder:
    """One per Python worker and file."""
    if file.digest not in _encoders:
        _encoders[file.digest] = Encoder(file)
    return _encoders[file.digest]


def encoded(docs: DataFrame, path: str, cutting: Cutting, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids, doc_tokens, part, place``: each row's ids with the closing one.

    ``part`` is the partition the row was in, ``place`` the tokens before it there. Null
    and empty texts have the closing id alone. Only a stored copy may be used twice.
    """
    file = TokenFile.read(path)
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    closing = np.array([cutting.end], dtype="<u4").tobytes()
    schema = StructType([
        source.schema["doc_id"], StructField("ids", BinaryType()), StructField("doc_tokens", LongType()),
        StructField("part", LongType()), StructField("place", LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(file)
        part, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start, stop in slices(batch.column(1)):
                rows = batch.slice(start, stop - start)
                ids = [encoder.ids(t) + closing if t else closing for t in rows.column(1).to_pylist()]
                n = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
                ends = done + np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(ids, pa.binary()), pa.array(n),
                     pa.array(np.full(len(n), part, dtype=np.int64)), pa.array(ends - n)],
                    names=schema.names,
                )
                done = int(ends[-1])

    return source.mapInArrow(run, schema)


# --- places ----------------------------------------------------------------------------


def partition_places(tokens: DataFrame) -> DataFrame:
    """``part, base``: tokens of all partitions before each one, by prefix sums in two levels.

    A task sums the partitions of one group; the groups' totals, a thousandth of the
    partitions' number, are summed by one.
    """
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("n")).withColumn("wide", F.floor(F.col("part") / GROUP))
    before = lambda window: F.coalesce(F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inner = totals.withColumn("own", before(Window.partitionBy("wide").orderBy("part")))
    groups = totals.groupBy("wide").agg(F.sum("n").alias("n"))
    outer = groups.select("wide", before(Window.orderBy("wide")).alias("base"))
    return inner.join(outer, "wide").select("part", (F.col("base") + F.col("own")).alias("base"))


# --- windows ---------------------------------------------------------------------------

_PIECE = ["doc_id", "start", "length", "doc_tokens", "offset"]


@dataclass
class _Run:
    """Rows that follow each other in the stream: their ids, and their pieces by window."""

    ids: np.ndarray
    begin: int
    keys: pa.Array
    pieces: np.ndarray  # columns start, length, doc_tokens, offset, window

    @staticmethod
    def of(keys: pa.Array, at: np.ndarray, n: np.ndarray, ids: np.ndarray, width: int) -> _Run:
        first, last = at // width, (at + n - 1) // width
        many = last - first + 1
        row = np.repeat(np.arange(len(at)), many)
        window = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        low = np.maximum(at[row], window * width)
        high = np.minimum((at + n)[row], (window + 1) * width)
        pieces = np.stack([low - at[row], high - low, n[row], low - window * width, window], axis=1)
        return _Run(ids, int(at[0]), keys.take(pa.array(row)), pieces)

    @property
    def end(self) -> int:
        return self.begin + len(self.ids) // 4

    def then(self, other: _Run) -> _Run:
        keys = pa.concat_arrays([self.keys, other.keys])
        return _Run(np.concatenate([self.ids, other.ids]), self.begin, keys, np.concatenate([self.pieces, other.pieces]))

    def part(self, low: int, high: int, width: int) -> _Run:
        """The stream's tokens from ``low`` to ``high``, both ends of windows or of the run."""
        a, b = np.searchsorted(self.pieces[:, 4], [low // width, -(-high // width)])
        ids = self.ids[4 * (low - self.begin) : 4 * (high - self.begin)]
        return _Run(ids, low, self.keys.slice(a, b - a), self.pieces[a:b])

    def batch(self, width: int, names: list[str]) -> pa.RecordBatch:
        """One row for each window of this part."""
        windows, at = np.unique(self.pieces[:, 4], return_index=True)
        cuts = np.clip(np.append(windows, windows[-1] + 1) * width, self.begin, self.end) - self.begin
        data = pa.py_buffer(np.ascontiguousarray(self.ids))
        ids = pa.Array.from_buffers(pa.binary(), len(windows), [None, pa.py_buffer((4 * cuts).astype(np.int32)), data])
        columns = [self.keys, *(pa.array(np.ascontiguousarray(self.pieces[:, i])) for i in range(4))]
        rows = pa.StructArray.from_arrays(columns, names=_PIECE)
        ends = pa.array(np.append(at, len(self.pieces)).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(windows), pa.array(self.pieces[at, 3]), ids, pa.ListArray.from_arrays(ends, rows)], names=names
        )


def _cut(tokens: DataFrame, width: int, whole: bool) -> DataFrame:
    """Whole windows of the rows as they are read, or else the boundary records.

    ``sequence_id, at, ids, pieces``; ``at`` is where in the window the record begins.
    """
    piece = StructType([tokens.schema["doc_id"], *(StructField(n, LongType()) for n in _PIECE[1:])])
    schema = StructType([
        StructField("sequence_id", LongType()), StructField("at", LongType()), StructField("ids", BinaryType()),
        StructField("pieces", ArrayType(piece)),
    ])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: _Run | None = None
        for batch in batches:
            for start, stop in slices(batch.column(1)):
                rows = batch.slice(start, stop - start)
                at, n = (rows.column(i).to_numpy() for i in (2, 3))
                # Rows that do not follow the one before open a new run.
                heads = np.flatnonzero(np.append(True, at[1:] != at[:-1] + n[:-1]))
                for a, b in zip(heads, np.append(heads[1:], len(at)), strict=True):
                    column = rows.column(1).slice(a, b - a)
                    _, offsets, data = column.buffers()
                    ends = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + len(column) + 1]
                    ids = np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]]
                    now = _Run.of(rows.column(0).slice(a, b - a), at[a:b], n[a:b], ids, width)
                    if open_ is not None and open_.end != now.begin:
                        if not whole:
                            yield open_.batch(width, names)
                        open_ = None
                    now = now if open_ is None else open_.then(now)
                    # head | whole windows | tail, each possibly empty
                    first, last = -(-now.begin // width) * width, now.end // width * width
                    if first > last:
                        open_ = now
                        continue
                    if now.begin < first and not whole:
                        yield now.part(now.begin, first, width).batch(width, names)
                    if first < last and whole:
                        yield now.part(first, last, width).batch(width, names)
                    open_ = now.part(last, now.end, width) if last < now.end else None
        if open_ is not None and not whole:
            yield open_.batch(width, names)

    return tokens.select("doc_id", "ids", "at", "doc_tokens").mapInArrow(run, schema)


def sequences(docs: DataFrame, path: str, cutting: Cutting | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``sequence_id, n_tokens, ids, pieces``: all rows' tokens as padded sequences.

    ``ids`` are little-endian unsigned 32-bit numbers; ``pieces`` say, from left to
    right, which part of which row stands where. Sequences are numbered from 0 without
    gaps; all are full but perhaps the last, which is padded to ``width`` unless its
    length is a power of two. A row with a null or empty text is its closing id; rows
    with the same key, or none, are packed each for itself; no rows give no sequences.
    A long text is encoded in segments; its ids, up to four bytes for each byte of text,
    pass as one value, so a text may have some 500 MB. Other columns are not read.
    """
    cutting = cutting or Cutting()
    width, spark = cutting.width, docs.sparkSession
    with scratch(spark) as keep:
        tokens = keep(stored(encoded(docs, path, cutting, key, text), "tokens"))
        places, count = stored_counted(partition_places(tokens), "places")
        keep(places)
    if count <= MOST_BROADCAST:
        placed = tokens.join(F.broadcast(places), "part")
    else:
        placed = tokens.join(places, "part").sortWithinPartitions("part", "place")
    placed = placed.withColumn("at", F.col("base") + F.col("place"))
    shares = F.array_sort(F.collect_list(F.struct("at", "ids", "pieces")))
    joined = _cut(placed, width, False).groupBy("sequence_id").agg(shares.alias("shares"))
    joined = joined.select(
        "sequence_id",
        F.unhex(F.array_join(F.transform("shares", lambda s: F.hex(s["ids"])), "")).alias("ids"),
        F.flatten(F.transform("shares", lambda s: s["pieces"])).alias("pieces"),
    )
    out = _cut(placed, width, True).select("sequence_id", "ids", "pieces").unionByName(joined)
    length = F.octet_length("ids") / 4
    return out.select("sequence_id", length.cast("bigint").alias("n_tokens"), _padded(cutting).alias("ids"), "pieces")


def _padded(cutting: Cutting) -> Column:
    pad = F.lit(np.array([cutting.pad], dtype="<u4").tobytes())
    size = F.octet_length("ids")
    short = (size < 4 * cutting.width) & (F.bit_count(size) != 1)
    return F.when(short, F.rpad("ids", 4 * cutting.width, pad)).otherwise(F.col("ids"))


def pieces(packed: DataFrame) -> DataFrame:
    """One row for each piece of ``sequences``, with the checksum of its ids there."""
    rows = packed.select("sequence_id", "ids", F.explode("pieces").alias("p"))
    own = F.substring("ids", (F.col("p.offset") * 4 + 1).cast("int"), (F.col("p.length") * 4).cast("int"))
    return rows.select(
        "p.doc_id", "p.start", "p.length", F.crc32(own).alias("ids_crc32"), "p.doc_tokens", "sequence_id", "p.offset"
    )
