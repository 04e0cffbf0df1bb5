"""Helpers the operators share: tables, stored intermediates, Arrow maps, hashed words."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from marketlane.session import fresh_folder
from marketlane.sources.tables import delete_path

#: Text and rows handled at once inside a Python task; a longer text is handled alone.
CHUNK_BYTES = 1 << 19
CHUNK_ROWS = 1024

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Rows of a small table that one file and one task take.
ROWS_PER_FILE = 100_000


def stored(frame: DataFrame, label: str, most: int | None = None) -> DataFrame:
    """The frame written once to the shared folder and read back.

    Cuts the lineage: a lost executor costs a reread, and what was drawn or
    numbered before stays as it was. ``most``, a bound on the rows of a frame whose
    last step reads little more than it gives, keeps small tables in few files.
    """
    return stored_counted(frame, label, most)[0]


def stored_counted(frame: DataFrame, label: str, most: int | None = None) -> tuple[DataFrame, int]:
    """``stored``, and the number of rows."""
    spark, seen = frame.sparkSession, Observation()
    path = fresh_folder(spark, label)
    schema = frame.schema
    if most is not None:
        frame = frame.coalesce(most // ROWS_PER_FILE + 1)
    frame.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out.stored_at = path
    open_ = _scratch.get()
    if open_ is not None:
        open_.append(path)
    return out, int(seen.get["rows"] or 0)


#: Paths stored in the innermost ``scratch`` of this thread or task.
_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables stored inside are removed at the end, but for those passed to the function
    this gives: what is returned must rest on those alone. Each thread has its own."""
    outer = _scratch.get()
    paths: list[str] = []
    kept: list[str] = []

    def keep(frame: DataFrame) -> DataFrame:
        kept.append(frame.stored_at)
        return frame

    before = _scratch.set(paths)
    try:
        yield keep
    finally:
        _scratch.reset(before)
        if outer is not None:
            outer.extend(kept)
        for path in set(paths) - set(kept):
            delete_path(spark, path)


def fresh_name(frame: DataFrame, wish: str) -> str:
    """A column name the frame does not have yet (Spark ignores case)."""
    taken = {c.lower() for c in frame.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def without(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """The frame without columns of these names, in any case."""
    gone = {n.lower() for n in names}
    keep = [c for c in frame.columns if c.lower() not in gone]
    return frame.select(*[f"`{c}`" for c in keep])


def slices(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column that hold about ``most`` bytes and ``CHUNK_ROWS`` rows at most."""
    if len(texts) == 0:
        return
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start, n = 0, len(sizes)
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        stop = min(stop, start + CHUNK_ROWS, n)
        yield start, stop
        start = stop


def with_text_columns(
    frame: DataFrame,
    text: str,
    compute: Callable[[pa.Array], list],
    fields: Sequence[StructField],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The frame's columns (or ``keep`` of them) plus columns computed from its texts.

    ``compute`` gets the texts of some rows (nulls as empty) and returns one array
    per field. Rows pass in slices of bounded size; order and number stay.
    """
    names = list(frame.columns if keep is None else keep)
    columns = list(dict.fromkeys([*names, text]))
    source = frame.select(*[f"`{c}`" for c in columns])
    schema = StructType([*[frame.schema[c] for c in names], *fields])
    at = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column(at)):
                part = batch.slice(start, stop - start)
                texts = pc.fill_null(part.column(at).cast(pa.large_string()), "")
                made = compute(texts)
                made = [m if isinstance(m, pa.Array) else pa.array(m) for m in made]
                kept = [part.column(i) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=schema.names)
            # A worker that waits for its next task keeps no more than it must.
            pa.default_memory_pool().release_unused()

    return source.mapInArrow(run, schema)


# --- words ---------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_WORD_BYTE = np.zeros(256, dtype=bool)
for _c in b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ_":
    _WORD_BYTE[_c] = True
_WORD_BYTE[128:] = True

_powers: dict[str, np.ndarray] = {}


def _power_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i modulo 2**64 for i below ``size``; grown when a text is longer."""
    have = _powers.get("p")
    if have is None or len(have) < size:
        n = max(size, CHUNK_BYTES + 1)
        inverse = pow(_MULTIPLIER, -1, 1 << 64)
        for key, base in (("p", _MULTIPLIER), ("q", inverse)):
            out = np.ones(n, dtype=np.uint64)
            filled, step = 1, base
            while filled < n:  # doubling: P**(i+filled) = P**i * P**filled
                more = min(filled, n - filled)
                out[filled : filled + more] = out[:more] * np.uint64(step)
                filled, step = filled + more, step * step & _MASK
            _powers[key] = out
    return _powers["p"], _powers["q"]


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and where each row starts and ends in them."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or at[-1] == at[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all lower-cased words, and where each row's words start.

    A word is a run of ASCII letters, digits and underscores and of non-ASCII
    characters. A word's hash is a polynomial of its bytes, got for all words at
    once from one running sum over the column.
    """
    data, rows = raw_bytes(pc.utf8_lower(texts))
    n = len(data)
    if n == 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(rows), dtype=np.int64)
    inside = np.zeros(n + 1, dtype=bool)
    inside[:n] = _WORD_BYTE[data]
    before = np.zeros(n + 1, dtype=bool)
    before[1:] = inside[:n]
    # A word never crosses rows: at a row's start nothing precedes.
    cut = rows[1:-1]
    starts_mask = inside & ~before
    ends_mask = before & ~inside
    joined = cut[inside[cut] & before[cut]]
    starts_mask[joined] = True
    ends_mask[joined] = True
    starts, ends = np.flatnonzero(starts_mask), np.flatnonzero(ends_mask)
    power, inverse = _power_table(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
    return hashes, np.searchsorted(starts, rows).astype(np.int64)


def word_hash(words: Sequence[str]) -> np.ndarray:
    """The same hashes for single words."""
    return hashed_words(pa.array(list(words), type=pa.large_string()))[0]
