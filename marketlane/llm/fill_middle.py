"""Fill-in-the-middle: documents cut in three and put in another order.

Cuts are drawn in code points, texts are bytes. A sparse index of a batch of texts
holds its multibyte characters alone: where each one stands and how many bytes beyond
one it and those before it take. A binary search in it turns a place in code points into
one in bytes or back; between two such characters, and in plain ASCII texts throughout,
the two run in step and the rest is addition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from marketlane.llm.common import fresh_name, raw_bytes, slices, without

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


@dataclass(frozen=True)
class ByteIndex:
    """Multibyte characters of UTF-8 bytes: their places, and excess bytes up to each."""

    points: np.ndarray
    bytes: np.ndarray
    excess: np.ndarray
    size: int

    @staticmethod
    def of(data: np.ndarray) -> ByteIndex:
        lead = np.flatnonzero(data >= 0xC0)
        first = data[lead]
        own = 1 + (first >= 0xE0).astype(np.int64) + (first >= 0xF0)
        excess = np.cumsum(own)
        return ByteIndex(lead - (excess - own), lead, np.append(0, excess), len(data))

    def to_bytes(self, points: np.ndarray) -> np.ndarray:
        """Where the given numbers of code points end."""
        return points + self.excess[np.searchsorted(self.points, points)]

    def to_points(self, places: np.ndarray) -> np.ndarray:
        """Code points before byte places that begin or end one."""
        return places - self.excess[np.searchsorted(self.bytes, places)]


@dataclass(frozen=True)
class Rates:
    """Per cent of rows that stay plain, and of the others that put the suffix first."""

    plain: int = 10
    suffix_first: int = 20
    seed: int = 1


def _draws(seeds: list[str | None], rates: Rates) -> np.ndarray:
    """Four 32-bit numbers a row, from a hash of the seed and the row's key."""
    made = [hashlib.sha256(f"{rates.seed}:{s or ''}".encode()).digest()[:16] for s in seeds]
    return np.frombuffer(b"".join(made), dtype=">u4").reshape(-1, 4).astype(np.int64)


_FIELDS = [
    StructField("n", LongType()), StructField("form", StringType()), StructField("prefix_chars", LongType()),
    StructField("middle_chars", LongType()), StructField("prefix_bytes", LongType()),
    StructField("middle_bytes", LongType()), StructField("output", StringType()),
]


def _transformed(texts: pa.Array, seeds: list[str | None], rates: Rates) -> list[pa.Array]:
    data, rows = raw_bytes(texts)
    index, whole = ByteIndex.of(data), data.tobytes()
    begin = index.to_points(rows)
    n = np.diff(begin)
    h = _draws(seeds, rates)
    cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    places = index.to_bytes(begin[:-1, None] + cuts)
    form, output = [], []
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks
    for i in range(len(n)):
        a, b = rows[i], rows[i + 1]
        if a == b or h[i, 2] % 100 >= 100 - rates.plain or any(whole.find(x, a, b) >= 0 for x in marks):
            form.append("plain")
            output.append(whole[a:b])
            continue
        u, v = places[i]
        prefix, middle, suffix = whole[a:u], whole[u:v], whole[v:b]
        if h[i, 3] % 100 < rates.suffix_first:
            form.append("spm")
            output.append(b"".join([s, suffix, p, prefix, m, middle]))
        else:
            form.append("psm")
            output.append(b"".join([p, prefix, s, suffix, m, middle]))
    plain = np.array([f == "plain" for f in form], dtype=bool)
    told = [cuts[:, 0], cuts[:, 1] - cuts[:, 0], places[:, 0] - rows[:-1], places[:, 1] - places[:, 0]]
    return [
        pa.array(n), pa.array(form, pa.string()), *(pa.array(t, pa.int64(), mask=plain) for t in told),
        pa.array(output, pa.binary()).cast(pa.string()),
    ]


def transformed(
    docs: DataFrame,
    rates: Rates | None = None,
    key: str = "doc_id",
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """All rows and columns (or ``keep`` of them) plus ``n, form, prefix_chars, middle_chars, prefix_bytes,
    middle_bytes, output``; columns already called so are replaced.

    What a row draws depends on its key alone, so repeated rows and reruns agree; a null
    key draws as an empty one. Null and empty texts, texts that hold one of the marks and
    the share that stays plain have form ``plain``, no cuts and themselves as output. A
    text is handled whole, in some six times its bytes.
    """
    rates = rates or Rates()
    docs = without(docs, [f.name for f in _FIELDS if f.name not in (key, text)])
    clash = {f.name for f in _FIELDS} & {key.lower(), text.lower()}
    if clash:
        raise ValueError(f"key and text may not be called {sorted(clash)}")
    kept = docs.columns if keep is None else keep
    read = list(dict.fromkeys([*kept, text]))
    seed = fresh_name(docs, "_seed")
    source = docs.select(*[f"`{c}`" for c in read], F.col(key).cast("string").alias(seed))
    at = read.index(text)
    schema = StructType([*(docs.schema[c] for c in kept), *_FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column(at)):
                part = batch.slice(start, stop - start)
                texts = pc.fill_null(part.column(at).cast(pa.large_string()), "")
                made = _transformed(texts, part.column(len(read)).to_pylist(), rates)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *made], names=schema.names)

    return source.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form was made from; the marks cannot be in it."""
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    prefix = F.when(form == "psm", parts[1]).otherwise(parts[2])
    suffix = F.when(form == "psm", parts[2]).otherwise(parts[1])
    return F.when(form == "plain", output).otherwise(F.concat(prefix, parts[3], suffix))


def digest(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: its form and cuts, and hashes of the output and of the text rebuilt from it."""
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    made = transformed(source, keep=["doc_id"])
    back = restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"), "prefix_bytes", "middle_bytes",
    )


DIGEST_SQL = """
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS hex
    FROM documents
), numbers AS (
    SELECT doc_id, text, n,
        ('0x' || substr(hex, 1, 8))::BIGINT % (n + 1) AS c1, ('0x' || substr(hex, 9, 8))::BIGINT % (n + 1) AS c2,
        ('0x' || substr(hex, 17, 8))::BIGINT % 100 AS c3, ('0x' || substr(hex, 25, 8))::BIGINT % 100 AS c4
    FROM drawn
), formed AS (
    SELECT doc_id, text, n, least(c1, c2) AS lo, greatest(c1, c2) AS hi,
        CASE WHEN n = 0 OR c3 >= 90 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
             WHEN c4 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM numbers
), parts AS (
    SELECT *, substr(text, 1, lo) AS prefix, substr(text, lo + 1, hi - lo) AS middle, substr(text, hi + 1) AS suffix FROM formed
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN lo END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text
        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256,
    CASE WHEN form <> 'plain' THEN strlen(prefix) END AS prefix_bytes,
    CASE WHEN form <> 'plain' THEN strlen(middle) END AS middle_bytes
FROM parts
"""
