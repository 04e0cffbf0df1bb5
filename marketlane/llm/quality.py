"""Quality scores by nearest-neighbour voting in a latent-semantic space.

A text is its byte trigrams, hashed to ``features`` columns and weighted by
``log(1 + count) * idf``; case and punctuation count, since they tell shouting, markup
and word lists from prose. One more column holds the root of the share of words that
repeat the word before, which trigrams cannot tell from prose. Document frequencies are taken over all documents. A
randomised singular value decomposition of the labelled sample's rows gives the latent
axes. Every document is compared with every labelled vector by exact blocked products,
and the labels of its nearest ones vote with their similarity. The sample, and with it
everything that is broadcast, is bounded by ``per_label``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField

from marketlane.llm.common import fresh_name, hashed_words, raw_bytes, slices, with_text_columns, without


@dataclass(frozen=True)
class Voting:
    features: int = 4096
    axes: int = 64
    per_label: int = 2000
    neighbours: int = 25
    seed: int = 7


def counts(texts: pa.Array, features: int) -> np.ndarray:
    """Trigram counts, rows x features. Texts of one or two bytes have none."""
    data, rows = raw_bytes(texts)
    n, out = len(rows) - 1, np.zeros((len(rows) - 1, features), dtype=np.float32)
    if len(data) < 3:
        return out
    wide = data.astype(np.uint32)
    code = wide[:-2] * np.uint32(0x9E3779B1) + wide[1:-1] * np.uint32(0x85EBCA77) + wide[2:] * np.uint32(0xC2B2AE3D)
    code = ((code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(8)
    column = (code % np.uint32(features)).astype(np.int64)
    for i in range(n):
        start, stop = rows[i], rows[i + 1] - 2
        if stop > start:
            out[i] = np.bincount(column[start:stop], minlength=features)
    return out


def repeats(texts: pa.Array) -> np.ndarray:
    """Root of the share of words equal to the word before them in the same row."""
    words, at = hashed_words(texts)
    again = np.zeros(len(words) + 1)
    again[1:-1] = words[1:] == words[:-1]
    again[at[:-1]] = 0
    running = np.concatenate([[0.0], np.cumsum(again[:-1])])
    return np.sqrt((running[at[1:]] - running[at[:-1]]) / np.maximum(np.diff(at), 1)).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Bounded by the parameters: features x axes and 2 x per_label x axes numbers."""

    voting: Voting
    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray

    def latent(self, texts: pa.Array) -> np.ndarray:
        rows = _weighted(counts(texts, self.voting.features), repeats(texts), self.idf)
        return _unit(rows @ self.axes)

    def score(self, texts: pa.Array) -> np.ndarray:
        """Share of the neighbours' weight that label 1 has; 0 for texts with no trigram."""
        out = np.zeros(len(texts))
        if not len(self.vectors):
            return out
        places = self.latent(texts)
        k = min(self.voting.neighbours, len(self.vectors))
        near = places @ self.vectors.T
        best = np.argpartition(-near, k - 1, axis=1)[:, :k]
        close = np.take_along_axis(near, best, axis=1).astype(np.float64)
        vote = np.maximum(close, 0.0) ** 4 * self.weights[best]
        whole = vote.sum(axis=1)
        told = whole > 0
        out[told] = (vote * self.labels[best]).sum(axis=1)[told] / whole[told]
        return np.round(out, 9)


def _weighted(tf: np.ndarray, again: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return np.concatenate([_unit(np.log1p(tf) * idf), again[:, None]], axis=1)


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return (x / np.maximum(length, 1e-12)).astype(np.float32)


def frequencies(docs: DataFrame, text: str, voting: Voting) -> tuple[np.ndarray, int]:
    """Documents that have each feature, and all documents: one row per feature and task."""
    features, source = voting.features, docs.select(text)

    def run(batches):
        seen, rows = np.zeros(features, dtype=np.int64), 0
        for batch in batches:
            for start, stop in slices(batch.column(0)):
                texts = batch.column(0).slice(start, stop - start).fill_null("")
                seen += (counts(texts, features) > 0).sum(axis=0)
                rows += stop - start
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(features + 1)), pa.array(np.append(seen, rows))],
            names=["feature", "n"],
        )

    sums = source.mapInArrow(run, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n"))
    out = np.zeros(features + 1, dtype=np.int64)
    for feature, n in sums.collect():  # as many rows as features
        out[feature] = n
    return out[:-1], int(out[-1])


def labelled_sample(labels: DataFrame, voting: Voting, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """At most ``per_label`` keys of each label, by a hash of the key, and how many stand behind each.

    A key with contradicting labels teaches nothing.
    """
    clean = (
        labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1))
        .select(F.col(key).alias("_key"), F.col(label).alias("_label"))
        .groupBy("_key")
        .agg(F.min("_label").alias("_label"), F.max("_label").alias("_other"))
        .filter("_label = _other")
        .select("_key", "_label")
    )
    order = [F.xxhash64("_key", F.lit(voting.seed)), F.col("_key")]
    parts = []
    for value in (0, 1):
        own = clean.filter(F.col("_label") == value)
        parts.append(own.orderBy(*order).limit(voting.per_label))
    sizes = {r[0]: r[1] for r in clean.groupBy("_label").count().collect()}
    weight = F.when(F.col("_label") == 0, F.lit(float(sizes.get(0, 0)))).otherwise(float(sizes.get(1, 0)))
    return parts[0].unionByName(parts[1]).withColumn("_behind", weight)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    voting: Voting | None = None,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> Model:
    """Learns from the rows of ``labels`` alone; which those may be is the caller's choice.

    A null text counts as empty. Of several texts with one key the least teaches, so the
    model does not depend on partitions or on repeated rows; a key with contradicting
    labels, or none, teaches nothing. Without labelled texts every score is 0. A text is
    counted whole, in some 50 times its bytes.
    """
    voting = voting or Voting()
    seen, total = frequencies(docs, text, voting)
    idf = np.log((1.0 + total) / (1.0 + seen)).astype(np.float32) + 1.0
    features = voting.features

    sample = labelled_sample(labels, voting, key, label)
    picked = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    # Bounded: two labels, per_label keys each.
    taught = picked.join(F.broadcast(sample), "_key").groupBy("_key", "_label", "_behind").agg(F.min("_text").alias("_text"))
    fields = [StructField("_columns", BinaryType()), StructField("_counts", BinaryType()), StructField("_again", DoubleType())]
    taught = with_text_columns(taught, "_text", lambda texts: _sparse(texts, features), fields, ["_key", "_label", "_behind"])
    rows = sorted(taught.collect())
    y = np.array([r["_label"] for r in rows], dtype=np.float64)
    if not rows:
        empty = np.zeros((0, voting.axes), dtype=np.float32)
        axes = np.zeros((features + 1, voting.axes), dtype=np.float32)
        return Model(voting, idf, axes, empty, y, y)
    behind = np.array([r["_behind"] for r in rows])
    a = _matrix(rows, idf)
    del rows
    axes = _right_axes(a, voting)
    share = np.array([max(1, int((y == v).sum())) for v in y])
    return Model(voting, idf, axes, _unit(a @ axes), y, behind / share)


def _sparse(texts: pa.Array, features: int) -> list[pa.Array]:
    """Columns and counts of each text's trigrams, as 16-bit numbers, and its repeats."""
    columns, numbers = [], []
    for tf in counts(texts, features):
        at = np.flatnonzero(tf)
        columns.append(at.astype(np.uint16).tobytes())
        numbers.append(np.minimum(tf[at], 65535).astype(np.uint16).tobytes())
    return [pa.array(columns, pa.binary()), pa.array(numbers, pa.binary()), pa.array(repeats(texts).astype(np.float64))]


def _matrix(rows: list, idf: np.ndarray) -> np.ndarray:
    """Weighted rows of the sample, filled in place: the one large array of the driver."""
    a = np.zeros((len(rows), len(idf) + 1), dtype=np.float32)
    for out, row in zip(a, rows, strict=True):
        at = np.frombuffer(row["_columns"], dtype=np.uint16)
        own = np.log1p(np.frombuffer(row["_counts"], dtype=np.uint16).astype(np.float32)) * idf[at]
        out[at] = own / max(np.sqrt((own * own).sum()), 1e-12)
        out[-1] = row["_again"]
    return a


def _right_axes(a: np.ndarray, voting: Voting) -> np.ndarray:
    """Leading right singular vectors of the sample, by a random start and two power steps."""
    rng = np.random.default_rng(voting.seed)
    k = min(voting.axes, *a.shape)
    y = a @ rng.standard_normal((a.shape[1], k + 8)).astype(np.float32)
    for _ in range(2):
        q, _ = np.linalg.qr(y)
        y = a @ (a.T @ q)
    q, _ = np.linalg.qr(y)
    _, _, vt = np.linalg.svd(q.T @ a, full_matrices=False)
    return np.ascontiguousarray(vt[:k].T).astype(np.float32)


def scored(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """All rows and columns plus the score, 0 for null, empty and one or two byte texts.

    A column already called so is replaced; repeated rows are scored each, and alike.
    """
    docs = without(docs, [score])
    return with_text_columns(docs, text, lambda texts: [model.score(texts)], [StructField(score, DoubleType())])


def keep_good(docs: DataFrame, model: Model, text: str = "text", least: float = 0.7) -> DataFrame:
    """The rows whose score is at least ``least``; columns stay as they are. Rows with a null
    or empty text score 0 and go; of repeated rows all stay or all go."""
    name = fresh_name(docs, "_score")
    return scored(docs, model, text, name).filter(F.col(name) >= least).drop(name)


def held_out(key: str = "doc_id"):
    """Rows kept for measuring: crc32 of the key as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))
