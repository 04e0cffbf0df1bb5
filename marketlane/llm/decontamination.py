"""Benchmark decontamination by latent semantic retrieval and word alignment.

The benchmark is the query set: it is taken in blocks of ``block`` items (fewer if they
are long: a block ends with the item that brings it to ``block`` stretches), each of which
meets all documents. The columns of the vector space are the words of the block; other
words bear on no item. Passages are tiles of ``tile`` words; a term weighs
``log(passages / passages with it)`` over all documents, and terms in more than
``stop_share`` of all passages have no column (they still count in the alignment).

A randomised singular value decomposition of the passages, to which the items are added
with the same total weight, runs as two passes of ``A'A`` over the stored terms; tasks
send sums of bounded size. An item is cut into even stretches no longer than a window of
two tiles; a stretch's latent image is its projection on the leading axes. Every window
whose cosine with an image reaches ``cosine`` is a candidate for the whole item.

A candidate is decided by the longest common subsequence of the item and the text around
the window: it leaks if ``verbatim`` of the item's words align in order, or if
``paraphrase`` do and half of the answer's words align too. The answer is the benchmark's
answer column or, without one, the last quarter of the item.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from marketlane.llm.common import fresh_name, hashed_words, scratch, stored, with_text_columns, without

MATCH = StructType(
    [
        StructField("item_id", LongType()),
        StructField("first_word", IntegerType()),
        StructField("last_word", IntegerType()),
        StructField("cosine", DoubleType()),
        StructField("aligned", DoubleType()),
        StructField("answer", DoubleType()),
    ]
)


@dataclass(frozen=True)
class Retrieval:
    block: int = 200
    least_words: int = 5
    tile: int = 32
    stop_share: float = 0.05
    axes: int = 256
    oversampling: int = 16
    cosine: float = 0.25
    verbatim: float = 0.8
    paraphrase: float = 0.6
    answer: float = 0.5
    seed: int = 11

    def stretches(self, words: int) -> int:
        return -(-words // (2 * self.tile))


@dataclass(frozen=True)
class Items:
    """One block of the benchmark: ids, words as numbers from 1, and the answers' words."""

    ids: list[int]
    vocabulary: np.ndarray
    words: list[np.ndarray]
    answers: list[np.ndarray]

    def terms(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words (0: not in the benchmark) and where rows start."""
        hashes, at = hashed_words(texts)
        return self.numbers(hashes), at

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        shift, first, most = self._places
        start, last = first[hashes >> shift], len(self.vocabulary) - 1
        out = np.zeros(len(hashes), dtype=np.uint32)
        for j in range(most):
            where = np.minimum(start + j, last)
            out = np.where(self.vocabulary[where] == hashes, where + 1, out)
        return out.astype(np.uint32)

    @cached_property
    def _places(self) -> tuple[np.uint64, np.ndarray, int]:
        """For the leading bits of a hash, where such words start, and how many share them."""
        bits = min(20, max(8, (16 * len(self.vocabulary)).bit_length()))
        shift = np.uint64(64 - bits)
        first = np.searchsorted(self.vocabulary, np.arange(1 << bits, dtype=np.uint64) << shift)
        most = np.bincount((self.vocabulary >> shift).astype(np.int64)).max()
        return shift, first.astype(np.int32), int(most)


def blocks(benchmark: DataFrame, retrieval: Retrieval, item: str, text: str, answer: str | None) -> Iterator[Items]:
    """Items in blocks of ``block`` stretches, one at a time on the driver.

    Items with a null id or fewer than ``least_words`` words are left out: so few words
    occur in ordinary text. Repeated rows count once.
    """
    column = F.col(answer) if answer else F.lit(None).cast("string")
    rows = benchmark.select(
        F.col(item).cast("bigint").alias("item"), F.col(text).alias("text"), column.alias("answer")
    ).filter("item IS NOT NULL AND text IS NOT NULL").distinct().orderBy("item", "text", "answer")
    held: list[tuple[int, np.ndarray, np.ndarray | None]] = []
    stretches = 0
    for row in rows.toLocalIterator():
        words = hashed_words(pa.array([row["text"]]))[0]
        if len(words) < retrieval.least_words:
            continue
        end = hashed_words(pa.array([row["answer"]]))[0] if row["answer"] else words[-(-len(words) * 3 // 4) :]
        held.append((row["item"], words, end))
        stretches += retrieval.stretches(len(words))
        if stretches >= retrieval.block:
            yield _items(held)
            held, stretches = [], 0
    if held:
        yield _items(held)


def _items(held: list[tuple]) -> Items:
    vocabulary = np.unique(np.concatenate([np.concatenate([w, a]) for _, w, a in held]))
    block = Items([i for i, _, _ in held], vocabulary, [], [])
    block.words.extend(block.numbers(w) for _, w, _ in held)
    block.answers.extend(block.numbers(a) for _, _, a in held)
    return block


def _tiles(terms: np.ndarray, at: np.ndarray, weight: np.ndarray, tile: int):
    """Distinct (tile, term) pairs with weight, tiles numbered over the slice, and where
    each row's tiles start."""
    counts = np.diff(at)
    tiles = -(-counts // tile)
    base = np.concatenate([[0], np.cumsum(tiles)])
    heavy = np.flatnonzero((weight > 0)[terms])
    shift = np.repeat(base[:-1] * tile - at[:-1], counts)
    size = np.int64(len(weight))
    pairs = (heavy + shift[heavy]) // tile * size + terms[heavy]
    pairs.sort()
    pairs = pairs[_first_of_run(pairs)]
    number = pairs // size
    return number, pairs - number * size, base


def _first_of_run(values: np.ndarray) -> np.ndarray:
    first = np.ones(len(values), dtype=bool)
    first[1:] = values[1:] != values[:-1]
    return first


def _norms(tile: np.ndarray, values: np.ndarray, tiles: int) -> np.ndarray:
    return np.bincount(tile, weights=values * values, minlength=tiles)


def _add_products(out: np.ndarray, group: np.ndarray, index: np.ndarray, value: np.ndarray, matrix: np.ndarray) -> None:
    """out[group] += value * matrix[index], groups ascending; in pieces that stay in cache.

    Runs of a group are cut to ``most`` rows, and runs of one length are multiplied at once;
    pieces of ``most`` rows, the only ones that can share a group, go one by one.
    """
    most, first = 512, _first_of_run(group)
    run = np.flatnonzero(first)
    place = np.arange(len(group)) - np.repeat(run, np.diff(run, append=len(group)))
    starts = np.flatnonzero(place % most == 0)
    lengths = np.diff(starts, append=len(group))
    for length in np.unique(lengths).tolist():
        own = starts[lengths == length]
        step = max(1, most // length)
        for at in range(0, len(own), step):
            some = own[at : at + step]
            rows = some[:, None] + np.arange(length)
            out[group[some]] += np.matmul(value[rows][:, None, :], matrix[index[rows]])[:, 0]


#: Words up to which a task sums A'A itself, 64 MB; beyond, it sums products with A and A'.
DENSE_WORDS = 4096


class _Gram:
    """A'A times some vectors over the passages added so far, A of unit rows."""

    def __init__(self, weight: np.ndarray, vectors: np.ndarray, tile: int):
        self.weight, self.vectors, self.tile = weight, vectors, tile
        self.dense = len(weight) <= DENSE_WORDS
        width = len(weight) if self.dense else vectors.shape[1]
        self.total = np.zeros((len(weight), width), dtype=np.float32)

    def add(self, words: np.ndarray, at: np.ndarray) -> None:
        number, term, base = _tiles(words, at, self.weight, self.tile)
        if not len(number):
            return
        values = self.weight[term].astype(np.float32)
        norm = np.sqrt(_norms(number, values, int(base[-1])))
        values /= norm[number].astype(np.float32)
        if self.dense:
            self._add_pairs(number, term, values)
            return
        y = np.zeros((int(base[-1]), self.vectors.shape[1]), dtype=np.float32)
        _add_products(y, number, term, values, self.vectors)
        order = np.argsort(term, kind="stable")
        _add_products(self.total, term[order], number[order], values[order], y)

    def _add_pairs(self, number: np.ndarray, term: np.ndarray, values: np.ndarray, most: int = 1 << 15) -> None:
        """Products of each term with itself and those after it in its passage: a passage
        has at most ``tile`` terms, so these are far fewer than products with vectors."""
        run = np.flatnonzero(_first_of_run(number))
        sizes = np.diff(run, append=len(number))
        after = np.repeat(run + sizes, sizes) - np.arange(len(number))
        flat, size = self.total.reshape(-1), len(self.weight)
        for low in range(0, len(number), most):
            times = after[low : low + most]
            left = np.repeat(np.arange(low, low + len(times)), times)
            right = left + np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times)
            np.add.at(flat, term[left] * size + term[right], values[left] * values[right])

    def result(self) -> np.ndarray:
        if not self.dense:
            return self.total
        own = self.total.diagonal()[:, None] * self.vectors
        return self.total @ self.vectors + self.total.T @ self.vectors - own


def _stored_terms(docs: DataFrame, text: str, items: Items) -> DataFrame:
    def compute(texts: pa.Array) -> list:
        terms, at = items.terms(texts)
        return [pa.array([terms[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)], pa.binary())]

    frame = with_text_columns(docs.select(text), text, compute, [StructField("terms", BinaryType())], [])
    return stored(frame, "terms")


def _slices(batch: pa.RecordBatch, words: int = 200_000):
    """Term numbers of some rows at a time and where those rows start."""
    held, size = [], 0
    for value in batch.column(0):
        terms = np.frombuffer(value.as_buffer(), dtype=np.uint32)
        held.append(terms)
        size += len(terms)
        if size >= words:
            yield np.concatenate(held), np.concatenate([[0], np.cumsum([len(x) for x in held])])
            held, size = [], 0
    if held:
        yield np.concatenate(held), np.concatenate([[0], np.cumsum([len(x) for x in held])])


def _frequencies(terms: DataFrame, size: int, tile: int) -> tuple[np.ndarray, int]:
    """Passages that hold each term, and all passages."""

    def run(batches):
        seen, passages = np.zeros(size, dtype=np.int64), 0
        every = np.ones(size)
        every[0] = 0
        for batch in batches:
            for words, at in _slices(batch):
                _, term, base = _tiles(words, at, every, tile)
                seen += np.bincount(term, minlength=size)
                passages += int(base[-1])
        seen[0] = passages
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(seen[found])], names=["term", "n"])

    out = np.zeros(size, dtype=np.int64)
    sums = terms.mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    for term, n in sums.collect():  # as many rows as words of the block
        out[term] = n
    passages, out[0] = int(out[0]), 0
    return out, passages


def _gram_times(terms: DataFrame, weight: np.ndarray, base_vectors: np.ndarray, tile: int) -> np.ndarray:
    """A'A times some vectors, A the passages of unit length: one pass over the terms."""
    size, k, part = len(weight), base_vectors.shape[1], 16
    base_vectors = np.ascontiguousarray(base_vectors, dtype=np.float32)

    def run(batches):
        from pyspark import TaskContext

        sums = _Gram(weight, base_vectors, tile)
        for batch in batches:
            for words, at in _slices(batch, 100_000):
                sums.add(words, at)
        total = sums.result()
        del sums
        rows = [(j, total[j : j + part].tobytes()) for j in range(0, size, part)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([TaskContext.get().partitionId() // 64] * len(rows), pa.int64()),
                pa.array([r[1] for r in rows], pa.binary()),
            ],
            names=["part", "some", "sums"],
        )

    def add(frame):
        total = sum(np.frombuffer(x, dtype=np.float32).astype(np.float64) for x in frame["sums"])
        frame = frame.iloc[:1].copy()
        frame["sums"], frame["some"] = [total.astype(np.float32).tobytes()], 0
        return frame[["part", "some", "sums"]]

    schema = "part bigint, some bigint, sums binary"
    few = terms.mapInArrow(run, schema).groupBy("part", "some").applyInPandas(add, schema)
    few = few.groupBy("part").applyInPandas(add, schema)
    out = np.zeros((size, k), dtype=np.float32)
    for part_at, _, sums in few.collect():  # words of the block x axes
        rows = np.frombuffer(sums, dtype=np.float32).reshape(-1, k)
        out[part_at : part_at + len(rows)] = rows
    return out


@dataclass(frozen=True)
class Index:
    """What tasks need of one block; bounded by the block."""

    items: Items
    weight: np.ndarray
    images: np.ndarray  # a column per stretch
    item_of: np.ndarray  # the item of each stretch
    retrieval: Retrieval

    def matches(self, texts: pa.Array) -> list[list[dict]]:
        rows: list[list[dict]] = [[] for _ in range(len(texts))]
        terms, at = self.items.terms(texts)
        number, term, base = _tiles(terms, at, self.weight, self.retrieval.tile)
        if not len(number):
            return rows
        values = self.weight[term].astype(np.float32)
        tiles = int(base[-1])
        score = np.zeros((tiles, self.images.shape[1]), dtype=np.float32)
        _add_products(score, number, term, values, self.images)
        norm = _norms(number, values, tiles)
        # Windows of two tiles; a row's last tile stands alone only if it is the only one.
        row_of = np.repeat(np.arange(len(texts)), np.diff(base))
        pair = np.zeros(tiles, dtype=bool)
        pair[:-1] = row_of[1:] == row_of[:-1]
        score[:-1][pair[:-1]] += score[1:][pair[:-1]]
        norm[:-1] += np.where(pair[:-1], norm[1:], 0)
        alone = ~pair & (np.diff(base)[row_of] > 1)
        score /= np.sqrt(np.maximum(norm, 1e-12))[:, None].astype(np.float32)
        score[alone] = 0
        windows, found = np.nonzero(score >= self.retrieval.cosine)
        done, tried = set(), None
        for window, stretch in zip(windows.tolist(), found.tolist(), strict=True):
            row, item = int(row_of[window]), int(self.item_of[stretch])
            if (row, item) in done or (window, item) == tried:
                continue
            tried = window, item
            match = self._decide(terms[at[row] : at[row + 1]], window - int(base[row]), item)
            if match:
                done.add((row, item))
                rows[row].append(match | {"cosine": float(score[window, stretch])})
        for row in rows:
            row.sort(key=lambda m: (m["item_id"], m["first_word"]))
        return rows

    def _decide(self, words: np.ndarray, window: int, item: int) -> dict | None:
        ask, r = self.items.words[item], self.retrieval
        first = max(0, window * r.tile - len(ask))
        last = min(len(words), (window + 2) * r.tile + len(ask))
        around = words[first:last]
        if np.isin(ask, around).mean() < r.paraphrase:  # no more words than these can align
            return None
        around = around.tolist()
        aligned = common_length(ask.tolist(), around) / len(ask)
        if aligned < r.paraphrase:
            return None
        end = self.items.answers[item].tolist()
        answered = common_length(end, around) / max(1, len(end))
        if aligned < r.verbatim and answered < r.answer:
            return None
        return {
            "item_id": self.items.ids[item], "first_word": first, "last_word": last,
            "aligned": round(aligned, 6), "answer": round(answered, 6),
        }


def common_length(pattern: list[int], text: list[int]) -> int:
    """Length of the longest common subsequence, one machine-word-parallel step per word.

    Number 0 stands for any word outside the benchmark and equals nothing.
    """
    masks: dict[int, int] = {}
    for i, word in enumerate(pattern):
        masks[word] = masks.get(word, 0) | 1 << i
    masks.pop(0, None)
    full = (1 << len(pattern)) - 1
    row = full
    for word in text:
        mask = masks.get(word)
        if mask is not None:
            both = row & mask
            row = ((row + both) | (row - both)) & full
    return len(pattern) - row.bit_count()


def index(docs: DataFrame, items: Items, retrieval: Retrieval, text: str) -> Index:
    with scratch(docs.sparkSession):  # the index itself is on the driver
        return _index(docs, items, retrieval, text)


def _index(docs: DataFrame, items: Items, retrieval: Retrieval, text: str) -> Index:
    terms = _stored_terms(docs, text, items)
    size = len(items.vocabulary) + 1
    seen, passages = _frequencies(terms, size, retrieval.tile)
    weight = np.log((passages + 1.0) / np.maximum(seen, 1))
    weight[0] = 0
    stopped = weight.copy()
    stopped[seen > retrieval.stop_share * passages] = 0
    for words in items.words:  # an item of frequent words alone keeps them
        if (stopped[words] > 0).sum() < 3:
            stopped[words] = weight[words]
    weight = stopped
    stretches = [x for words in items.words for x in np.array_split(words, retrieval.stretches(len(words)))]
    item_of = np.repeat(np.arange(len(items.ids)), [retrieval.stretches(len(w)) for w in items.words])
    queries = np.zeros((size, len(stretches)), dtype=np.float32)
    for i, words in enumerate(stretches):
        queries[np.unique(words), i] = weight[np.unique(words)]
    queries /= np.maximum(np.linalg.norm(queries, axis=0), 1e-12)

    k = min(retrieval.axes + retrieval.oversampling, size)
    share = passages / max(1, len(stretches))

    def gram(x: np.ndarray) -> np.ndarray:
        return _gram_times(terms, weight, x, retrieval.tile) + share * (queries @ (queries.T @ x))

    start = np.random.default_rng(retrieval.seed).standard_normal((size, k)).astype(np.float32)
    axes, _ = np.linalg.qr(gram(start))
    energy = gram(axes)
    _, turn = np.linalg.eigh(axes.T @ energy)
    axes = axes @ turn[:, ::-1][:, : retrieval.axes]
    images = axes @ (axes.T @ queries)
    images /= np.maximum(np.linalg.norm(images, axis=0), 1e-12)
    return Index(items, weight, images.astype(np.float32), item_of, retrieval)


def with_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    retrieval: Retrieval | None = None,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    answer: str | None = None,
    column: str = "matches",
) -> DataFrame:
    """All rows and columns plus ``column``: the benchmark items each text contains.

    Each match names the item, the words of the text it was aligned with, the cosine,
    and the shares of item and answer that align. A null or empty text matches nothing;
    an empty benchmark matches nothing. Long texts are read whole. A column already
    called so is replaced. Equal items each report.
    """
    retrieval = retrieval or Retrieval()
    docs = without(docs, [column])
    out, made = docs, []
    for items in blocks(benchmark, retrieval, item, item_text, answer):
        found = index(docs, items, retrieval, text)
        name = fresh_name(out, "_matches")

        def compute(texts: pa.Array, found: Index = found) -> list:
            kind = pa.list_(
                pa.struct(
                    [("item_id", pa.int64()), ("first_word", pa.int32()), ("last_word", pa.int32()),
                     ("cosine", pa.float64()), ("aligned", pa.float64()), ("answer", pa.float64())]
                )
            )
            return [pa.array(found.matches(texts), kind)]

        out = with_text_columns(out, text, compute, [StructField(name, ArrayType(MATCH))])
        made.append(name)
    if not made:
        return out.withColumn(column, F.array().cast(ArrayType(MATCH)))
    return out.withColumn(column, F.flatten(F.array(*made))).drop(*made)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, retrieval: Retrieval | None = None, text: str = "text") -> DataFrame:
    """The rows without a match; columns stay as they are."""
    name = fresh_name(docs, "_found")
    return with_matches(docs, benchmark, retrieval, text, column=name).filter(F.size(name) == 0).drop(name)
