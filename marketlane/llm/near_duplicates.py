"""Near-duplicate documents by BagMinHash over multisets of word shingles.

A document is the multiset of its five-word shingles (a text of one to four words is
one shingle; one without words has none). Its signature is drawn by hierarchical Poisson
processes: the weight axis of every shingle is cut into the dyadic blocks (0, 1], (1, 2],
(2, 4], ... and each block carries a Poisson process in time whose rate is the block's
length. Each point has a uniform component of the signature and a uniform place in its
block, and it counts where that place is below the shingle's weight. A component's value
is the time of its first point, so two multisets agree in a component with probability
sum(min) / sum(max), without bias. Points are only drawn up to the time at which all
components are filled, about ``m ln m`` for a whole document, however long it is.

Bands of the signature give candidate groups. Exact copies (equal multisets) are one node
from the start. Inside a group nobody is paired with everybody: first each member meets
the group's least member, and the pairs that hold by exact multiset overlap form classes.
Where a group then still has several classes, its members are compared in blocks inside
tasks by their marks, 16 bits of every element of the multiset: two multisets share at
most as many elements as marks, so a pair whose marks overlap too little is surely not
near. All other pairs of different classes leave the task, each from the first band it
shares, to be verified exactly. Before that, each member's best pair in a quarter of the
groups is verified, so that large classes have formed by then. A pair is overlooked only
if it shares no band.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField

from marketlane.functions.frames import first_per_key
from marketlane.llm.common import fresh_name, hashed_words, mix, scratch, stored, stored_counted, with_text_columns, without
from marketlane.llm.components import components

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_ALL = (1 << 64) - 1


@dataclass(frozen=True)
class Banding:
    """A pair of similarity s becomes a candidate with probability 1 - (1 - s**rows)**bands:
    0.9994 at 0.8, 0.99999 at 0.85, 0.01 at 0.35."""

    words: int = 5
    bands: int = 40
    rows: int = 8
    similarity: float = 0.8
    block: int = 512
    block_bytes: int = 1 << 24

    @property
    def components(self) -> int:
        return self.bands * self.rows


def _shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row number and hash of every shingle, sorted by both."""
    words, at = hashed_words(texts)
    counts = np.diff(at)
    made = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    row = np.repeat(np.arange(len(counts)), made)
    first = np.repeat(at[:-1], made) + np.arange(len(row)) - np.repeat(np.cumsum(made) - made, made)
    have = np.minimum(counts, size)[row]
    padded = np.concatenate([words, np.zeros(size, dtype=np.uint64)])
    total = np.zeros(len(row), dtype=np.uint64)
    for j in range(size):
        factor = _U((0xD6E8FEB86659FD93 * (2 * j + 3)) & _ALL)
        total += np.where(have > j, padded[first + j] * factor, _U(0))
    hashes = mix(total + have.astype(np.uint64))
    order = np.lexsort((hashes, row))
    return row[order], hashes[order]


def _occurrences(row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First position of each distinct (row, hash), and each position's occurrence number."""
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    starts = np.flatnonzero(new)
    number = np.arange(len(row)) - np.repeat(starts, np.diff(np.append(starts, len(row))))
    return starts, number


def _elements(hashes: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Shingle and occurrence number as one value: multisets become sets."""
    return mix(hashes + number.astype(np.uint64) * _STEP)


def _bag_ids(row: np.ndarray, elements: np.ndarray, rows: int) -> pa.Array:
    """A 128-bit name per row that depends on its multiset only; null without shingles."""
    at = np.searchsorted(row, np.arange(rows + 1))
    sums = []
    for salt in (_U(0x243F6A8885A308D3), _U(0x13198A2E03707344)):
        running = np.zeros(len(elements) + 1, dtype=np.uint64)
        np.cumsum(mix(elements ^ salt), out=running[1:])
        sums.append(mix(running[at[1:]] - running[at[:-1]] + salt))
    joined = np.stack(sums, axis=1).astype("<u8").tobytes()
    empty = at[1:] == at[:-1]
    return pa.array(
        [None if e else joined[16 * i : 16 * i + 16] for i, e in enumerate(empty)], pa.binary()
    )


def _uniform(x: np.ndarray) -> np.ndarray:
    """In (0, 1], from the upper 53 bits."""
    return ((x >> _U(11)).astype(np.float64) + 1.0) * (1.0 / (1 << 53))


def signatures(row: np.ndarray, hashes: np.ndarray, rows: int, m: int) -> np.ndarray:
    """BagMinHash values, rows x m; infinity for rows without shingles.

    ``row`` and ``hashes`` are the sorted shingles. All points up to a time horizon are
    drawn for a whole slice of rows at once; rows with a component still empty then go
    on to twice the horizon.
    """
    starts, _ = _occurrences(row, hashes)
    weight = np.diff(np.append(starts, len(row)))
    el_row, el_hash = row[starts], hashes[starts]
    total = np.bincount(el_row, weights=weight, minlength=rows)
    # Blocks: number k covers the weights above 2**(k-1) up to 2**k; number 0 is (0, 1].
    blocks = np.ceil(np.log2(weight)).astype(np.int64) + 1
    index = np.repeat(np.arange(len(starts)), blocks)
    k = np.arange(len(index)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    length = np.where(k == 0, 1, 1 << np.maximum(k - 1, 0))
    inside = np.minimum(weight[index] - np.where(k == 0, 0, length), length) / length

    out = np.full(rows * m, np.inf)
    horizon = m * (np.log(m) + 4.0) / np.maximum(total, 1)
    unit = el_row[index]
    seed = mix(el_hash[index] + (k.astype(np.uint64) + _U(1)) * _U(0xA0761D6478BD642F))
    time = np.zeros(len(index))
    rate = length.astype(np.float64)
    drawn = np.zeros(len(index), dtype=np.uint64)
    waiting: list[tuple] = []
    while True:
        while len(unit):
            drawn = drawn + _U(2)
            time = time - np.log(_uniform(mix(seed + drawn * _STEP))) / rate
            on = time <= horizon[unit]
            if not on.all():
                # A point beyond the horizon is kept: it is the next one of its process.
                off = ~on
                waiting.append((unit[off], seed[off], time[off], rate[off], drawn[off], inside[off]))
                unit, seed, time = unit[on], seed[on], time[on]
                rate, drawn, inside = rate[on], drawn[on], inside[on]
            _put(out, m, unit, seed, time, drawn, inside)
        short = np.isinf(out.reshape(rows, m)).any(axis=1) & (total > 0)
        if not short.any():
            return out.reshape(rows, m)
        horizon[short] *= 2.0
        parts = [np.concatenate(x) for x in zip(*waiting, strict=True)]
        go = short[parts[0]]
        unit, seed, time, rate, drawn, inside = (x[go] for x in parts)
        waiting = []
        within = time <= horizon[unit]
        off = ~within
        waiting.append((unit[off], seed[off], time[off], rate[off], drawn[off], inside[off]))
        unit, seed, time = unit[within], seed[within], time[within]
        rate, drawn, inside = rate[within], drawn[within], inside[within]
        _put(out, m, unit, seed, time, drawn, inside)


def _put(out, m, unit, seed, time, drawn, inside) -> None:
    where = mix(seed + (drawn + _U(1)) * _STEP)
    component = ((where >> _U(32)) * _U(m)) >> _U(32)
    place = (where & _U(0xFFFFFFFF)).astype(np.float64) * (1.0 / (1 << 32))
    counts = place < inside
    at = unit[counts] * m + component[counts].astype(np.int64)
    np.minimum.at(out, at, time[counts])


def _band_keys(values: np.ndarray, banding: Banding) -> np.ndarray:
    bits = np.ascontiguousarray(values).view(np.uint64).reshape(-1, banding.bands, banding.rows)
    keys = np.zeros(bits.shape[:2], dtype=np.uint64)
    for j in range(banding.rows):
        keys = mix(keys + bits[:, :, j] + _U((j + 1) * int(_STEP) & _ALL))
    band = np.arange(banding.bands, dtype=np.uint64)[None, :]
    return mix(keys + (band + _U(1)) * _U(0xE7037ED1A0B428DB)).view(np.int64)


def with_bags(docs: DataFrame, text: str, bag: str, banding: Banding) -> DataFrame:
    """All columns plus the name of each document's multiset (null without words)."""

    def compute(texts: pa.Array) -> list:
        row, hashes = _shingles(texts, banding.words)
        _, number = _occurrences(row, hashes)
        return [_bag_ids(row, _elements(hashes, number), len(texts))]

    return with_text_columns(docs, text, compute, [StructField(bag, BinaryType())])


def _with_keys(docs: DataFrame, text: str, keep: list[str], bag: str, banding: Banding) -> DataFrame:
    def compute(texts: pa.Array) -> list:
        row, hashes = _shingles(texts, banding.words)
        _, number = _occurrences(row, hashes)
        bags = _bag_ids(row, _elements(hashes, number), len(texts))
        values = signatures(row, hashes, len(texts), banding.components)
        keys = _band_keys(values, banding)
        at = np.arange(len(texts) + 1, dtype=np.int32) * banding.bands
        return [bags, pa.ListArray.from_arrays(at, keys.ravel())]

    fields = [StructField(bag, BinaryType()), StructField("_keys", ArrayType(LongType()))]
    return with_text_columns(docs, text, compute, fields, keep)


def _with_elements(docs: DataFrame, text: str, bag: str, banding: Banding) -> DataFrame:
    """``bag, elements``: the multiset as sorted 64-bit numbers."""

    def compute(texts: pa.Array) -> list:
        row, hashes = _shingles(texts, banding.words)
        _, number = _occurrences(row, hashes)
        elements = _elements(hashes, number)
        at = np.searchsorted(row, np.arange(len(texts) + 1))
        return [
            pa.array([np.sort(elements[a:b]).tobytes() for a, b in zip(at, at[1:], strict=False)])
        ]

    return with_text_columns(docs, text, compute, [StructField("elements", BinaryType())], [bag])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, similar`` of pairs of bags: sum(min) and sum(max) of their weights."""
    left = sets.select(F.col("_bag").alias("a"), F.col("elements").alias("_ea"))
    right = sets.select(F.col("_bag").alias("b"), F.col("elements").alias("_eb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "_ea", "_eb")

    def run(batches):
        for batch in batches:
            mins, sums = [], []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                where = np.searchsorted(x, y)
                common = int((x[np.minimum(where, len(x) - 1)] == y).sum())
                mins.append(common)
                sums.append(len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(mins), pa.array(sums)],
                names=["a", "b", "common", "either"],
            )

    return both.mapInArrow(run, "a binary, b binary, common bigint, either bigint")


def _with_marks(sets: DataFrame) -> DataFrame:
    """``node, marks``: 16 bits of each element, sorted."""

    def run(batches):
        for batch in batches:
            marks = [
                np.sort(np.frombuffer(x.as_buffer(), dtype=np.uint64).astype(np.uint16)).tobytes() for x in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.binary())], names=["node", "marks"])

    return sets.select("_bag", "elements").mapInArrow(run, "node binary, marks binary")


def _numbered_marks(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All marks with their occurrence number in a row, as one value each, and where rows start."""
    marks = column.to_pylist()
    at = np.concatenate([[0], np.cumsum([len(x) // 2 for x in marks])])
    values = np.frombuffer(b"".join(marks), dtype=np.uint16)
    _, number = _occurrences(np.repeat(np.arange(len(marks)), np.diff(at)), values)
    return (number << 16) + values, at


def _overlaps(values: np.ndarray, counts: np.ndarray, width: int = 2048) -> np.ndarray:
    """How many values each two rows share; no row holds a value twice."""
    _, column, rows_with = np.unique(values, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(counts)), counts)
    shared = np.cumsum(rows_with > 1) - 1
    keep = rows_with[column] > 1
    row, column = row[keep], shared[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(counts), len(counts)), dtype=np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [first, first + width])
        held = np.zeros((len(counts), min(width, int(column[-1]) + 1 - first)), dtype=np.float32)
        held[row[a:b], column[a:b] - first] = 1
        out += held @ held.T
    return out


def _across(members: DataFrame, banding: Banding, best_only: bool) -> DataFrame:
    """Pairs of different classes inside groups that their marks do not rule out: ``key,
    node, root, marks, keys`` in, ``a, b`` out. Groups above ``block`` members or
    ``block_bytes`` are dealt out over pairs of blocks. With ``best_only``, only each
    member's best pair in its block."""
    bulk = F.sum(F.octet_length("marks")).alias("bytes")
    sizes = stored(members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), bulk), "group-sizes")
    parts = F.ceil(F.greatest(F.col("n") / banding.block, F.col("bytes") / banding.block_bytes, F.lit(1.0)))
    own, other = F.pmod(F.xxhash64("node"), F.col("parts")), F.col("other")
    dealt = (
        members.join(sizes.select("key", parts.alias("parts")), "key")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
        .select("key", F.least(F.col("own"), other).alias("i"), F.greatest(F.col("own"), other).alias("j"),
                "node", F.xxhash64("root").alias("root"), "marks", "keys")
    )
    dealt = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def compare(rows: pa.Table):
        place = np.stack([rows.column(c).to_numpy() for c in ("key", "i", "j")])
        new = np.concatenate([[True], (place[:, 1:] != place[:, :-1]).any(axis=0)])
        starts = np.flatnonzero(new)
        root = rows.column("root").to_numpy()
        values, value_at = _numbered_marks(rows.column("marks"))
        keys = rows.column("keys").combine_chunks().flatten().to_numpy().reshape(-1, banding.bands)
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(rows)], strict=True):
            if (root[a:b] == root[a]).all():
                continue
            counts = np.diff(value_at[a : b + 1])
            common = _overlaps(values[value_at[a] : value_at[b]], counts)
            score = common / (counts[:, None] + counts[None, :] - common).astype(np.float64)
            hit = np.triu((score >= banding.similarity - 1e-9) & (root[a:b, None] != root[None, a:b]), 1)
            x, y = np.nonzero(hit)
            same = score[x, y]
            if best_only:
                top = np.zeros(b - a)
                np.maximum.at(top, x, same)
                np.maximum.at(top, y, same)
                keep = (same == top[x]) | (same == top[y])
            else:  # in the first band that both share
                first_band = (keys[a + x] == keys[a + y]).argmax(axis=1)
                keep = keys[a + x, first_band] == place[0][a]
            yield a + x[keep], a + y[keep]

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            tail = [batch.column(c)[len(batch) - 1].as_py() for c in range(3)]
            head = [held[0].column(c)[0].as_py() for c in range(3)]
            if tail != head:  # all but the last block are whole
                rows = pa.Table.from_batches(held)
                place = np.stack([rows.column(c).to_numpy() for c in range(3)])
                whole = int(np.flatnonzero((place != np.array(tail)[:, None]).any(axis=0))[-1]) + 1
                yield from emit(rows.slice(0, whole))
                held = rows.slice(whole).to_batches()
        if held:
            yield from emit(pa.Table.from_batches(held))

    def emit(rows: pa.Table):
        nodes = rows.column("node").combine_chunks()
        for x, y in compare(rows):
            yield pa.RecordBatch.from_arrays([nodes.take(pa.array(x)), nodes.take(pa.array(y))], names=["a", "b"])

    found = dealt.mapInArrow(run, "a binary, b binary")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicate_links(docs: DataFrame, text: str = "text", banding: Banding | None = None) -> DataFrame:
    """``bag, root``: the class of every multiset that is near another one.

    Bags without a near partner are left out. Nulls and texts without words have no
    bag and are near nothing. An empty table gives no rows.
    """
    with scratch(docs.sparkSession) as keep:
        labels = _linked(docs, text, banding or Banding())
        return keep(stored(labels, "classes"))


def _linked(docs: DataFrame, text: str, banding: Banding) -> DataFrame:
    keyed = _with_keys(docs.select(text), text, [], "_bag", banding)
    nodes = keyed.filter("_bag IS NOT NULL").groupBy(F.col("_bag").alias("node"))
    nodes = stored(nodes.agg(F.min("_keys").alias("keys")), "nodes")
    rows = nodes.select("node", F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("head"))
    shared = stored(shared.filter("n > 1").select("key", "head"), "shared-keys")
    members, n_members = stored_counted(rows.join(shared, "key").select("key", "node", "head"), "groups")
    wanted = stored(nodes.join(members, "node", "left_semi").select("node", "keys"), "wanted")
    sets = _multisets(docs, text, wanted, banding)

    # First each member against the least of its group.
    stars = members.filter("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    first = stored(_verified(stored(stars, "stars", n_members), sets), "verified")
    near = F.col("common") >= F.lit(banding.similarity) * F.col("either")
    found = first.filter(near).select("a", "b")
    labels = components(found)

    # Then, in groups of several classes, members of different classes.
    done = first.select("a", "b")
    marked = stored(_with_marks(sets).join(wanted, "node"), "marks")
    for best_only in (True, False):
        classed = members.join(labels, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
        classed = stored(classed, "classed", n_members)
        mixed = classed.groupBy("key").agg(F.min("root").alias("one"), F.max("root").alias("two"))
        mixed = mixed.filter("one <> two").select("key")
        if best_only:
            mixed = mixed.filter(F.pmod("key", F.lit(4)) == 0)
        mixed = stored(mixed, "mixed-keys", n_members)
        open_rows = classed.join(mixed, "key", "left_semi").join(marked, "node")
        across = _across(open_rows, banding, best_only).join(done, ["a", "b"], "left_anti")
        fresh = stored(_verified(stored(across, "possible"), sets), "verified")
        done = done.unionByName(fresh.select("a", "b"))
        fresh = fresh.filter(near).select("a", "b")
        if not fresh.isEmpty():
            found = found.unionByName(fresh)
            labels = components(found)
    return labels.select(F.col("node").alias("bag"), "root")


def _multisets(docs: DataFrame, text: str, wanted: DataFrame, banding: Banding) -> DataFrame:
    """``_bag, elements`` of the wanted multisets, from one text each; other copies stay
    behind before the exchange."""
    texts = with_bags(docs.select(text), text, "_bag", banding).filter("_bag IS NOT NULL")
    texts = first_per_key(texts, ["_bag"], [F.lit(0).asc()])
    texts = texts.join(wanted.select(F.col("node").alias("_bag")), "_bag", "left_semi")
    return stored(_with_elements(texts, text, "_bag", banding), "multisets")


def near_duplicate_classes(
    docs: DataFrame, text: str = "text", banding: Banding | None = None, class_column: str = "class"
) -> DataFrame:
    """The documents with their class, a binary name; equal for near duplicates.

    A document is near another if their shingle multisets overlap by ``similarity``
    (sum of minima over sum of maxima); classes are closed under that. Rows with a null
    text or without a word get a null class: they are near nothing. All columns and rows
    stay; a column already called like ``class_column`` is replaced.
    """
    banding = banding or Banding()
    docs = without(docs, [class_column]) if class_column.lower() != text.lower() else docs
    bag, root = fresh_name(docs, "_bag"), fresh_name(docs, "_root")
    links = near_duplicate_links(docs, text, banding).select(
        F.col("bag").alias(bag), F.col("root").alias(root)
    )
    joined = with_bags(docs, text, bag, banding).join(links, bag, "left")
    return joined.withColumn(class_column, F.coalesce(root, bag)).drop(bag, root)


def drop_near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", banding: Banding | None = None
) -> DataFrame:
    """One document of each class stays: the least ``key``, nulls last, then the least text.

    Documents without a word all stay. Columns stay as they are.
    """
    group = fresh_name(docs, "_class")
    classed = near_duplicate_classes(docs, text, banding, group)
    kept = first_per_key(
        classed.filter(F.col(group).isNotNull()), [group], [F.asc_nulls_last(key), F.col(text)]
    )
    return kept.unionByName(classed.filter(F.col(group).isNull())).drop(group)


def class_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", banding: Banding | None = None) -> DataFrame:
    """One row per document: ``doc_id, class_id, class_size``.

    ``class_id`` is the least key of the class. A document near nothing is a class of its
    own, named by its own key.
    """
    classed = stored(
        near_duplicate_classes(docs.select(key, text), text, banding, "_class")
        .select(F.col(key).alias("doc_id"), "_class"),
        "classes",
    )
    sizes = classed.filter("_class IS NOT NULL").groupBy("_class").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")
    )
    sizes = stored(sizes.filter("class_size > 1"), "class-sizes")
    joined = classed.join(sizes, "_class", "left")
    return joined.select(
        "doc_id",
        F.when(F.col("class_size").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
    )
