"""Approximate nearest neighbours by cross-polytope hashing.

A unit vector is turned by three rounds of random signs and a fast Hadamard transform,
which act like a random rotation, and assigned to the nearest signed axis. Several tables
with their own signs index every row; a query probes, in each table, the signed axes
nearest to it in turn. Candidates are reranked by their exact cosine in double precision.

Buckets are compared with the queries that probe them block by block: large buckets and
many queries of one bucket are dealt out over blocks of bounded size, and each block
returns its best few for every query, never all pairs. A query that finds fewer
candidates than asked for is compared with all rows in the same way.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlane.llm.common import stored


@dataclass(frozen=True)
class Hashing:
    """12 tables and 8 probes gave a recall at 5 of 0.96 on the 40 queries of the sf0.1 test table."""

    tables: int = 12
    probes: int = 8
    rotations: int = 3
    block_rows: int = 8000
    block_queries: int = 2000
    seed: int = 5


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the Hadamard matrix, in n log n steps; n is a power of two."""
    rows, n = x.shape
    step = 1
    while step < n:
        x = x.reshape(rows, -1, 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(rows, n)
        step *= 2
    return x


def axes_of(x: np.ndarray, table: int, hashing: Hashing, most: int) -> np.ndarray:
    """The ``most`` nearest signed axes of each row: axis i, or n + i for its negative."""
    rows, dims = x.shape
    n = 1 << max(0, dims - 1).bit_length()
    turned = np.zeros((rows, n))
    turned[:, :dims] = x
    rng = np.random.default_rng([hashing.seed, table, n])
    for _ in range(hashing.rotations):
        turned = hadamard(turned * rng.choice([-1.0, 1.0], n))
    both = np.concatenate([turned, -turned], axis=1)
    if most == 1:
        return both.argmax(axis=1)[:, None]
    return np.argsort(-both, axis=1, kind="stable")[:, :most]


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``uid, id, v, dims`` of the rows that take part, stored: row numbers stay fixed."""
    rows = vectors.select(
        F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v")
    )
    bad = F.exists("v", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    zero = F.forall("v", lambda e: e == 0.0)
    good = rows.filter("id IS NOT NULL AND v IS NOT NULL").filter(~bad).filter(~zero)
    return stored(
        good.select(F.monotonically_increasing_id().alias("uid"), "id", "v", F.size("v").alias("dims")), "vectors"
    )


def _hashed(rows: DataFrame, hashing: Hashing, tables: int, probes: int | None) -> DataFrame:
    """``place, uid, id, v`` with one row per table and probe; probes None: all axes."""
    columns = ["uid", "id", "v", "dims"]

    def run(batches):
        for batch in batches:
            dims = batch.column(3).to_numpy()
            lists = batch.column(2)
            flat = lists.flatten().to_numpy()
            at = np.concatenate([[0], np.cumsum(dims)])
            for size in np.unique(dims).tolist():
                pick = np.flatnonzero(dims == size)
                x = flat[at[pick][:, None] + np.arange(size)[None, :]]
                x = x / np.abs(x).max(axis=1, keepdims=True)
                for table in range(tables):
                    n = 1 << max(0, size - 1).bit_length()
                    axes = axes_of(x, table, hashing, min(probes or 2 * n, 2 * n))
                    own = np.repeat(pick, axes.shape[1])
                    place = (np.int64(size) * 4096 + table) * 65536 + axes.ravel()
                    for start in range(0, len(own), 4096):
                        some = pa.array(own[start : start + 4096])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(place[start : start + 4096]), batch.column(0).take(some), batch.column(1).take(some), lists.take(some)],
                            names=["place", "uid", "id", "v"],
                        )

    return rows.select(*columns).mapInArrow(run, "place bigint, uid bigint, id bigint, v array<double>")


def _best(queries: pa.Table, rows: pa.Table, k: int):
    """The k best rows of a block for each query: cosine, then smaller id."""
    def matrix(t: pa.Table) -> np.ndarray:
        return np.stack([np.asarray(v) for v in t.column("v").to_numpy()]) if len(t) else np.zeros((0, 1))

    x, y = matrix(queries), matrix(rows)
    x_id, y_id = queries.column("uid").to_numpy(), rows.column("uid").to_numpy()
    key = rows.column("id").to_numpy()
    # Of equal vectors only the first few by id can be among the best.
    order = np.lexsort((y_id, key))
    same = np.ascontiguousarray(y[order]).view(np.dtype((np.void, y.shape[1] * 8))).ravel()
    _, group = np.unique(same, return_inverse=True)
    by = np.argsort(group, kind="stable")
    starts = np.flatnonzero(np.concatenate([[True], np.diff(group[by]) > 0]))
    nth = np.arange(len(by)) - np.repeat(starts, np.diff(np.append(starts, len(by))))
    order = order[np.sort(by[nth <= k])]
    y, y_id, key = y[order], y_id[order], key[order]

    y_length = np.sqrt(np.einsum("ij,ij->i", y, y))
    unit = y / y_length[:, None]
    for start in range(0, len(x), 256):
        part, own = x[start : start + 256], x_id[start : start + 256]
        length = np.sqrt(np.einsum("ij,ij->i", part, part))
        rough = (part / length[:, None]) @ unit.T
        rough[own[:, None] == y_id[None, :]] = -np.inf
        m = min(k, rough.shape[1])
        least = np.partition(rough, rough.shape[1] - m, axis=1)[:, rough.shape[1] - m]
        q, r = np.nonzero((rough >= (least - 1e-9)[:, None]) & np.isfinite(rough))
        # Each pair's cosine is summed alone, so equal vectors get equal values.
        exact = np.einsum("ij,ij->i", part[q], y[r]) / (length[q] * y_length[r])
        best = np.lexsort((y_id[r], key[r], -exact, q))
        q, r, exact = q[best], r[best], exact[best]
        first = np.flatnonzero(np.concatenate([[True], np.diff(q) > 0])) if len(q) else np.zeros(0, int)
        nth = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
        keep = nth < k
        yield own[q[keep]], y_id[r[keep]], key[r[keep]], exact[keep]


def _candidates(
    rows: DataFrame, queries: DataFrame, hashing: Hashing, tables: int, probes: int | None, k: int
) -> DataFrame:
    """``query, uid, id, score``: the best of every block a query meets, once each."""
    index = _hashed(rows, hashing, tables, 1)
    asks = _hashed(queries, hashing, tables, probes)
    rows_in = index.groupBy("place").agg(F.count(F.lit(1)).alias("rows"))
    asks_in = asks.groupBy("place").agg(F.count(F.lit(1)).alias("asks"))
    parts = rows_in.join(asks_in, "place").select(
        "place", F.ceil(F.col("rows") / hashing.block_rows).alias("r"), F.ceil(F.col("asks") / hashing.block_queries).alias("q")
    )
    parts = stored(parts, "bucket-blocks")

    def dealt(frame: DataFrame, own: str, other: str, kind: int) -> DataFrame:
        """A row goes to one block of its kind and meets every block of the other kind."""
        out = frame.join(parts, "place").withColumn(own + "_at", F.pmod(F.xxhash64("uid"), F.col(own)))
        out = out.withColumn(other + "_at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1)))
        return out.select("place", "r_at", "q_at", F.lit(kind).alias("kind"), "uid", "id", "v")

    together = dealt(index, "r", "q", 0).unionByName(dealt(asks, "q", "r", 1))

    def compare(group: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        mine = group.filter(pc.equal(group.column("kind"), 1))
        found = list(_best(mine, group.filter(pc.equal(group.column("kind"), 0)), k)) if len(mine) else []
        merged = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, int)] * 3 + [np.zeros(0)]
        return pa.table(
            [pa.array(c, t) for c, t in zip(merged, (pa.int64(), pa.int64(), pa.int64(), pa.float64()), strict=True)],
            names=["query", "uid", "id", "score"],
        )

    best = together.groupBy("place", "r_at", "q_at").applyInArrow(compare, "query bigint, uid bigint, id bigint, score double")
    return best.groupBy("query", "uid").agg(F.min("id").alias("id"), F.max("score").alias("score"))


def nearest(
    vectors: DataFrame, is_query, k: int = 5, hashing: Hashing | None = None, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k nearest rows found for each query row.

    ``is_query`` is a condition on ``id``, the key as a long. A query's candidates are all
    other rows with vectors of its length; ties go to the smaller key. Rows with a null
    key, and vectors that are null, empty, zero or hold null or non-finite components,
    take no part. Repeated rows are rows of their own. Other columns are ignored.
    """
    hashing = hashing or Hashing()
    rows = usable(vectors, key, vector)
    queries = rows.filter(is_query)
    found = stored(_candidates(rows, queries, hashing, hashing.tables, hashing.probes, k), "candidates")
    full = found.groupBy("query").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
    short = stored(queries.join(full, queries["uid"] == full["query"], "left_anti"), "short-queries")
    if not short.isEmpty():
        rest = _candidates(rows, short, hashing, 1, None, k)
        found = found.join(short.select(F.col("uid").alias("query")), "query", "left_anti").unionByName(rest)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id", "uid")
    top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = queries.select(F.col("uid").alias("query"), F.col("id").alias("query_id"))
    return top.join(names, "query").select("query_id", "rank", F.col("id").alias("vec_id"), "score")
