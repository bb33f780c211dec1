"""Approximate nearest neighbours by adaptive dimension scans of probed lists.

Vectors are normalised and turned by one random rotation, so that any block of
columns is a fair sample of a distance.  They are dealt to inverted lists by
nearest centroid.  A query probes its nearest lists; within a list the columns
are scanned block by block, and after each block a hypothesis test abandons
the candidates whose partial distance, scaled up, is beyond the query's
current k-th distance by more than the test's margin.  The few that reach the
last block are scored again by the cosine of the original vectors in double
precision.

Centroids are fitted on a bounded, seeded sample (``SAMPLE`` vectors), and the
number of probed lists is the smallest that reaches ``TARGET_RECALL`` on queries of
that sample.  Every row is indexed.  Lists are split into blocks of ``BLOCK``
candidates and ``QUERIES`` queries, so one list may hold a third of all rows.

Defined cases: vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part, nor do null ids; equal rows are one row, and
rows repeating an id count once, with their best score; ties go to the smaller id; fewer than k
candidates give fewer rows; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinrisk.llm.common import map_arrow, ship, stored, table

K = 5
SAMPLE = 20_000
MAX_LISTS = 1024
TARGET_RECALL = 0.99
BLOCK, QUERIES = 4096, 2048
COLUMNS = 16                    # columns of a scan step
EPSILON = 2.1                   # margin of the test, in standard errors
TILE = 512                      # candidates between updates of a query's k-th distance
SEED = 5


class Index:
    """Centroids of the lists, the rotation, and how many lists a query probes."""

    def __init__(self, sample: np.ndarray, n_lists: int, k: int = K, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.dim = sample.shape[1]
        self.rotation = np.linalg.qr(rng.normal(size=(self.dim, self.dim)))[0]
        x = unit(sample)
        # Distinct starts: equal centroids would part equal vectors by rounding alone.
        distinct = x[np.unique(x.round(9), axis=0, return_index=True)[1]]
        self.centroids = distinct[rng.choice(len(distinct), min(n_lists, len(distinct)), replace=False)]
        for _ in range(8):
            near = (x @ self.centroids.T).argmax(axis=1)
            sums = np.zeros_like(self.centroids)
            np.add.at(sums, near, x)
            some = np.linalg.norm(sums, axis=1) > 0
            self.centroids[some] = unit(sums[some])
        self.probes = self._calibrate(x, rng, k)

    def _calibrate(self, x: np.ndarray, rng: np.random.Generator, k: int) -> int:
        asked = rng.choice(len(x), min(256, len(x)), replace=False)
        sims = x[asked] @ x.T
        sims[np.arange(len(asked)), asked] = -np.inf
        k = min(k, len(x) - 1)
        if k < 1:
            return len(self.centroids)
        best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        home = (x @ self.centroids.T).argmax(axis=1)
        order = np.argsort(-(x[asked] @ self.centroids.T), axis=1)
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(order.shape[1])[None], axis=1)
        needed = np.sort(np.take_along_axis(rank, home[best], axis=1).ravel())
        return int(needed[min(len(needed) - 1, int(np.ceil(TARGET_RECALL * len(needed))))]) + 1

    def home(self, x: np.ndarray) -> np.ndarray:
        return (unit(x) @ self.centroids.T).argmax(axis=1)

    def probed(self, q: np.ndarray) -> np.ndarray:
        return np.argsort(-(unit(q) @ self.centroids.T), axis=1, kind="stable")[:, :self.probes]


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)    # no overflow or underflow of the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Each row times a power of two, which changes no digit: squares of huge or tiny components stay in range."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0.0))[1][:, None])


def _firsts(ids: np.ndarray) -> np.ndarray:
    """The places where an id stands first, ascending."""
    return np.sort(np.unique(ids, return_index=True)[1])


def adaptive_scan(query: np.ndarray, blocks: list[np.ndarray], k: int, epsilon: float = EPSILON,
                  ids: np.ndarray | None = None, own: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Candidates (row numbers, squared distances) that no test abandoned.
    ``blocks``: the rotated candidates, cut by columns.  With ``ids`` the k-th
    distance is that of the k-th id, without the id ``own``."""
    n, dim = len(blocks[0]), sum(b.shape[1] for b in blocks)
    rows_out, dist_out, kth = [], [], np.inf
    ids = np.arange(n) if ids is None else ids
    held, held_ids = np.zeros(0), ids[:0]
    for at in range(0, n, TILE):
        rows = np.arange(at, min(n, at + TILE))
        if own is not None:
            rows = rows[ids[rows] != own]
        part, seen = np.zeros(len(rows)), 0
        for block in blocks:
            width = block.shape[1]
            diff = block[rows] - query[seen:seen + width]
            part = part + np.einsum("ij,ij->i", diff, diff)
            seen += width
            if np.isfinite(kth) and seen < dim:
                alive = part * (dim / seen) <= kth * (1 + epsilon / np.sqrt(seen)) ** 2
                rows, part = rows[alive], part[alive]
                if not len(rows):
                    break
        rows_out.append(rows)
        dist_out.append(part)
        held, held_ids = np.concatenate([held, part]), np.concatenate([held_ids, ids[rows]])
        order = np.argsort(held, kind="stable")
        order = order[_firsts(held_ids[order])[:k]]
        held, held_ids = held[order], held_ids[order]
        if len(held) == k:
            kth = held[-1]
    rows, dist = np.concatenate(rows_out), np.concatenate(dist_out)
    keep = dist <= kth * (1 + 1e-9) + 1e-12
    return rows[keep], dist[keep]


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), dtype=np.float64).reshape(-1, dim)


def valid_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v array<double>) of the rows that take part."""
    v: Column = F.col(vector_col).cast("array<double>")
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(~F.coalesce(bad, F.lit(True)) & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    return rows.where(F.size("v") == (common.dim if common else 0))


def fit_index(rows: DataFrame, k: int = K) -> tuple[Index | None, int]:
    n = rows.count()
    # One vector an id: further ones would pass for neighbours when the probes are counted.
    one = rows.groupBy("id").agg(F.min("v").alias("v"))
    # A sort sends n rows of every partition to the driver: first all but some twice SAMPLE ids go by their hash.
    spot = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    ids = max(1, rows.agg(F.approx_count_distinct("id", 0.01)).first()[0])
    near = one.where(spot < int(min(1.0, 2 * SAMPLE / ids) * (1 << 30)) + 1)
    picked = [r.v for r in near.orderBy(spot, "id").limit(SAMPLE).collect()]
    if not picked:
        return None, 0
    return Index(np.array(picked), max(1, min(MAX_LISTS, round(n ** 0.5))), k), n


def nearest(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of every row where
    ``is_query`` (a condition on ``id``)."""
    spark = vectors.sparkSession
    ship(spark)
    rows = stored(valid_vectors(vectors, id_col, vector_col).dropDuplicates(["id", "v"]), "vectors")
    index, _ = fit_index(rows, k)
    if index is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            home = index.home(_matrix(b.column(1), index.dim)) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(home.astype(np.int32))], names=["id", "v", "list"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = index.probed(_matrix(b.column(1), index.dim)).astype(np.int32).tolist() if b.num_rows else []
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lists, pa.list_(pa.int32()))], names=["id", "v", "lists"])

    dealt = stored(map_arrow(rows, deal, "id bigint, v array<double>, list int"), "lists")
    asked = map_arrow(rows.where(is_query), probe, "id bigint, v array<double>, lists array<int>")
    asked = stored(asked.select("id", "v", F.explode("lists").alias("list")), "probes")
    # Blocks of both sides: every (list, part, qpart) group is bounded; the counts are one row per list.
    sizes = dealt.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    loads = asked.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("qparts"))
    grid = F.broadcast(sizes.join(loads, "list"))           # at most MAX_LISTS rows

    def salt(n: str) -> Column:
        return F.pmod(F.xxhash64("id"), F.col(n))

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    candidates = dealt.join(grid, "list").withColumn("part", salt("parts")).withColumn("qpart", every("qparts"))
    queries = asked.join(grid, "list").withColumn("qpart", salt("qparts")).withColumn("part", every("parts"))
    keys = ["list", "part", "qpart"]

    def scan(c: pa.Table, q: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if c.num_rows and q.num_rows:
            c = c.sort_by("id")
            ids, x = c.column("id").to_numpy(), _scaled(_matrix(c.column("v"), index.dim))
            turned = unit(x) @ index.rotation
            blocks = [np.ascontiguousarray(turned[:, a:a + COLUMNS]) for a in range(0, index.dim, COLUMNS)]
            norms = np.sqrt((x * x).sum(axis=1))
            qx = _scaled(_matrix(q.column("v"), index.dim))
            for qid, vec, spin in zip(q.column("id").to_pylist(), qx, unit(qx) @ index.rotation):
                found, _ = adaptive_scan(spin, blocks, k + 1, ids=ids, own=qid)         # one more than asked, for the tests' error
                cosine = (x[found] * vec).sum(axis=1) / (norms[found] * np.sqrt((vec * vec).sum()))
                best = np.lexsort((ids[found], -cosine))
                best = best[_firsts(ids[found][best])[:k]]
                out[0].extend([qid] * len(best))
                out[1].extend(ids[found][best].tolist())
                out[2].extend(cosine[best].tolist())
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
                        names=["query_id", "vec_id", "score"])
    hits = (candidates.select("id", "v", *keys).groupBy(*keys)
            .cogroup(queries.select("id", "v", *keys).groupBy(*keys)).applyInArrow(scan, "query_id bigint, vec_id bigint, score double"))
    hits = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_ann_adaptive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
