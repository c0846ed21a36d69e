"""Nearest neighbours by a block matrix join of int8 product tiles.

Queries and candidates are dealt on a grid: each query into one of the grid's rows, each candidate into one of its columns, by a stored row
number, so that a row or column holds its share whatever the ids are. The grid has about ``CELLS_PER_TASK`` cells for each task that runs at once, with
about as many rows as columns: a row of the table is shipped once for each cell of its line, the root of the number of tasks. Only where a
grid row would hold more than ``MOST_QUERIES`` queries there are more rows.

A cell keeps its queries and streams its candidates past them in tiles. A tile multiplies the int8 codes (exact whole-number products) and
bounds the error of each product by the norms of what quantising cut off:

    |q.c - a.b| <= |q| * |c - b| + |q - a| * |b|      (a, b: what the codes stand for)

Pairs whose upper bound does not reach the k-th best lower bound or the k-th score so far are
dropped, the others are recomputed from the original vectors in double precision and kept in one
heap of k per query. A last merge ranks what the cells kept; each task passes on at most k rows per query. No pair is lost:
the bound is safe, so results are exact.

Memory of a task: a grid row's queries with ``k`` results for each, and one block of candidates. Vectors that are null, zero, or hold null or
non-finite components take no part; vectors meet only vectors of the same length. A query does not meet rows of its own id. Repeated rows
count one by one; the results of query rows with one id are ranked together; ties go to the smaller id. Fewer candidates than ``k``: all of them.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .base import tidy

# Sides of a tile.
QUERIES_PER_BLOCK, ROWS_PER_BLOCK = 512, 4096
# Queries that a cell keeps.
MOST_QUERIES = 1 << 16
CELLS_PER_TASK = 2


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v double[]) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    sound = v.isNotNull() & F.col(key).isNotNull() & F.exists(v, lambda x: x != 0)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col(key).cast("long").alias("id"), v.alias("v"), (sound & finite).alias("_ok")).filter(
        "_ok"
    ).select("id", "v", F.size("v").alias("dim"))


def grid(tasks: int, queries: int) -> tuple[int, int]:
    """Rows and columns of the grid."""
    side = math.isqrt(max(1, CELLS_PER_TASK * tasks) - 1) + 1
    return max(side, -(-queries // MOST_QUERIES)), side


def _numbered(rows: DataFrame) -> DataFrame:
    """The rows with a stored number each, which a lost task reads again."""
    return cut_lineage(rows.withColumn("number", F.monotonically_increasing_id()))


def _dealt(rows: DataFrame, own: int, cell: Column, other: int, role: int) -> DataFrame:
    """Each row once for each of the ``other`` lines that cross its own."""
    line = F.pmod(F.xxhash64("number"), F.lit(own)).cast("int").alias("line")
    crossed = F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias("cross")
    out = rows.select("id", "v", "dim", line, crossed)
    return out.select("dim", cell.cast("int").alias("cell"), F.lit(role).alias("role"), "id", "v")


def quantise(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes (as whole floats), scales, and the norms of vectors, coded vectors and remainders."""
    scale = np.abs(v).max(axis=1) / 127.0
    scale = np.where(scale > 0, scale, np.finfo(np.float64).tiny)
    codes = np.clip(np.rint(v / scale[:, None]), -127, 127).astype(np.int8)
    stands = codes * scale[:, None]
    norm = lambda x: np.sqrt((x * x).sum(axis=1))
    return codes, scale, norm(v), norm(stands), norm(v - stands)


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of matching rows, added from the first component to the last."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j] * b[:, j]
    return out


def _tile(q_ids, q, coded_q, c_ids, c, k: int, heaps: dict[int, list]) -> None:
    codes_q, scale_q, norm_q, _, rest_q = coded_q
    codes_c, scale_c, _, stands_c, rest_c = quantise(c)
    kind = np.float32 if q.shape[1] * 127 * 127 < 1 << 24 else np.float64
    near = (codes_q.astype(kind) @ codes_c.T.astype(kind)).astype(np.float64) * scale_q[:, None] * scale_c[None, :]
    slack = norm_q[:, None] * rest_c[None, :] + rest_q[:, None] * stands_c[None, :]
    slack = slack * (1 + 1e-9) + 1e-12 * np.abs(near)
    near[q_ids[:, None] == c_ids[None, :]] = -np.inf
    lower = near - slack
    floor = np.full(len(q_ids), -np.inf)
    if len(c_ids) > k:
        floor = np.partition(lower, len(c_ids) - k, axis=1)[:, len(c_ids) - k]
    kept = np.array([heaps[i][0][0] if len(heaps[i]) == k else -np.inf for i in range(len(q_ids))])
    at, to = np.nonzero((near + slack >= np.maximum(floor, kept)[:, None]) & (near > -np.inf))
    for first in range(0, len(at), 1 << 18):
        a, b = at[first : first + (1 << 18)], to[first : first + (1 << 18)]
        scores = exact_products(q[a], c[b])
        for i, score, other in zip(a.tolist(), scores.tolist(), c_ids[b].tolist()):
            entry = (score, -other)
            if len(heaps[i]) < k:
                heapq.heappush(heaps[i], entry)
            elif entry > heaps[i][0]:
                heapq.heapreplace(heaps[i], entry)


class _Cell:
    """The queries of a cell and the candidates that wait for the next tile."""

    def __init__(self, k: int):
        self.k, self.queries, self.waiting, self.n, self.blocks = k, [], [], 0, []

    def ask(self, ids: np.ndarray, v: np.ndarray) -> None:
        self.queries.append((ids, v))

    def offer(self, ids: np.ndarray, v: np.ndarray) -> None:
        self.waiting.append((ids, v))
        self.n += len(ids)
        if self.n >= ROWS_PER_BLOCK:
            self.multiply()

    def multiply(self) -> None:
        if self.queries:
            ids, v = (np.concatenate(x) for x in zip(*self.queries))
            for at in range(0, len(ids), QUERIES_PER_BLOCK):
                own = slice(at, at + QUERIES_PER_BLOCK)
                self.blocks.append((ids[own], v[own], quantise(v[own]), {j: [] for j in range(len(ids[own]))}))
            self.queries = []
        if self.waiting and self.blocks:
            ids, v = (np.concatenate(x) for x in zip(*self.waiting))
            for at in range(0, len(ids), ROWS_PER_BLOCK):
                for q_ids, q, coded, heaps in self.blocks:
                    _tile(q_ids, q, coded, ids[at : at + ROWS_PER_BLOCK], v[at : at + ROWS_PER_BLOCK], self.k, heaps)
        self.waiting, self.n = [], 0

    def found(self) -> Iterator[pa.RecordBatch]:
        self.multiply()
        for ids, _, _, heaps in self.blocks:
            rows = [(int(ids[i]), -other, score) for i, heap in heaps.items() for score, other in heap]
            columns = list(zip(*rows)) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, _FOUND)], schema=_FOUND)


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, cell = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = np.stack([batch[c].to_numpy() for c in ("dim", "cell", "role")])
            ids, flat = batch["id"].to_numpy(), batch["v"].flatten().to_numpy()
            place = np.concatenate([[0], np.cumsum(keys[0])])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)]):
                dim, number, role = keys[:, a].tolist()
                if at != (dim, number):
                    if cell is not None:
                        yield from cell.found()
                    at, cell = (dim, number), _Cell(k)
                (cell.offer if role else cell.ask)(ids[a:b], flat[place[a] : place[b]].reshape(b - a, dim))
        if cell is not None:
            yield from cell.found()

    return run


def nearest(queries: DataFrame, candidates: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` candidates with the largest inner product for each query row.

    Returns query_id, rank (from 1), vec_id, score.
    """
    asked, held = _numbered(usable(queries, key, vector)), _numbered(usable(candidates, key, vector))
    rows, columns = grid(queries.sparkSession.sparkContext.defaultParallelism, asked.count())
    cells = _dealt(asked, rows, F.col("line") * columns + F.col("cross"), columns, 0).union(
        _dealt(held, columns, F.col("cross") * columns + F.col("line"), rows, 1)
    )
    ordered = cells.repartition(rows * columns, "dim", "cell").sortWithinPartitions("dim", "cell", "role")
    found = ordered.mapInArrow(tidy(_search(k)), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
