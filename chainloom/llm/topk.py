"""Exact top-k search by inner product with pivot-table elimination.

Vectors are whole numbers (components times a scale, rounded down). One more coordinate makes all their lengths
equal, so the inner product falls with the Euclidean distance. A pivot table holds the distance of every vector to
many pivots; by the triangle inequality the largest difference of a query's and a vector's distances to a pivot is a
lower bound of their distance, so an upper bound of their product.

Vectors lie in blocks around their nearest pivot. Each query first searches one block near it, whose k-th score is
its limit. Then blocks whose bound is below the limits of all queries of a chunk are left out, and
inside a block candidates come in bound order until the bound falls below the k-th score so far. A bound equal to the
limit is still evaluated, so ties go to the smaller id exactly.

Edge cases: vectors that are null, empty or hold null or non-finite components take no part, nor do rows without id; vectors of
unequal length are padded with zeros; rows that repeat an id are candidates each, but never for queries of that id; fewer
than k candidates give fewer rows. Empty tables give no rows. Other columns are ignored. Products must fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from chainloom.llm.common import by_merge, stored

FOUND = "query_id bigint, vec_id bigint, score bigint"


def whole(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id and v (array<bigint>) of the vectors that take part."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)).where(
        ~F.coalesce(bad, F.lit(True))
    ).select(F.col("vec_id").cast("bigint"), F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"))


class Pivots:
    """Pivot vectors, and the squared length that all vectors are brought to."""

    def __init__(self, pivots: np.ndarray, length: float):
        self.p, self.length = pivots.astype(float), float(length)
        self.extra = self._extra(self.p)

    def _extra(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.length - (x * x).sum(1), 0))

    def of_vectors(self, x: np.ndarray) -> np.ndarray:
        """Distances of (lengthened) vectors to the pivots."""
        e = self._extra(x)
        d = (x * x).sum(1)[:, None] + (self.p**2).sum(1) - 2 * x @ self.p.T + (e[:, None] - self.extra) ** 2
        return np.sqrt(np.maximum(d, 0))

    def of_queries(self, q: np.ndarray) -> np.ndarray:
        """Distances of queries (extra coordinate 0) to the pivots."""
        d = (q * q).sum(1)[:, None] + self.length - 2 * q @ self.p.T
        return np.sqrt(np.maximum(d, 0))

    def product(self, distance: np.ndarray, q2: np.ndarray) -> np.ndarray:
        """Upper bound of the inner product at a lower bound of the distance, with room for rounding."""
        return (q2 + self.length - distance * distance) / 2 + 1e-6 * (q2 + self.length) + 0.5


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(np.asarray(column.offsets))
    out = np.zeros((len(column), dims), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _near(rows: DataFrame, pivots: Pivots, dims: int) -> DataFrame:
    """The vectors with the number of their nearest pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dims).astype(float)
            cell = pivots.of_vectors(x).argmin(1) if len(x) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())], names=["vec_id", "v", "cell"])

    return rows.mapInArrow(run, "vec_id bigint, v array<bigint>, cell int")


def _packed(rows: DataFrame, number: Column, per_block: int, pivots: Pivots, dims: int, queries: bool) -> DataFrame:
    """Blocks of about ``per_block`` vectors of one cell: ids, vectors, pivot table, and its span per pivot."""
    counts = rows.groupBy("cell").agg((F.count(F.lit(1)) / per_block).cast("int").alias("last"))  # one row per pivot
    rows = rows.join(F.broadcast(counts), "cell").withColumn("part", F.pmod(F.xxhash64(number), F.col("last") + 1).cast("int"))
    packed = rows.groupBy("cell", "part").agg(F.collect_list(F.struct("vec_id", "v")).alias("r"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                structs = batch.column(2).slice(i, 1).flatten()
                ids = structs.field(0).to_numpy(zero_copy_only=False)
                x = _matrix(structs.field(1), dims)
                order = np.argsort(ids, kind="stable")
                ids, x = ids[order], x[order]
                d = pivots.of_queries(x.astype(float)) if queries else pivots.of_vectors(x.astype(float))
                out.append((batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), ids.tobytes(), x.tobytes(), d.tobytes(), d.min(0), d.max(0)))
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            cols = [pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(cols, names=["cell", "part", "ids", "vectors", "table", "low", "high"])

    kind = "cell int, part int, ids binary, vectors binary, table binary, low array<double>, high array<double>"
    return packed.mapInArrow(run, kind)


def _search(q, q_ids, q_table, limit, x, ids, table, pivots: Pivots, k: int, step: int = 512) -> list[tuple]:
    """Each query's k best of one block, among those that can reach its limit."""
    bound = np.abs(q_table[:, :1] - table[:, 0])
    for p in range(1, table.shape[1]):
        np.maximum(bound, np.abs(q_table[:, p : p + 1] - table[:, p]), out=bound)
    bound = pivots.product(bound, (q.astype(float) ** 2).sum(1)[:, None])
    out = []
    for i in range(len(q)):
        maybe = np.flatnonzero(bound[i] >= limit[i])
        maybe = maybe[np.argsort(-bound[i, maybe], kind="stable")]
        best_s, best_i, least = np.zeros(0, np.int64), np.zeros(0, np.int64), limit[i]
        for at in range(0, len(maybe), step):
            part = maybe[at : at + step]
            if bound[i, part[0]] < least:
                break
            part = part[ids[part] != q_ids[i]]
            best_s, best_i = np.append(best_s, x[part] @ q[i]), np.append(best_i, ids[part])
            order = np.lexsort((best_i, -best_s))[:k]
            best_s, best_i = best_s[order], best_i[order]
            if len(best_s) == k:
                least = max(least, float(best_s[-1]))
        out += [(int(q_ids[i]), int(v), int(s)) for v, s in zip(best_i, best_s, strict=True)]
    return out


def _scores(pairs: DataFrame, pivots: Pivots, dims: int, k: int) -> DataFrame:
    """Rows (q_ids, q_vectors, q_table, limits, ids, vectors, table) to (query_id, vec_id, score)."""
    n_pivots = len(pivots.p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = [batch.column(c)[i].as_buffer() for c in range(3)] + [batch.column(c)[i].as_buffer() for c in range(4, 7)]
                q_ids, ids = np.frombuffer(row[0], np.int64), np.frombuffer(row[3], np.int64)
                q, x = (np.frombuffer(row[c], np.int64).reshape(-1, dims) for c in (1, 4))
                q_table, table = (np.frombuffer(row[c], np.float64).reshape(-1, n_pivots) for c in (2, 5))
                known = dict(batch.column(3)[i].as_py() or [])
                limit = np.array([known.get(int(v), -np.inf) for v in q_ids])
                found = _search(q, q_ids, q_table, limit, x, ids, table, pivots, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in found], pa.int64()) for c in range(3)], names=["query_id", "vec_id", "score"]
                )

    return pairs.select("q_ids", "q_vectors", "q_table", "limits", "ids", "vectors", "table").mapInArrow(run, FOUND)


def top_k(
    vectors: DataFrame, is_query: Column, *, k: int = 5, scale: int = 256, pivots: int = 32, block: int = 4096, chunk: int = 512, groups: int = 48
) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k highest inner products with all other rows.

    Pivots are ``pivots`` vectors of smallest id hash; all vectors are indexed by them.
    """
    rows = stored(whole(vectors, scale), "topk-vectors")
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    top = rows.agg(F.max(length), F.max(F.size("v"))).first()
    if top[0] is None:
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    dims = top[1]
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()
    table = Pivots(np.array([list(r[1]) + [0] * (dims - len(r[1])) for r in chosen]), top[0])
    placed = stored(_near(rows, table, dims), "topk-cells")
    blocks = stored(_packed(placed, F.col("vec_id"), block, table, dims, False), "topk-blocks")
    asked = placed.where(is_query)
    names = {"ids": "q_ids", "vectors": "q_vectors", "table": "q_table", "low": "q_low", "high": "q_high"}
    queries = stored(_packed(asked, F.col("vec_id"), chunk, table, dims, True).withColumnsRenamed(names), "topk-queries")
    # the limit of a query: its k-th score in one block of its own cell
    home = queries.withColumn("limits", F.expr("cast(null as map<bigint, double>)")).join(blocks.where("part = 0").drop("part"), "cell")
    first = stored(_scores(home, table, dims, k), "topk-first")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    limits = first.withColumn("r", F.row_number().over(best)).where(f"r = {k}").select("query_id", F.col("score").cast("double").alias("limit"))
    of_query = placed.where(is_query).select(F.col("vec_id").alias("query_id"), "cell")
    counts = queries.groupBy("cell").agg((F.max("part") + 1).alias("n"))
    per_chunk = (
        limits.join(of_query.distinct(), "query_id")
        .join(F.broadcast(counts), "cell")
        .groupBy("cell", F.pmod(F.xxhash64("query_id"), F.col("n")).cast("int").alias("part"))
        .agg(F.map_from_entries(F.collect_list(F.struct("query_id", "limit"))).alias("limits"), F.min("limit").alias("least"), F.count(F.lit(1)).alias("limited"))
    )
    queries = stored(queries.join(per_chunk, ["cell", "part"], "left"), "topk-limits")
    # every chunk of queries meets every block whose bound reaches the lowest limit of the chunk
    gap = F.zip_with(
        F.zip_with("q_low", "high", lambda a, b: a - b), F.zip_with("low", "q_high", lambda a, b: a - b), lambda a, b: F.greatest(a, b, F.lit(0.0))
    )
    reach = (F.lit(2 * top[0]) - F.pow(F.array_max(gap), 2)) / 2 + 1e-6 * 2 * top[0] + 0.5
    # the stated queries meet all rows, in blocks: each chunk of queries is sent to every group of blocks
    group = F.pmod(F.xxhash64("cell", "part"), F.lit(groups)).cast("int").alias("group")
    grouped = blocks.select(group, "ids", "vectors", "table", "low", "high")
    copies = queries.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    pairs = by_merge(copies).join(grouped, "group")
    full = F.col("limited") == F.octet_length("q_ids") / 8
    pairs = pairs.where(~F.coalesce(full, F.lit(False)) | (reach >= F.col("least")))
    found = _scores(pairs, table, dims, k)
    ranked = found.withColumn("rank", F.row_number().over(best)).where(f"rank <= {k}")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
