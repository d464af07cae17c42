"""Nearest neighbours by largest inner product: a block matrix join in int8 with error bounds.

Queries and candidates are dealt to tiles; every query tile meets every candidate tile.
Within a pair of tiles vectors are quantised to int8 with a scale each, and one matrix
product of the int8 values (exact, as all sums stay below 2 ** 24 per part) approximates all
inner products. With x = s (q + e), |e| <= 1/2 in each component,

    |x . y - s t (q . r)| <= s t (|q|_1 + |r|_1) / 2 + s t d / 4 ,

so each product has a known error bound. A pair survives if its upper bound reaches the
k-th largest lower bound of its query; survivors are computed again from the original
vectors in double precision, component after component, and kept in a heap per query.
Heaps of the tiles are merged by rank. Nothing is lost: the result is exact.

Defined results: vectors that are null, empty, all zero or hold null or non-finite
components take no part; only vectors of one length are compared; a query is never its own
neighbour, but another row with its id or vector may be; ties go to the smaller id; with
fewer candidates than ``k`` all are returned; an empty table gives an empty result.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelane.session import materialize

K = 20
QUERY_TILE = 1024
CANDIDATE_TILE = 16_384
#: Candidates per matrix product, and components per exact sum of int8 products.
STEP = 2048
EXACT = 1024


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """int8 values (as float32) and the scale of each vector."""
    scale = np.abs(vectors).max(1) / 127
    scale = np.where(scale > 0, scale, 1.0)  # the smallest numbers underflow to 0
    return np.rint(vectors / scale[:, None]).astype(np.float32), scale


def bounded_products(q, s, r, t) -> tuple[np.ndarray, np.ndarray]:
    """Approximate inner products of two quantised tiles, and their error bounds."""
    dims = q.shape[1]
    total = np.zeros((len(q), len(r)))
    for at in range(0, dims, EXACT):
        total += q[:, at : at + EXACT] @ r[:, at : at + EXACT].T
    sums = np.abs(q).sum(1, dtype=np.float64)[:, None] + np.abs(r).sum(1, dtype=np.float64)[None, :]
    scales = s[:, None] * t[None, :]
    # The last factor covers rounding of the scales and of these few operations.
    return total * scales, scales * (sums / 2 + dims / 4) * (1 + 1e-9)


def exact_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed in order of the components."""
    total = np.zeros(len(x))
    for d in range(x.shape[1]):
        total += x[:, d] * y[:, d]
    return total


def tile_neighbours(query_ids, query_rows, queries, ids, rows, vectors, k: int):
    """For each query its best candidates of one tile: (query number, score, id, row)."""
    q, s = quotient = quantised(queries)
    heaps: list[list[tuple[float, int, int]]] = [[] for _ in queries]
    floor = np.full(len(queries), -np.inf)
    for at in range(0, len(vectors), STEP):
        block = slice(at, at + STEP)
        product, error = bounded_products(*quotient, *quantised(vectors[block]))
        own = query_rows[:, None] == rows[block][None, :]
        low = np.where(own, -np.inf, product - error)
        if low.shape[1] > k:
            kth = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
            floor = np.maximum(floor, kth)
        left, right = np.nonzero((product + error >= floor[:, None]) & ~own)
        for part in range(0, len(left), 1 << 16):
            i, j = left[part : part + (1 << 16)], right[part : part + (1 << 16)] + at
            scores = exact_products(queries[i], vectors[j])
            for n, score, c in zip(i.tolist(), scores.tolist(), j.tolist()):
                heap, entry = heaps[n], (score, -int(ids[c]), int(rows[c]))
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
        full = [n for n, heap in enumerate(heaps) if len(heap) == k]
        floor[full] = np.maximum(floor[full], [heaps[n][0][0] for n in full])
    return [(n, score, -minus, row) for n, heap in enumerate(heaps) for score, minus, row in heap]


def nearest(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", is_query: Column | None = None, k: int = K,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score) for the rows of ``df`` where ``is_query`` holds
    (the default: an id divisible by 20), against all other rows."""
    chosen = (df[vec_id] % 20 == 0) if is_query is None else is_query
    numbers = df[vector].cast("array<double>")
    rows = materialize(
        df.where(df[vec_id].isNotNull()).select(
            df[vec_id].cast("long").alias("vec_id"), numbers.alias("v"), chosen.alias("query")
        ).where(usable(F.col("v"))).select(
            # Rows are told apart by number, since ids and vectors may repeat.
            F.monotonically_increasing_id().alias("row"), "vec_id", "v",
            F.coalesce("query", F.lit(False)).alias("query"), F.size("v").alias("dims")),
        "vectors",
    )
    sizes = rows.groupBy("dims").agg(
        F.ceil(F.count("*") / CANDIDATE_TILE).cast("int").alias("c_tiles"),
        F.ceil(F.count_if("query") / QUERY_TILE).cast("int").alias("q_tiles"),
    ).where("q_tiles > 0")
    # One row per vector length.
    rows = rows.join(F.broadcast(sizes), "dims")
    tile = lambda n: F.pmod(F.xxhash64("row"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    queries = rows.where("query").select(
        "dims", tile(F.col("q_tiles")).alias("qt"), every("c_tiles").alias("ct"), "row", "vec_id", "v")
    named = lambda *names: [F.col(n).alias(n) for n in names]  # new columns, for the join
    candidates = rows.select(
        *named("dims"), every("q_tiles").alias("qt"), tile(F.col("c_tiles")).alias("ct"),
        *named("row", "vec_id", "v"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        def parts(table):
            ids, numbers = table["vec_id"].to_numpy(), table["row"].to_numpy()
            flat = table["v"].combine_chunks().flatten().to_numpy()
            return ids, numbers, flat.reshape(len(ids), -1)

        if not left.num_rows or not right.num_rows:
            found, query_ids, query_rows = [], np.zeros(0, int), np.zeros(0, int)
        else:
            query_ids, query_rows, _ = own = parts(left)
            found = tile_neighbours(*own, *parts(right), k)
        n, score, ids, numbers = zip(*found) if found else ((),) * 4
        n = np.array(n, np.int64)
        return pa.table({
            "query_row": pa.array(query_rows[n], pa.int64()), "query_id": pa.array(query_ids[n], pa.int64()),
            "score": pa.array(score, pa.float64()), "vec_id": pa.array(ids, pa.int64()),
            "row": pa.array(numbers, pa.int64())})

    keys = ["dims", "qt", "ct"]
    met = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(
        meet, "query_row long, query_id long, score double, vec_id long, row long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
