"""Exact top-k by inner product: vectors by descending length, bounds on rotated partial sums.

Vectors are turned into integers once and dealt to blocks by descending
length. The block of the longest ones gives every query a first threshold, and
so the length below which no vector can matter: a query meets only the blocks
before it. Within a block, queries and vectors are rotated onto the principal
axes (from the Gram matrix of all vectors), a partial product over the first
axes plus the product of the residual lengths (Cauchy-Schwarz) bounds each
score, and only pairs that reach the threshold get an exact integer product.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litwire.session import cut

SCALE = 256
BLOCK, TILE = 8192, 1024
QUERY_BLOCK, QUERY_BLOCKS = 512, 8
SLACK = 1e-6


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """vec_id, dim, squared length and integer components (32 bits each); vectors with gaps are left out."""
    # Rows without id have nothing to be called by in the result.
    taken = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))

    def convert(batches):
        for batch in batches:
            ids, dims, norms, packed = [], [], [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if not v.is_valid or not len(v.values) or v.values.null_count:
                    continue
                x = np.asarray(v.values)
                if not np.isfinite(x).all():
                    continue
                q = np.floor(scale * x)
                if np.abs(q).max() >= 1 << 26:
                    raise ValueError(f"a component of vector {i} is out of range for exact integer scores")
                q = q.astype(np.int64)
                ids.append(i)
                dims.append(len(q))
                norms.append(int(q @ q))
                packed.append(q.astype(np.int32).tobytes())
            arrays = [pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(norms, pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "dim", "norm", "v"])

    return taken.mapInArrow(convert, "vec_id long, dim int, norm long, v binary")


def _matrix(packed) -> np.ndarray:
    rows = list(packed)
    return np.frombuffer(b"".join(rows), np.int32).reshape(len(rows), -1).astype(np.float64)


def principal_axes(table: DataFrame) -> dict[int, np.ndarray]:
    """Per dimension the orthogonal axes of all vectors, the strongest first."""

    def gram(batches):
        sums: dict[int, np.ndarray] = {}
        for pdf in batches:
            for dim, group in pdf.groupby("dim"):
                x = _matrix(group["v"])
                sums[dim] = sums.get(dim, 0) + x.T @ x
        for dim, total in sums.items():
            yield pd.DataFrame({"dim": [dim], "salt": [hash(total.tobytes()) % 32], "gram": [total.tobytes()]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(g) for g in group["gram"])
        return pd.DataFrame({"dim": [group["dim"].iloc[0]], "gram": [total.tobytes()]})

    parts = table.select("dim", "v").mapInPandas(gram, "dim int, salt int, gram binary")
    once = parts.groupBy("dim", "salt").applyInPandas(add, "dim int, gram binary")
    axes = {}
    for row in once.groupBy("dim").applyInPandas(add, "dim int, gram binary").collect():  # one matrix per dimension
        dim = row["dim"]
        _, _, rotated = np.linalg.svd(np.frombuffer(row["gram"]).reshape(dim, dim))
        axes[dim] = rotated.T
    return axes


class Best:
    """The k best (score, id) of each query so far; ties go to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k, self.rows = k, [np.empty((0, 2), np.int64)] * queries

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        starts = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1])))
        for start, end in zip(starts, [*starts[1:], len(query)], strict=True):
            end = min(end, start + self.k)
            rows = np.concatenate((self.rows[query[start]], np.stack((score[start:end], ids[start:end]), 1)))
            self.rows[query[start]] = rows[np.lexsort((rows[:, 1], -rows[:, 0]))][: self.k]

    def thresholds(self, least: np.ndarray) -> np.ndarray:
        own = np.array([r[-1, 0] if len(r) == self.k else -np.inf for r in self.rows])
        return np.maximum(own, least)


def search_block(q: np.ndarray, qid: np.ndarray, least: np.ndarray, x: np.ndarray, xid: np.ndarray, axes: np.ndarray, k: int) -> Best:
    """The k best of block ``x`` (by descending length) for each query, as far as they reach ``least``."""
    best, head = Best(len(q), k), max(1, x.shape[1] // 4)
    qr, xr = q @ axes, x @ axes
    q_rest, x_rest = (np.sqrt(np.maximum((m[:, head:] ** 2).sum(1), 0)) for m in (qr, xr))
    q_norm, x_norm = np.sqrt((q**2).sum(1)), np.sqrt((x**2).sum(1))
    for at in range(0, len(x), TILE):
        tile = slice(at, at + TILE)
        least = best.thresholds(least)
        slack = SLACK * (1 + q_norm * x_norm[at])
        live = np.flatnonzero(q_norm * x_norm[at] + slack >= least)
        if not len(live):
            break
        bound = qr[live, :head] @ xr[tile, :head].T + np.outer(q_rest[live], x_rest[tile])
        rows, cols = np.nonzero((bound + slack[live, None] >= least[live, None]) & (qid[live, None] != xid[None, tile]))
        rows, cols = live[rows], cols + at
        for part in range(0, len(rows), 1 << 16):
            r, c = rows[part : part + (1 << 16)], cols[part : part + (1 << 16)]
            score = np.einsum("ij,ij->i", q[r].astype(np.int64), x[c].astype(np.int64))
            good = score >= least[r]
            if good.any():
                best.add(r[good], score[good], xid[c[good]])
    return best


def top_inner_products(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows for each row of ``vectors`` that ``is_query`` holds for.

    Components become floor(scale * x); the score is their exact integer
    product. Ties go to the smaller id. Vectors that are null or empty or hold
    null or non-finite components take no part, nor do rows without id.
    Equal rows count once; rows with one id and different vectors are rows of
    their own, as queries and as candidates, ranked under that id. Rows with a query's id are not its candidates.
    Vectors meet only vectors of their own length. Components beyond 2**26
    after scaling raise an error. Other columns are left aside; an empty table
    gives an empty table.
    """
    queried = vectors.withColumn("_q", is_query).where("_q").select(F.col(id_col).cast("long").alias("vec_id")).distinct()
    table = cut(integer_vectors(vectors, id_col, vec_col, scale).dropDuplicates())
    total, spark = table.count(), vectors.sparkSession
    blocks = max(1, -(-total // BLOCK))
    ordered = table.repartitionByRange(blocks, F.desc("norm"), "vec_id") if blocks > 1 else table.coalesce(1)
    ordered = cut(ordered.withColumn("cb", F.spark_partition_id()))
    tops = ordered.groupBy("cb", "dim").agg(F.max("norm").alias("norm")).collect()  # a number per block
    axes = principal_axes(ordered)
    first = min((r["cb"] for r in tops), default=0)
    lead = ordered.where(F.col("cb") == first).select("vec_id", "dim", "norm", "v").limit(2 * BLOCK).toPandas()
    lead = lead.sort_values(["norm", "vec_id"], ascending=[False, True])
    heads = {d: (g["vec_id"].to_numpy(), _matrix(g["v"])) for d, g in lead.groupby("dim")}
    limits = {d: sorted(((float(np.sqrt(r["norm"])), r["cb"]) for r in tops if r["dim"] == d), reverse=True) for d in axes}
    shared = spark.sparkContext.broadcast((axes, heads, limits))

    queries = ordered.join(queried, "vec_id", "left_semi").select("vec_id", "dim", "v")
    asked = queries.count()
    queries = queries.withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-asked // QUERY_BLOCK)))).cast("int"))

    def start(group: pd.DataFrame) -> pd.DataFrame:
        axes, heads, limits = shared.value
        dim, q, qid = int(group["dim"].iloc[0]), _matrix(group["v"]), group["vec_id"].to_numpy()
        least = np.full(len(q), -np.inf)
        if dim in heads:
            ids, x = heads[dim]
            least = search_block(q, qid, least, x, ids, axes[dim], k).thresholds(least)
        length = np.maximum(np.sqrt((q**2).sum(1)), 1e-300)
        reach = (least - SLACK * (1 + np.abs(least))) / length
        reach = np.where(least <= 0, -np.inf, reach).min()
        meets = [cb for norm, cb in limits[dim] if norm >= reach]
        packed = (qid.tobytes(), q.astype(np.int32).tobytes(), least.tobytes())
        qb = int(group["qb"].iloc[0])
        rows = [(cb, dim, qb // QUERY_BLOCKS, *packed) for cb in meets]
        return pd.DataFrame(rows, columns=["cb", "dim", "qg", "ids", "q", "least"])

    plans = queries.groupBy("dim", "qb").applyInPandas(start, "cb int, dim int, qg int, ids binary, q binary, least binary")
    plans = cut(plans)
    meet = plans.select("cb", "dim", "qg").distinct()
    facing = meet.join(ordered, ["cb", "dim"]).select(F.col("cb").alias("xcb"), F.col("dim").alias("xdim"), F.col("qg").alias("xqg"), "vec_id", "norm", "v")

    def meet_block(plan: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        axes, found = shared.value[0], []
        if len(plan) and len(block):
            block = block.sort_values(["norm", "vec_id"], ascending=[False, True])
            x, xid = _matrix(block["v"]), block["vec_id"].to_numpy()
            for _, row in plan.iterrows():
                qid = np.frombuffer(row["ids"], np.int64)
                q = np.frombuffer(row["q"], np.int32).reshape(len(qid), -1).astype(np.float64)
                best = search_block(q, qid, np.frombuffer(row["least"]), x, xid, axes[int(row["dim"])], k)
                found += [(i, int(vid), int(score)) for i, rows in zip(qid, best.rows, strict=True) for score, vid in rows]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    found = plans.groupBy("cb", "dim", "qg").cogroup(facing.groupBy("xcb", "xdim", "xqg")).applyInPandas(meet_block, "query_id long, vec_id long, score long")
    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", order).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
