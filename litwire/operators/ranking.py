"""Global order and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litwire import fixed
from litwire.session import cut


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "ord", by: Sequence[str] = ()) -> DataFrame:
    """Exact 1-based position in a total order, optionally within ``by``.

    A range shuffle sorts the rows in pieces; each piece counts its own rows
    and the offsets are summed over pieces, so no task ever holds a whole
    group. The sorted rows are written once, because range bounds are sampled
    and must not change between the two uses.
    """
    pieces = df.sparkSession.sparkContext.defaultParallelism * 4
    keys = [F.col(c) for c in by] + list(order)
    placed = cut(
        df.repartitionByRange(pieces, *keys).withColumn("_piece", F.spark_partition_id())
    )
    inside = Window.partitionBy(*by, "_piece").orderBy(*order)
    across = Window.partitionBy(*by).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(*by, "_piece").agg(F.count("*").alias("_n"))
    if by:
        offsets = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(across), F.lit(0)))
    else:
        # One row per piece: a handful of numbers, fit for one literal map.
        total, rows = 0, []
        for piece, n in sorted((r["_piece"], r["_n"]) for r in sizes.collect()):
            rows.append((piece, total))
            total += n
        offsets = df.sparkSession.createDataFrame(rows or [(0, 0)], "_piece int, _before long")
    numbered = placed.withColumn("_rn", F.row_number().over(inside))
    return (
        numbered.join(F.broadcast(offsets) if not by else offsets, [*by, "_piece"])
        .withColumn(name, F.col("_rn") + F.col("_before"))
        .drop("_piece", "_rn", "_before", "_n")
    )


def top_k(df: DataFrame, k: int, order: Sequence[Column], by: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """First ``k`` rows of each group with their rank.

    The rank filter lets Spark cut every partition to k rows per group before
    the shuffle, so a hot group sends k rows per map task only.
    """
    if not by:
        return df.orderBy(*order).limit(k).withColumn(name, F.row_number().over(Window.orderBy(*order)))
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col(name) <= k)


def _newest(date: str, ord_col: str) -> list[Column]:
    return [F.col(date).desc_nulls_last(), F.col("relevance_score").desc_nulls_last(), F.col(ord_col)]


def top_papers(papers: DataFrame, k: int = fixed.MAX_PAPERS, by: Sequence[str] = ("profile_id",), ord_col: str = "ord") -> DataFrame:
    return top_k(papers, k, _newest("availability_date", ord_col), by, name="issue_rank")


def top_news(news: DataFrame, k: int = fixed.MAX_NEWS, by: Sequence[str] = ("profile_id",), ord_col: str = "ord") -> DataFrame:
    return top_k(news, k, _newest("published_date", ord_col), by, name="issue_rank")


def capped_batches(df: DataFrame, id_col: str, order: str, per_query: int, by: Sequence[str] = (), cap: int = fixed.ID_CAP, size: int = fixed.ID_BATCH) -> DataFrame:
    """Distinct ids capped per query, then overall, in numbered batches."""
    first = df.groupBy(*by, id_col).agg(F.min(order).alias("_first"))
    kept = top_k(first, per_query, [F.col("_first"), F.col(id_col)], by, name="query_rank") if by else first
    ids = kept.groupBy(id_col).agg(F.min(F.struct("_first", *by)).alias("_s"))
    numbered = top_k(ids, cap, [F.col("_s"), F.col(id_col)], name="pos")
    return numbered.select(id_col, "pos", F.floor((F.col("pos") - 1) / size).alias("batch"))
