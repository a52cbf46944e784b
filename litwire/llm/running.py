"""Running sums in a total order, without a group in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litwire.session import cut

#: How totals of earlier pieces are added to a running value.
COMBINE: dict[Callable, Callable[[Column, Column], Column]] = {F.sum: lambda a, b: a + b, F.bit_xor: lambda a, b: a.bitwiseXOR(b)}


def running(df: DataFrame, by: list[str], order: list[Column], values: dict[str, tuple[Callable, Column]]) -> DataFrame:
    """``df`` with one running value per entry of ``values`` (aggregate, non-null column), this row included.

    ``order`` must be total within ``by``, or ties must not matter. Rows are
    dealt to pieces by range, so a group of any size is shared by several of
    them. Each piece has its own running values; only groups on a border
    between pieces, at most two a piece, need totals of earlier pieces.
    """
    spark, keys = df.sparkSession, [F.col(c) for c in by]
    pieces = spark.sparkContext.defaultParallelism * 4
    # Written once: the bounds are sampled, and both uses need the same ones.
    placed = cut(df.repartitionByRange(pieces, *keys, *order).withColumn("_piece", F.spark_partition_id()))
    totals = placed.groupBy(*by, "_piece").agg(*[agg(value).alias(f"_t_{name}") for name, (agg, value) in values.items()])
    group = Window.partitionBy(*by)
    totals = totals.withColumn("_pieces", F.count("*").over(group)).where("_pieces > 1")
    before = group.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    sums = [agg(f"_t_{name}").over(before).alias(f"_b_{name}") for name, (agg, _) in values.items()]
    borders = totals.select(*[F.col(c).alias(f"_g_{c}") for c in by], F.col("_piece").alias("_g_piece"), *sums)
    inside = Window.partitionBy("_piece", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = placed.select("*", *[agg(value).over(inside).alias(f"_i_{name}") for name, (agg, value) in values.items()])
    same = F.col("_piece") == F.col("_g_piece")
    for c in by:
        same &= F.col(c) == F.col(f"_g_{c}")
    joined = rows.join(F.broadcast(borders), same, "left")
    results = []
    for name, (agg, _) in values.items():
        results.append(COMBINE[agg](F.col(f"_i_{name}"), F.coalesce(f"_b_{name}", F.lit(0))).alias(name))
    return joined.select(*df.columns, *results)
