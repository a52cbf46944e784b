"""Choosing among logged answers, with a fallback when none is valid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIN_ELEMENTS = 3


def filled_elements(elements: Sequence[Column]) -> Column:
    return sum((F.coalesce((F.trim(e) != "").cast("int"), F.lit(0)) for e in elements), F.lit(0))


def answer_valid(elements: Sequence[Column], least: int = MIN_ELEMENTS) -> Column:
    """At least three of the required elements are filled."""
    return filled_elements(elements) >= least


def first_valid(
    attempts: DataFrame,
    valid: Column,
    providers: Sequence[str],
    models_per_provider: int = 3,
    task: str = "task_id",
    payload: str = "payload",
) -> DataFrame:
    """First valid answer per task by provider order, then model order.

    Only the first models of each provider count. ``failed_before`` is the
    number of attempts that came earlier; their log stays in ``attempts``.
    """
    rank = F.array_position(F.array(*[F.lit(p) for p in providers]), F.col("provider"))
    place = F.row_number().over(Window.partitionBy(task, "provider").orderBy("model_rank"))
    tried = attempts.withColumn("_p", rank).where(F.col("_p") > 0).withColumn("_m", place)
    tried = tried.where(F.col("_m") <= models_per_provider).withColumn("_ok", valid)
    order = F.struct("_p", "_m")
    wanted = F.struct("provider", "model", F.col(payload).alias("payload"), order.alias("at"))
    # At most models_per_provider rows per provider and task remain here, so
    # both steps below work on groups of bounded size.
    best = Window.partitionBy(task)
    marked = tried.withColumn("_won", F.min(F.when(F.col("_ok"), order)).over(best))
    return (
        marked.groupBy(task)
        .agg(
            F.min_by(wanted, F.when(F.col("_ok"), order)).alias("w"),
            F.count_if(F.col("_won").isNull() | (order < F.col("_won"))).alias("failed_before"),
        )
        .select(task, "w.provider", "w.model", "w.payload", "failed_before")
    )


def resolve(tasks: DataFrame, answers: DataFrame, fallback: Column, task: str = "task_id") -> DataFrame:
    """Every task with its answer, or the fallback where there is none."""
    found = answers.select(task, "provider", "model", "payload")
    joined = tasks.join(found, task, "left")
    return joined.withColumn(
        "status", F.when(F.col("payload").isNotNull(), "passed").otherwise("fallback_source_extract")
    ).withColumn("payload", F.coalesce("payload", fallback))
