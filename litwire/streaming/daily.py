"""The daily re-run as streams: sliding windows, first-seen records, upserts.

Watermarks are on arrival time. Publication dates stay plain columns, because
old-dated and undated records are still accepted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from litwire import fixed


def sliding_issue_counts(
    arrivals: DataFrame, by: Sequence[str], ts: str = "ts", days: int = fixed.WINDOW_DAYS, late: str = "1 day"
) -> DataFrame:
    """Records per window of ``days`` + 1 calendar dates, moved by a day.

    Works on static and streaming frames alike.
    """
    rows = arrivals.withWatermark(ts, late) if arrivals.isStreaming else arrivals
    window = F.window(ts, f"{days + 1} days", "1 day")
    return (
        rows.groupBy(window.alias("w"), *by)
        .agg(F.count("*").alias("n"))
        .select(
            F.to_date("w.start").alias("window_start"),
            F.date_sub(F.to_date("w.end"), 1).alias("window_end"),
            *by,
            "n",
        )
    )


def first_seen(arrivals: DataFrame, key: Sequence[str], ts: str = "ts", late: str = "8 days") -> DataFrame:
    """The first arrival of each key; state is dropped after the watermark."""
    if arrivals.isStreaming:
        return arrivals.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(key))
    kept = [c for c in arrivals.columns if c not in key]
    best = arrivals.groupBy(*key).agg(F.min_by(F.struct(*kept), ts).alias("r"))
    return best.select(*key, *[F.col(f"r.{c}").alias(c) for c in kept])


def run_once(df: DataFrame, path: str, checkpoint: str) -> None:
    """Append all available rows of an append-mode stream to ``path``."""
    query = (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()


def upsert_batches(
    df: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None], mode: str = "update"
) -> StreamingQuery:
    """Give every micro-batch to ``apply``; it must be safe to repeat, as a
    batch is run again after a failure."""
    return (
        df.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(apply)
        .start()
    )


def write_updates(path: str) -> Callable[[DataFrame, int], None]:
    """Sink for ``upsert_batches``: one folder per batch, replaced on retry."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return apply


def latest_updates(updates: DataFrame, key: Sequence[str]) -> DataFrame:
    """The last state of each key from folders written by ``write_updates``."""
    kept = [c for c in updates.columns if c not in (*key, "batch_id")]
    last = updates.groupBy(*key).agg(F.max_by(F.struct(*kept), "batch_id").alias("r"))
    return last.select(*key, *[F.col(f"r.{c}").alias(c) for c in kept])
