"""Counts per issue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def issue_metrics(papers: DataFrame, news: DataFrame, raw_papers: DataFrame, raw_news: DataFrame, by: str = "profile_id") -> DataFrame:
    """One row per profile: totals before and after merging, counts by type
    and accepted translations. Each input is aggregated once, then joined."""

    def translated():
        return F.count_if(F.coalesce(F.col("title_translated"), F.lit(False)))

    p = papers.groupBy(by).agg(
        F.count("*").alias("papers"),
        F.count_if(F.col("paper_type") == "research").alias("research"),
        F.count_if(F.col("paper_type") == "review").alias("reviews"),
        translated().alias("_tp"),
    )
    n = news.groupBy(by).agg(F.count("*").alias("news"), translated().alias("_tn"))
    rp = raw_papers.groupBy(by).agg(F.count("*").alias("raw_papers"))
    rn = raw_news.groupBy(by).agg(F.count("*").alias("raw_news"))
    joined = rp.join(rn, by, "full").join(p, by, "full").join(n, by, "full")
    names = ["raw_papers", "papers", "research", "reviews", "raw_news", "news"]
    zero = F.lit(0)
    return joined.select(
        by,
        *[F.coalesce(c, zero).alias(c) for c in names],
        (F.coalesce("_tp", zero) + F.coalesce("_tn", zero)).alias("translated"),
    )


def type_rollup(df: DataFrame, levels: Sequence[str], *measures) -> DataFrame:
    """Counts for every level, subtotals and the total in one pass."""
    return df.rollup(*levels).agg(F.count("*").alias("n"), *measures)
