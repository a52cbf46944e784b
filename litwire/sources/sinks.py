"""Publishing: snapshots, history index, audit lines, feed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litwire import fixed
from litwire.operators.ranking import top_k


def write_issue(df: DataFrame, path: str) -> None:
    """Replace the partitions (profile_id, issue_date) present in ``df``.

    Rebalancing puts a partition into few files and still splits a large one.
    """
    (
        df.hint("rebalance", "profile_id", "issue_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("profile_id", "issue_date")
        .parquet(path)
    )


def latest_issue(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest issue of every profile; old partitions are pruned
    by the join on partition columns."""
    issues = spark.read.parquet(path)
    newest = issues.groupBy("profile_id").agg(F.max("issue_date").alias("issue_date"))
    return issues.join(newest, ["profile_id", "issue_date"], "left_semi")


def update_index(old: DataFrame, new: DataFrame, keep: int = fixed.HISTORY_ROWS, by: Sequence[str] = ("profile_id",)) -> DataFrame:
    """New issues replace old ones of the same date; newest first, capped."""
    key = [*by, "issue_date"]
    both = old.join(new.select(*key), key, "left_anti").unionByName(new)
    return top_k(both, keep, [F.col("issue_date").desc()], by, name="pos")


def write_audit(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Append one JSON line per record."""
    df.select(*columns).write.mode("append").json(path)


def feed_rows(papers: DataFrame, news: DataFrame, items: int = fixed.FEED_ITEMS) -> DataFrame:
    """First papers and news as (kind, rank, title, link, summary).

    Both inputs have issue_rank, title, title_zh, summary_zh, url; papers a
    doi, news a resolved_url.
    """

    def rows(df: DataFrame, kind: str, link) -> DataFrame:
        return df.where(F.col("issue_rank") <= items).select(
            "profile_id",
            F.lit(kind).alias("kind"),
            F.col("issue_rank").alias("rank"),
            F.coalesce(F.when(F.col("title_zh") != "", F.col("title_zh")), F.col("title")).alias("title"),
            link.alias("link"),
            F.coalesce("summary_zh", F.lit("")).alias("summary"),
        )

    doi = F.concat(F.lit("https://doi.org/"), F.when(F.col("doi") != "", F.col("doi")))
    paper_link = F.coalesce(doi, "url", F.lit(""))
    news_link = F.coalesce("resolved_url", "url", F.lit(""))
    return rows(papers, "paper", paper_link).unionByName(rows(news, "news", news_link))
