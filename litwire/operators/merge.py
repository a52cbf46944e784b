"""Merging duplicate records.

Merging runs in two aggregations, by group and then by cluster, each with
map-side partials; lists that can grow with the data stay long tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litwire import fixed
from litwire.functions.text import fold_case, normalize_title, squeeze, stable_id
from litwire.operators.cluster import leader_clusters
from litwire.operators.identity import identity_key, with_group
from litwire.operators.joins import lookup_join
from litwire.session import cut


@dataclass
class Merged:
    """records: one row per item; members: item to input record;
    values: (id, head_ord, field, value, pos) for every multi-valued field."""

    records: DataFrame
    members: DataFrame
    values: DataFrame


def _present(column: str) -> Column:
    text = F.col(column).cast("string")
    return text.isNotNull() & (text != "")


def _first(column: str, order: str) -> Column:
    return F.min_by(F.col(column), F.when(_present(column), F.col(order))).alias(column)


def longest(column: str, order: str, *extra: str) -> Column:
    """The longest text, the earliest of equals, with columns that go along."""
    size = F.char_length(squeeze(F.coalesce(column, F.lit(""))))
    return F.max_by(F.struct(column, *extra), F.struct(size, -F.col(order)))


def merge_papers(papers: DataFrame, clusters: DataFrame) -> Merged:
    """``papers`` has group_key and ord; ``clusters`` has (group_key,
    group_ord, leader), one row per group."""
    fill = [c for c in [*fixed.FILL_FIELDS, "open_access_pdf"] if c in papers.columns]
    merged_elsewhere = {"authors", "publication_types", "source_ids", "full_text_urls", "full_text_links"}
    skip = {*fill, *merged_elsewhere, "abstract", "ord", "group_key", "key", "norm", "author"}
    kept = [c for c in papers.columns if c not in skip]
    by_group = papers.groupBy("group_key").agg(
        F.min_by(F.struct(*kept), "ord").alias("head"),
        F.min("ord").alias("ord"),
        F.count("*").alias("n"),
        longest("abstract", "ord", "source").alias("best"),
        *[_first(c, "ord") for c in fill],
    )
    placed = by_group.drop("ord").join(clusters, "group_key")
    best_size = F.struct(F.char_length(squeeze(F.coalesce("best.abstract", F.lit("")))), -F.col("group_ord"))
    by_leader = placed.groupBy("leader").agg(
        F.min_by("head", "group_ord").alias("head"),
        F.sum("n").alias("n_records"),
        F.max_by("best", best_size).alias("best"),
        *[_first(c, "group_ord") for c in fill],
    )
    lists = _paper_values(papers, clusters)
    flat = by_leader.select(
        F.col("leader").alias("ord"),
        *[F.col(f"head.{c}").alias(c) for c in kept],
        *fill,
        F.col("best.abstract").alias("abstract"),
        F.col("best.source").alias("abstract_source"),
        "n_records",
    )
    # The id follows the best identity known after merging.
    named = lists.groupBy(F.col("leader").alias("ord")).agg(
        F.min_by("value", F.when(F.col("field") == "authors", F.col("pos"))).alias("_author"),
        *[
            F.max_by("value", F.when(F.col("field") == f"id:{k}", F.col("pos"))).alias(f"_{k}")
            for k in ("pmid", "pmcid")
        ],
    )
    wide = flat.join(named, "ord", "left")
    key = identity_key(F.col("doi"), F.col("_pmid"), F.col("_pmcid"), F.col("title"), F.col("_author"), F.col("record_id"))
    records = cut(
        wide.withColumns({"paper_key": key, "paper_id": stable_id("paper-", key)}).drop("_author", "_pmid", "_pmcid")
    )
    ids = records.select(F.col("ord").alias("leader"), "paper_id")
    groups = clusters.join(ids, "leader").select("group_key", "paper_id")
    sizes = by_group.select("group_key", "n")
    members = lookup_join(papers.select("record_id", "ord", "group_key"), groups.join(sizes, "group_key"), "group_key", "n")
    values = lists.join(ids, "leader").withColumnRenamed("leader", "head_ord")
    return Merged(records, members.select("paper_id", "record_id", "ord"), values)


def _paper_values(papers: DataFrame, clusters: DataFrame) -> DataFrame:
    """(leader, field, value, pos): distinct values in first-seen order; of
    several ids of one kind the last one seen."""
    parts = []

    def add(field: Column, value: Column, place: Column, rows: DataFrame) -> None:
        parts.append(
            rows.select(
                "group_key",
                field.alias("field"),
                squeeze(value).alias("value"),
                F.struct(F.col("ord").alias("o"), place.cast("int").alias("i")).alias("pos"),
            ).where(F.col("value") != "")
        )

    add(F.lit("sources"), F.col("source"), F.lit(0), papers)
    for column in ("authors", "publication_types", "full_text_urls"):
        if column in papers.columns:
            rows = papers.select("group_key", "ord", F.posexplode(column).alias("i", "v"))
            add(F.lit(column), F.col("v"), F.col("i"), rows)
    if "full_text_links" in papers.columns:
        rows = papers.select("group_key", "ord", F.posexplode("full_text_links").alias("i", "v"))
        add(F.lit("full_text_links"), F.col("v.URL"), F.col("i"), rows)
    rows = papers.select("group_key", "ord", F.explode("source_ids").alias("k", "v"))
    add(F.concat(F.lit("id:"), "k"), F.col("v"), F.lit(0), rows)
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    is_id = F.col("field").startswith("id:")

    def collapse(df: DataFrame, group: str) -> DataFrame:
        # Paths of addresses depend on case.
        address = F.col("field").isin("full_text_urls", "full_text_links")
        same = F.when(is_id, F.lit("")).when(address, F.col("value")).otherwise(fold_case(F.col("value")))
        return (
            df.groupBy(group, "field", same.alias("_k"))
            .agg(
                F.min_by("value", "pos").alias("_first"),
                F.max_by("value", "pos").alias("_last"),
                F.min("pos").alias("_low"),
                F.max("pos").alias("_high"),
            )
            .select(
                group,
                "field",
                F.when(is_id, F.col("_last")).otherwise(F.col("_first")).alias("value"),
                F.when(is_id, F.col("_high")).otherwise(F.col("_low")).alias("pos"),
            )
        )

    by_group = collapse(rows, "group_key").join(clusters, "group_key")
    place = F.struct(F.col("group_ord").alias("g"), "pos.o", "pos.i")
    return collapse(by_group.select("leader", "field", "value", place.alias("pos")), "leader")


def attach_lists(papers: DataFrame, values: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Lists of a chosen few papers (an issue) as arrays, in order."""
    wanted = values.where(F.col("field").isin(*fields)).join(papers.select(F.col("ord").alias("head_ord")), "head_ord")
    lists = wanted.groupBy("head_ord").agg(
        *[
            F.transform(
                F.array_sort(F.collect_list(F.when(F.col("field") == f, F.struct("pos", "value")))), lambda x: x["value"]
            ).alias(f)
            for f in fields
        ]
    )
    return papers.join(lists.withColumnRenamed("head_ord", "ord"), "ord", "left")


def dedup_papers(papers: DataFrame, threshold: int = fixed.PAPER_TITLE_RATIO, block: str | None = None) -> Merged:
    """Identity groups, conflict split, title clustering and merge."""
    grouped = cut(with_group(papers, block))
    scope = F.col(block) if block else F.lit(0)
    names = F.filter(F.transform(F.coalesce("authors", F.array().cast("array<string>")), squeeze), lambda a: a != "")
    # The merged record's first author: that of the first record in the group that names one.
    lead = F.min_by("_lead", F.when(F.col("_lead").isNotNull(), F.col("ord")))
    items = cut(
        grouped.withColumns({"_b": scope, "_lead": F.get(names, F.lit(0))})
        .groupBy("group_key")
        .agg(
            F.min("ord").alias("group_ord"),
            F.min_by(F.struct(F.col("_b").alias("block"), "norm", "author"), "ord").alias("t"),
            F.when(F.count("*") > 1, F.coalesce(normalize_title(lead), F.lit(""))).alias("merged_author"),
        )
        .select("group_key", "group_ord", "t.block", "t.norm", F.coalesce("merged_author", "t.author").alias("author"))
        .withColumn("title_key", F.sha2(F.concat_ws("|", F.col("block").cast("string"), "norm", "author"), 256))
    )
    titles = items.groupBy("title_key", "block", "norm", "author").agg(
        F.min("group_ord").alias("ord"), F.count("*").alias("n")
    )
    clusters = leader_clusters(titles.select("block", "ord", "norm", "author"), threshold)
    leaders = titles.select("title_key", "ord", "n").join(clusters, "ord").select("title_key", "n", "leader")
    mapping = lookup_join(items.select("group_key", "group_ord", "title_key"), leaders, "title_key", "n")
    return merge_papers(grouped, cut(mapping.select("group_key", "group_ord", "leader")))


def dedup_news(news: DataFrame, threshold: int = fixed.NEWS_TITLE_RATIO, block: str | None = None) -> Merged:
    """News with like titles becomes one item with the head's fields, the
    longest excerpt, and its other sources as a long table."""
    scope = F.col(block) if block else F.lit(0)
    rows = cut(
        news.withColumns({"norm": normalize_title(F.col("title")), "_b": scope})
        .where(F.col("norm") != "")
        .withColumn("title_key", F.sha2(F.concat_ws("|", F.col("_b").cast("string"), "norm"), 256))
    )
    kept = [c for c in news.columns if c not in ("excerpt", "ord")]
    by_title = cut(
        rows.groupBy("title_key", F.col("_b").alias("block"), "norm").agg(
            F.min("ord").alias("ord"),
            F.count("*").alias("n"),
            F.min_by(F.struct(*kept), "ord").alias("head"),
            longest("excerpt", "ord").alias("best"),
        )
    )
    clusters = leader_clusters(by_title.select("block", "ord", "norm"), threshold)
    placed = cut(by_title.join(clusters, "ord"))
    size = F.struct(F.char_length(squeeze(F.coalesce("best.excerpt", F.lit("")))), -F.col("ord"))
    merged = placed.groupBy("leader").agg(
        F.min_by("head", "ord").alias("head"),
        F.min_by("norm", "ord").alias("norm"),
        F.max_by("best", size).alias("best"),
        F.sum("n").alias("n_records"),
    )
    day = F.coalesce(F.col("head.published_date").cast("string"), F.lit(""))
    records = cut(
        merged.select(
            F.col("leader").alias("ord"),
            *[F.col(f"head.{c}").alias(c) for c in kept],
            F.col("best.excerpt").alias("excerpt"),
            "norm",
            stable_id("news-", F.concat("norm", F.lit("|"), day)).alias("news_id"),
            "n_records",
        )
    )
    ids = placed.join(records.select(F.col("ord").alias("leader"), "news_id"), "leader")
    members = lookup_join(rows, ids.select("title_key", "n", "news_id", "leader"), "title_key", "n")
    values = members.where(F.col("ord") != F.col("leader")).select(
        "news_id", "leader", "source", "url", "publisher", "ord"
    )
    return Merged(records, members.select("news_id", "record_id", "ord"), values)
