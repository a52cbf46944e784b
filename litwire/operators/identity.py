"""Which paper records share an identity, and which only share an identifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litwire import fixed
from litwire.functions.fuzzy import indel_ratio
from litwire.functions.text import blank_to_null, family_name, normalize_title, squeeze
from litwire.operators.joins import lookup_join
from litwire.session import cut


def identity_key(
    doi: Column, pmid: Column, pmcid: Column, title: Column, first_author: Column, record_id: Column
) -> Column:
    """DOI, else PMID, else PMCID, else normalised title and first author.

    A title without words falls back to the record's own id.
    """

    def named(prefix: str, value: Column) -> Column:
        return F.concat(F.lit(prefix), blank_to_null(F.lower(squeeze(value))))

    words = blank_to_null(normalize_title(title))
    author = normalize_title(F.coalesce(first_author, F.lit("")))
    return F.coalesce(
        named("doi:", doi),
        named("pmid:", pmid),
        named("pmcid:", pmcid),
        F.concat(F.lit("title:"), words, F.lit("|author:"), author),
        F.concat(F.lit("record:"), record_id),
    )


def with_identity(papers: DataFrame) -> DataFrame:
    """Add ``key``, ``norm`` and the normalised first ``author``."""
    first = F.get("authors", F.lit(0))
    ids = F.col("source_ids")
    key = identity_key(F.col("doi"), ids["pmid"], ids["pmcid"], F.col("title"), first, F.col("record_id"))
    return papers.where(F.col("title") != "").withColumns(
        {
            "key": key,
            "norm": normalize_title(F.col("title")),
            "author": F.coalesce(normalize_title(first), F.lit("")),
        }
    )


def split_conflicts(papers: DataFrame) -> DataFrame:
    """Records whose shared identifier is likely wrong, as (ord, title_score).

    Within a key, a record conflicts if its title is below the threshold
    against the head's and it shares no family name with the head or any
    record merged before it. Family names spread from merged records in
    ``ord`` order until nothing changes, which gives the sequential result.
    """
    names = F.array_distinct(
        F.filter(F.transform(F.coalesce("authors", F.array()), family_name), lambda f: f != "")
    )
    records = papers.select("key", "norm", "ord", names.alias("families"))
    heads = (
        records.groupBy("key")
        .agg(
            F.min_by("norm", "ord").alias("head_norm"),
            F.min("norm").alias("_low"),
            F.max("norm").alias("_high"),
            F.count("*").alias("n"),
        )
        .where(F.col("_low") != F.col("_high"))
        .drop("_low", "_high")
    )
    titles = records.groupBy("key", "norm").agg(F.count("*").alias("rows"))
    scored = lookup_join(titles, heads, "key", "n").where(F.col("head_norm").isNotNull())
    # Written before it is filtered and joined: each of these would compare the titles anew.
    scored = scored.withColumn("title_score", indel_ratio(F.col("norm"), F.col("head_norm")))
    scored = cut(scored.select(F.sha2(F.concat_ws("|", "key", "norm"), 256).alias("kt"), "title_score", "rows"))
    odd_titles = scored.where(F.col("title_score") < fixed.CONFLICT_RATIO)
    mixed = lookup_join(records, heads, "key", "n").where(F.col("head_norm").isNotNull()).drop("head_norm")
    mixed = mixed.withColumn("kt", F.sha2(F.concat_ws("|", "key", "norm"), 256))
    judged = cut(lookup_join(mixed, odd_titles, "kt", "rows").select("key", "ord", "families", "title_score"))
    odd = judged.where(F.col("title_score").isNotNull())

    def by_family(rows: DataFrame) -> DataFrame:
        each = rows.select("key", F.explode("families").alias("f"), "ord")
        return each.select(F.concat_ws("|", "key", "f").alias("kf"), "ord")

    known = by_family(judged.where(F.col("title_score").isNull())).groupBy("kf").agg(F.min("ord").alias("since"))
    while True:
        if odd.isEmpty():
            return odd.select("ord", "title_score")
        backed = lookup_join(by_family(odd), known, "kf").where(F.col("since") < F.col("ord"))
        joined = cut(backed.select("ord").distinct())
        if joined.isEmpty():
            return odd.select("ord", "title_score")
        gained = by_family(odd.join(joined, "ord", "left_semi")).withColumnRenamed("ord", "since")
        known = cut(known.unionByName(gained).groupBy("kf").agg(F.min("since").alias("since")))
        odd = cut(odd.join(joined, "ord", "left_anti"))


def with_group(papers: DataFrame, block: str | None = None) -> DataFrame:
    """Add ``group_key``: the key, or a key of its own for conflict records.

    With ``block`` (the profile) records only share a key inside it.
    """
    keyed = with_identity(papers)
    if block:
        keyed = keyed.withColumn("key", F.concat_ws("|", F.col(block).cast("string"), "key"))
    known = cut(keyed)
    odd = split_conflicts(known)
    own = F.concat("key", F.lit("|conflict:"), F.left(F.sha2("norm", 256), F.lit(10)))
    return known.join(odd, "ord", "left").withColumn(
        "group_key", F.when(F.col("title_score").isNull(), F.col("key")).otherwise(own)
    ).withColumnRenamed("title_score", "conflict_score")
