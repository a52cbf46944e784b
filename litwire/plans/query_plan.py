"""Boolean query groups: their text for remote indexes and their evaluation
over a local corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litwire import fixed
from litwire.functions.text import blank_to_null, squeeze, unique_strings
from litwire.operators.terms import TEXT_KEY, candidate_terms, text_key


def _quoted(term: Column) -> Column:
    return F.when(term.contains(" "), F.concat(F.lit('"'), term, F.lit('"'))).otherwise(term)


def _any_of(terms: Column) -> Column:
    return F.array_join(F.transform(terms, _quoted), " OR ")


def build_query_plan(groups: DataFrame, profiles: DataFrame, max_groups: int = fixed.MAX_QUERY_GROUPS) -> DataFrame:
    """(profile_id, pos, group_id, purpose, terms, topics, negatives,
    scholarly_query, news_query).

    ``groups``: (profile_id, pos, id, purpose, terms, topics, negative_terms);
    ``profiles``: (profile_id, english_terms, negative_terms). A profile whose
    groups are all empty gets one core group of its first eight terms.
    """
    empty = F.array().cast("array<string>")

    def listed(c: str, most: int) -> Column:
        return F.slice(unique_strings(F.coalesce(F.col(c), empty)), 1, most)

    place = F.row_number().over(Window.partitionBy("profile_id").orderBy("pos"))
    first = groups.withColumn("_n", place).where(F.col("_n") <= max_groups)
    own = F.when(F.size("negative_terms") > 0, F.col("negative_terms"))
    shared = profiles.select("profile_id", F.col("negative_terms").alias("_shared"))
    rows = (
        first.join(shared, "profile_id", "left")
        .withColumn("negative_terms", F.coalesce(own, "_shared"))
        .select(
            "profile_id",
            F.col("_n").alias("pos"),
            F.coalesce(blank_to_null(squeeze(F.col("id"))), F.concat(F.lit("group_"), "_n")).alias("group_id"),
            F.coalesce(blank_to_null(squeeze(F.col("purpose"))), F.lit("pathogen intelligence")).alias("purpose"),
            listed("terms", fixed.MAX_TERMS).alias("terms"),
            listed("topics", fixed.MAX_TOPICS).alias("topics"),
            listed("negative_terms", fixed.MAX_NEGATIVES).alias("negatives"),
        )
        .where(F.size("terms") > 0)
    )
    usual = F.when(F.size("english_terms") > 0, F.col("english_terms")).otherwise(F.array("profile_id"))
    core = profiles.join(rows.select("profile_id").distinct(), "profile_id", "left_anti").select(
        "profile_id",
        F.lit(1).alias("pos"),
        F.lit("core").alias("group_id"),
        F.lit("core pathogen query").alias("purpose"),
        F.slice(unique_strings(usual), 1, 8).alias("terms"),
        empty.alias("topics"),
        empty.alias("negatives"),
    )
    wanted = F.concat(F.lit("("), _any_of(F.col("terms")), F.lit(")"))
    topics = F.concat(F.lit("("), _any_of(F.col("topics")), F.lit(")"))
    has_topics = F.size("topics") > 0
    minus = F.transform("negatives", lambda t: F.concat(F.lit(" -"), _quoted(t)))
    return rows.unionByName(core).withColumns(
        {
            "scholarly_query": F.when(has_topics, F.concat(wanted, F.lit(" AND "), topics)).otherwise(wanted),
            "news_query": F.concat(
                F.when(has_topics, F.concat(wanted, F.lit(" "), topics)).otherwise(wanted), F.array_join(minus, "")
            ),
        }
    )


def match_plan(records: DataFrame, plan: DataFrame, text: Column, use_negatives: bool) -> DataFrame:
    """Records with the groups they satisfy: any term, any topic if there are
    topics, and for news no negative term.

    Plans of any size go the same way: their terms meet the texts through the
    term index, and the groups met by a text are then decided on it. A plan
    row with the same ids as another is a group of its own; records need no
    id. An empty plan gives an empty table.
    """
    lists = ["terms", "topics", "negatives"]
    groups = plan.select("profile_id", "group_id", (F.size("topics") > 0).alias("_needs_topic"), F.xxhash64("profile_id", "group_id", *lists).alias("_g"), *lists)

    def of_kind(i: int) -> Column:
        terms = F.coalesce(F.col(lists[i]), F.array().cast("array<string>"))
        return F.transform(terms, lambda t: F.struct(F.lit(i).alias("kind"), F.lower(t).alias("term")))

    owned = groups.withColumn("_e", F.explode(F.concat(*[of_kind(i) for i in range(3)]))).select("profile_id", "group_id", "_needs_topic", "_g", "_e.kind", "_e.term").distinct()
    key = text_key(text)
    texts = records.select(*key, F.lower(text).alias("_text"))
    met = candidate_terms(texts, owned.select("term")).join(owned, "term")
    met = met.groupBy(*TEXT_KEY, "_g").agg(
        *[F.any_value(c).alias(c) for c in ("profile_id", "group_id", "_needs_topic")],
        *[F.collect_set(F.when(F.col("kind") == i, F.col("term"))).alias(f"_{c}") for i, c in enumerate(lists)],
    )

    def any_in(terms: str) -> Column:
        return F.exists(terms, lambda t: F.contains(F.col("_text"), t))

    ok = any_in("_terms") & (~F.col("_needs_topic") | any_in("_topics"))
    if use_negatives:
        ok = ok & ~any_in("_negatives")
    rows = records.select("*", *key, F.lower(text).alias("_text")).join(met, TEXT_KEY)
    return rows.where(ok).select(*records.columns, "profile_id", "group_id")
