"""Scoring records against term dictionaries of many profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litwire import fixed
from litwire.functions.text import fold_case, squeeze
from litwire.operators.terms import BREAK, TEXT_KEY, candidate_terms, text_key


def score_hundredths(title_hits: Column, body_hits: Column, negative_only: Column) -> Column:
    """Whole hundredths, so that thresholds never drift."""
    base = F.least(F.lit(100), title_hits * fixed.TITLE_HIT + body_hits * fixed.BODY_HIT)
    penalty = F.when(negative_only & (title_hits == 0), fixed.NEGATIVE_PENALTY).otherwise(0)
    return F.greatest(F.lit(0), base - penalty)


def scoring_terms(profile_terms: DataFrame) -> DataFrame:
    """Distinct lower-case terms of at least four characters per profile."""
    term = squeeze(F.col("term"))
    return (
        profile_terms.where(F.char_length(term) >= fixed.MIN_TERM_CHARS)
        .groupBy("profile_id", fold_case(term).alias("_k"))
        .agg(F.min(F.lower(term)).alias("term"))
        .drop("_k")
    )


def _literal(text: Column) -> Column:
    """A pattern that matches ``text`` as it is."""
    return F.concat(F.lit("\\Q"), F.replace(text, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def relevance(records: DataFrame, profile_terms: DataFrame, title: str = "title", body: str = "abstract") -> DataFrame:
    """One row per (record, profile) that has a hit, with hits, score and penalty flag.

    One way for dictionaries of every size. Records need no id: missing and
    repeated ids change nothing, and equal records each get their own rows. An
    empty dictionary, or no record, gives an empty table.
    """
    terms = scoring_terms(profile_terms)
    title_text = F.lower(squeeze(F.coalesce(F.col(title), F.lit(""))))
    body_text = F.lower(squeeze(F.coalesce(F.col(body), F.lit(""))))
    key = text_key(F.col(title), F.col(body))
    texts = records.select(*key, F.concat(title_text, F.lit(BREAK), body_text).alias("_text"))
    near = candidate_terms(texts, terms).join(terms, "term")
    near = near.groupBy(*TEXT_KEY, "profile_id").agg(F.collect_set("term").alias("_terms"))
    lowered = records.select("*", *key, title_text.alias("_title"), body_text.alias("_body"))

    def hits(text: str) -> Column:
        return F.size(F.filter("_terms", lambda t: F.contains(F.col(text), t)))

    name = F.lower("profile_id")
    denied = F.contains(F.col("_body"), name) & F.rlike(F.col("_body"), F.concat(F.lit("(?U)" + fixed.NEGATIVE_MENTION), _literal(name)))
    found = lowered.join(near, TEXT_KEY).select(
        *records.columns,
        "profile_id",
        hits("_title").alias("title_hits"),
        hits("_body").alias("body_hits"),
        F.coalesce(denied, F.lit(False)).alias("negative_only"),
    )
    points = score_hundredths(F.col("title_hits"), F.col("body_hits"), F.col("negative_only"))
    found = found.where(F.col("title_hits") + F.col("body_hits") > 0)
    return found.withColumn("score_points", points).withColumn("relevance_score", F.col("score_points") / 100)


def filter_relevant(scored: DataFrame, min_points: int = fixed.PAPER_MIN_SCORE) -> DataFrame:
    return scored.where(F.col("score_points") >= min_points)
