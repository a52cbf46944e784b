"""One issue per profile, from landed records to published tables.

Every step is a table-to-table job keyed by profile, so one run serves all
profiles. Work outside Spark (models, translators, fetching) enters as tables:
verdicts, contents, pages, answers.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litwire import fixed
from litwire.functions.dates import date_window, filter_news_window, filter_window
from litwire.functions.text import normalize_title
from litwire.operators import attempts, content, evidence, link, merge, metrics, ranking, relevance, review
from litwire.session import cut


@dataclass
class Limits:
    days: int = fixed.WINDOW_DAYS
    papers: int = fixed.MAX_PAPERS
    news: int = fixed.MAX_NEWS
    fulltexts: int = fixed.MAX_FULLTEXTS
    strict_window: bool = False


@dataclass
class Issue:
    papers: DataFrame
    news: DataFrame
    mentions: DataFrame
    paper_tasks: DataFrame
    news_tasks: DataFrame
    review_groups: DataFrame
    members: DataFrame
    metrics: DataFrame


PROVIDERS = ("first", "second")


def _scored(records: DataFrame, terms: DataFrame, body: str, floor: int) -> DataFrame:
    """Relevant (record, profile) rows, numbered in arrival order."""
    found = relevance.filter_relevant(relevance.relevance(records, terms, body=body), floor)
    return ranking.global_rank(found, [F.col("profile_id"), F.col("arrival"), F.col("record_id")])


def _reviewed(items: DataFrame, title: str, verdicts: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    blocks = items.withColumn("block", F.col("profile_id"))
    groups = cut(review.review_groups(blocks.select("block", "ord", F.col(title).alias("norm"))))
    if verdicts is None:
        return items, groups
    return review.apply_verdicts(blocks, groups, verdicts).drop("block"), groups


def _filled(fields: list[str]) -> Column:
    return attempts.answer_valid([F.col("payload")[f] for f in fields])


def _answered(tasks: DataFrame, key: str, answers: DataFrame | None, valid: Column, fallback) -> DataFrame:
    """Analysis map and status from logged answers, else the fallback.

    ``answers``: (key, provider, model, model_rank, payload map). Answers to
    the other kind of record have no key here and are left out.
    """
    if answers is None:
        return tasks.withColumns({"analysis": fallback, "analysis_status": F.lit("fallback_source_extract")})
    best = attempts.first_valid(answers.where(F.col(key).isNotNull()), valid, PROVIDERS, task=key)
    out = attempts.resolve(tasks, best, fallback, task=key)
    return out.withColumnsRenamed({"payload": "analysis", "status": "analysis_status"}).drop("provider", "model")


def build_issue(
    papers: DataFrame,
    news: DataFrame,
    profile_terms: DataFrame,
    end: dt.date,
    limits: Limits = Limits(),
    verdicts: DataFrame | None = None,
    contents: DataFrame | None = None,
    pages: DataFrame | None = None,
    answers: DataFrame | None = None,
    fetched: DataFrame | None = None,
) -> Issue:
    """``papers`` and ``news`` follow the record schemas, with ``record_id``
    and a sortable ``arrival``. ``contents`` are chosen texts; ``fetched`` are
    payloads of candidates (see ``candidate_texts``) to choose from."""
    start, end = date_window(end, limits.days)

    dated = filter_window(papers, start, end, limits.strict_window).drop("in_window")
    raw_papers = _scored(dated, profile_terms, "abstract", fixed.PAPER_MIN_SCORE)
    merged = merge.dedup_papers(raw_papers.drop("arrival"), block="profile_id")
    named = merged.records.withColumn("norm_title", normalize_title(F.col("title")))
    kept, groups = _reviewed(named, "norm_title", verdicts)
    top = cut(ranking.top_papers(kept.drop("norm_title"), limits.papers))

    shown = filter_news_window(news, start, end)
    raw_news = _scored(shown, profile_terms, "excerpt", fixed.NEWS_MIN_SCORE)
    items = merge.dedup_news(raw_news.drop("arrival"), block="profile_id").records.drop("norm")
    linked = cut(link.link_news(ranking.top_news(items, limits.news), _ranked(top), block="profile_id"))
    mentions = link.media_mentions(linked)
    left = link.remaining_news(linked).drop("related_paper_id", "link_score", "is_event")

    listed = merge.attach_lists(top, merged.values, ("authors", "publication_types", "sources"))
    if contents is None and fetched is not None:
        within = listed.where(F.col("issue_rank") <= limits.fulltexts)
        once = within.groupBy("paper_id").agg(F.min_by(F.struct("title", "doi", "authors", "abstract"), "profile_id").alias("_p"))
        contents = cut(content.full_texts(once.select("paper_id", "_p.*"), content.candidate_texts(fetched)))
    if contents is None:
        bare = F.when(F.col("abstract") != "", "abstract_api").otherwise("metadata_only")
        full = listed.withColumns({"full_text": F.lit(""), "full_text_method": bare}).withColumn(
            "evidence_level", evidence.evidence_level(F.col("full_text"), F.col("abstract"))
        )
    else:
        full = content.attach_content(listed, contents, limits.fulltexts)
    if pages is None:
        read = left.withColumns(
            {
                "content": F.col("excerpt"),
                "content_status": content.content_status(F.coalesce("excerpt", F.lit(""))),
                "resolved_url": F.col("url"),
            }
        )
    else:
        read = content.resolve_news(left, pages)

    kind = evidence.paper_type(F.col("publication_types"), F.col("title"), F.coalesce("abstract", F.lit("")))
    full = cut(
        full.withColumns(
            {
                "paper_type": kind,
                "evidence": evidence.paper_evidence(F.col("abstract"), F.col("full_text"), fixed.EVIDENCE_ABSTRACT, fixed.EVIDENCE_FULL),
                "evidence_scope": evidence.evidence_scope(abstract=F.coalesce("abstract", F.lit("")), full_text=F.coalesce("full_text", F.lit(""))),
            }
        )
    )
    found = F.col("evidence")
    research = evidence.as_map(evidence.fallback_research(found), fixed.RESEARCH_FIELDS)
    reviews = evidence.as_map(evidence.fallback_review(found), fixed.REVIEW_FIELDS)
    nothing = F.create_map().cast("map<string,string>")
    paper_fallback = (
        F.when(F.size("evidence") == 0, nothing).when(F.col("paper_type") == "review", reviews).otherwise(research)
    )
    # Three of the five fields of the paper's own kind have to be filled.
    own_kind = F.when(F.col("paper_type") == "review", _filled(fixed.REVIEW_FIELDS)).otherwise(_filled(fixed.RESEARCH_FIELDS))
    typed = None if answers is None else answers.join(full.select("paper_id", "paper_type"), "paper_id")
    done = _answered(full, "paper_id", typed, own_kind, paper_fallback)
    no_text = F.when(F.size("evidence") == 0, "not_run_no_abstract_or_fulltext")
    done = done.withColumn("analysis_status", F.coalesce(no_text, "analysis_status"))

    read = cut(read.withColumn("evidence", evidence.news_evidence(F.coalesce("content", F.lit("")), F.coalesce("excerpt", F.lit("")), fixed.EVIDENCE_NEWS)))
    told = evidence.as_map(evidence.fallback_news(found, F.col("published_date")), fixed.NEWS_FIELDS)
    untold = evidence.as_map(evidence.no_content_news(F.col("published_date")), fixed.NEWS_FIELDS)
    empty = F.size("evidence") == 0
    reported = _answered(read, "news_id", answers, _filled(fixed.NEWS_FIELDS), F.when(empty, untold).otherwise(told))
    reported = reported.withColumn("analysis_status", F.when(empty, "not_run_no_content").otherwise(F.col("analysis_status")))

    paper_tasks = full.where(F.size("evidence") > 0).select(
        "paper_id", evidence.paper_task(found, F.col("authors"), F.col("evidence_scope")).alias("payload")
    )
    news_tasks = read.where(~empty).select("news_id", evidence.news_task(found).alias("payload"))
    untranslated = F.lit(False)
    counts = metrics.issue_metrics(
        done.withColumn("title_translated", untranslated),
        reported.withColumn("title_translated", untranslated),
        raw_papers,
        raw_news,
    )
    return Issue(done, reported, mentions, paper_tasks, news_tasks, groups, merged.members, counts)


def _ranked(top: DataFrame) -> DataFrame:
    """Papers in issue order, for the first-wins rule of linking."""
    return top.select("profile_id", "paper_id", F.col("issue_rank").cast("bigint").alias("ord"), "title", "doi")
