"""A small issue from end to end."""

import datetime as dt

import pytest

from litwire.operators.merge import dedup_news, dedup_papers
from litwire.plans.issue import build_issue
from litwire.schemas import NEWS, PAPER
from pyspark.sql import functions as F

DAY = dt.date(2026, 7, 15)
RESEARCH = (
    "Blood from 371 people who work outdoors was tested for hantavirus. Antibodies to hantavirus turned up in 7.3% of them. "
    "People who had met rodents often were positive more often. Only one region took part, and nobody was followed over time."
)
REVIEW = "This review sums up what is known of hantavirus, its hosts and its control. Long surveillance studies are still missing."


def rows(spark, schema, items):
    full = [tuple(item.get(f.name) for f in schema) for item in items]
    df = spark.createDataFrame(full, schema)
    names = spark.createDataFrame([(i["url"], str(i["url"]), n) for n, i in enumerate(items)], "url string, record_id string, arrival bigint")
    return df.join(names, "url")


@pytest.fixture(scope="module")
def issue(spark):
    papers = [
        dict(source="S1", source_ids={"pmid": "1"}, doi="10.0000/demo.research", title="Serologic evidence of hantavirus exposure in forest workers", abstract=RESEARCH, authors=["Demo Author"], online_date=DAY, publication_types=["Journal Article"], url="u1"),
        dict(source="S2", source_ids={"pmcid": "9"}, doi="10.0000/demo.research", title="Serologic evidence of hantavirus exposure in forest workers", abstract="short", authors=["Demo Author", "B Two"], online_date=DAY, publication_types=[], url="u2"),
        dict(source="S3", source_ids={"pmid": "2"}, doi="10.0000/demo.review", title="Hantavirus infections in a changing world: a narrative review", abstract=REVIEW, authors=["Review Author"], online_date=DAY, publication_types=["Review"], url="u3"),
    ]
    news = [
        dict(source="N", title="Health authority reports a suspected hantavirus case", url="n1", published_date=DAY, excerpt="On Tuesday, the authority reported one suspected hantavirus case in County A. The patient is stable today.", publisher="P", language="en"),
        dict(source="N", title="Serologic evidence of hantavirus exposure in forest workers", url="n2", published_date=DAY, excerpt="A new hantavirus paper.", publisher="P", language="en"),
    ]
    terms = spark.createDataFrame([("hantavirus", "english_terms", "hantavirus")], "profile_id string, kind string, term string")
    return build_issue(rows(spark, PAPER, papers), rows(spark, NEWS, news), terms, DAY)


def test_papers_merge_and_keep_their_ids(issue):
    got = {r.paper_id: r for r in issue.papers.collect()}
    assert set(got) == {"paper-c794ae2b3703b08b", "paper-f58e7a9dd92a48fb"}
    first = got["paper-c794ae2b3703b08b"]
    assert (first.n_records, first.paper_type, first.relevance_score, first.evidence_level) == (2, "research", 0.53, "E1")
    assert first.abstract == RESEARCH and first.authors == ["Demo Author", "B Two"]
    assert first.analysis["methods"] == "Antibodies to hantavirus turned up in 7.3% of them."
    assert got["paper-f58e7a9dd92a48fb"].paper_type == "review"


def test_news_is_linked_or_reported(issue):
    assert [r.paper_id for r in issue.mentions.collect()] == ["paper-c794ae2b3703b08b"]
    (item,) = issue.news.collect()
    assert item.news_id == "news-e98ad4327659c4c3"
    assert item.analysis["time"] == "2026-07-15" and item.analysis["event"].startswith("On Tuesday")


def test_metrics_and_members(issue):
    row = issue.metrics.first()
    assert (row.raw_papers, row.papers, row.research, row.reviews, row.raw_news, row.news) == (3, 2, 1, 1, 2, 1)
    assert issue.members.count() == 3
