"""Driver queries: every operator over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litwire import fixed
from litwire.functions import dates, text
from litwire.functions.fuzzy import indel_ratio
from litwire.operators import (
    attempts,
    content,
    evidence,
    glossary,
    identity,
    link,
    merge,
    metrics,
    ranking,
    relevance,
    review,
    similarity,
    translation,
)
from litwire.operators.cluster import leader_clusters
from litwire.plans.query_plan import build_query_plan, match_plan
from litwire.schemas import NEWS
from litwire.session import cut, scratch_path
from litwire.sources import dictionary, landing, news as news_feeds, scholarly, sinks
from litwire.streaming import daily, snapshot

Query = Callable[[SparkSession, str], DataFrame]

# Parameters shared with the SQL twins.
TERMS = {
    "anat": ["anat", "reon", "pour", "annd", "ones"],
    "nicht": ["nicht", "ungen", "avec", "ation"],
}
GROUPS = [
    ("core", ["anat", "reon of"], [], []),
    ("clinical", ["pour", "nicht", "the"], ["ation", "ungen"], ["eau", "schl"]),
    ("ecology", ["para", "with"], ["est", "re"], ["oun"]),
]
TYPE_WORDS = r"\b(anat|pour|nicht|para|thon)\b"
GUARD_WORDS = r"\b(with|pour|und|para)\b"
LINK_TERMS = ["the", "que", "un", "er"]
GLOSSARY = [("the", "该"), ("of the", "的该"), ("pour", "为了"), ("nicht", "不$1"), ("para la", "为此")]
WINDOW_END = dt.date(1998, 6, 30)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def records(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as records: the first line is the title, the rest the body."""
    line = F.substring_index("text", "\n", 1)
    rest = F.col("text").substr(F.char_length(line) + 2, F.char_length("text"))
    return table(spark, sf, "documents").withColumns({"title": text.squeeze(line), "body": text.squeeze(rest)})


def titles(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct normalised titles with the first document that has each."""
    norm = text.normalize_title(F.col("title"))
    rows = records(spark, sf).select("doc_id", norm.alias("norm")).where(F.col("norm") != "")
    return rows.groupBy("norm").agg(F.min("doc_id").alias("ord")).select(F.lit(0).alias("block"), "ord", "norm")


def day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def normalize_titles(spark, sf):
    title = text.clean_space(F.col("title"))
    rows = records(spark, sf).select("doc_id", title.alias("title"))
    norm = text.normalize_title(F.col("title"))
    return rows.select("doc_id", "title", norm.alias("norm_title"), text.stable_id("paper-", norm).alias("title_id"))


def _key() -> Column:
    none = F.lit(None).cast("string")
    return identity.identity_key(none, none, none, F.col("title"), F.lit(""), F.col("doc_id").cast("string"))


def doc_identity_groups(spark, sf):
    size = F.char_length("text")
    rows = records(spark, sf).withColumns({"key": _key(), "size": size})
    return rows.groupBy(text.stable_id("paper-", F.col("key")).alias("paper_id")).agg(
        F.count("*").alias("n_docs"),
        F.min("doc_id").alias("head_doc"),
        F.max_by("doc_id", F.struct("size", -F.col("doc_id"))).alias("longest_doc"),
        F.max("size").cast("bigint").alias("longest_chars"),
    )


def _papers(spark, sf) -> DataFrame:
    """Documents in the paper layout."""
    none = F.lit(None).cast("string")
    return records(spark, sf).select(
        F.col("doc_id").cast("string").alias("record_id"),
        F.col("doc_id").alias("ord"),
        "source",
        F.create_map(F.lit("lang"), F.col("lang")).alias("source_ids"),
        none.alias("doi"),
        "title",
        F.col("body").alias("abstract"),
        F.array("lang").alias("authors"),
        F.when(F.col("n_chars") % 3 == 0, F.col("source")).alias("journal"),
        F.array("lang").alias("publication_types"),
    )


def merge_longest_text(spark, sf):
    papers = _papers(spark, sf).withColumn("doc_id", F.col("ord")).withColumn("group_key", _key())
    groups = papers.groupBy("group_key").agg(F.min("ord").alias("group_ord")).withColumn("leader", F.col("group_ord"))
    merged = merge.merge_papers(papers.drop("doc_id"), groups)
    wanted = F.col("field").isin("sources", "id:lang")
    lists = (
        merged.values.where(wanted)
        .groupBy("paper_id")
        .agg(
            F.array_sort(F.collect_list(F.when(F.col("field") == "sources", F.struct("pos", "value")))).alias("s"),
            F.max(F.when(F.col("field") == "id:lang", F.col("value"))).alias("last_lang"),
        )
        .select("paper_id", F.array_join(F.transform("s", lambda x: x["value"]), ",").alias("sources"), "last_lang")
    )
    return merged.records.join(lists, "paper_id").select(
        F.col("ord").alias("head_doc"),
        "title",
        F.md5("abstract").alias("abstract_md5"),
        "abstract_source",
        F.coalesce("journal", F.lit("")).alias("journal"),
        "n_records",
        "sources",
        "last_lang",
    )


def availability_dates(spark, sf):
    ship = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.to_date(F.min("l_shipdate")).alias("online_date"), F.to_date(F.max("l_shipdate")).alias("print_date"))
    )
    orders = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("created_date"))
    joined = orders.join(ship, "o_orderkey", "left")
    start, end = dates.date_window(WINDOW_END, 365)
    return dates.filter_window(joined, start, end).select(
        "o_orderkey",
        day("availability_date").alias("availability_date"),
        "availability_date_basis",
        "in_window",
    )


def window_filter_undated(spark, sf):
    start, end = dates.date_window(WINDOW_END, 365)
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate")).alias("published_date"),
        F.col("o_orderpriority").alias("title"),
        F.when(F.col("o_custkey") % 10 == 0, "").otherwise(F.concat(F.lit("u"), "o_custkey")).alias("url"),
    )
    kept = dates.filter_news_window(rows, start, end)
    return kept.select("o_orderkey", F.coalesce(day("published_date"), F.lit("undated")).alias("published_date"), "url")


def parse_dates(spark, sf):
    d, form = F.col("o_orderdate"), F.col("o_orderkey") % 6
    shown = (
        F.when(form == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(form == 1, F.concat(F.lit("on "), F.date_format(d, "yyyy/M/d"), F.lit(" in print")))
        .when(form == 2, F.concat(F.lit("issue "), F.date_format(d, "yyyy-MM")))
        .when(form == 3, F.date_format(d, "yyyy"))
        .when(form == 4, F.concat(F.date_format(d, "yyyy"), F.lit("-13-01")))
        .otherwise("no date")
    )
    parsed = dates.parse_date(shown)
    return table(spark, sf, "orders").select(
        "o_orderkey", shown.alias("shown"), F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), F.lit("none")).alias("parsed")
    )


def _terms(spark) -> DataFrame:
    rows = [(p, "english_terms", t) for p, terms in TERMS.items() for t in terms]
    return spark.createDataFrame(rows, "profile_id string, kind string, term string")


def relevance_scores(spark, sf):
    rows = records(spark, sf).select("doc_id", "title", "body")
    scored = relevance.relevance(rows, _terms(spark), body="body")
    kept = relevance.filter_relevant(scored)
    return kept.select("doc_id", "profile_id", "title_hits", "body_hits", "score_points", "relevance_score")


def relevance_scores_large_dictionary(spark, sf):
    """Scores by a dictionary that grows with the data: every word of the benchmark texts, dealt to seven profiles."""
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), 0))
    profile = F.concat(F.lit("set"), (F.col("item_id") % 7).cast("string"))
    terms = table(spark, sf, "benchmark").select(profile.alias("profile_id"), words.alias("term"))
    rows = records(spark, sf).select("doc_id", "title", "body")
    kept = relevance.filter_relevant(relevance.relevance(rows, terms, body="body"))
    return kept.select("doc_id", "profile_id", "title_hits", "body_hits", "score_points", "relevance_score")


def _plan(spark) -> DataFrame:
    groups = spark.createDataFrame(
        [("p", i, g, None, t, o, n) for i, (g, t, o, n) in enumerate(GROUPS)],
        "profile_id string, pos int, id string, purpose string, terms array<string>, topics array<string>,"
        " negative_terms array<string>",
    )
    profiles = spark.createDataFrame(
        [("p", ["anat"], ["oun"])], "profile_id string, english_terms array<string>, negative_terms array<string>"
    )
    return build_query_plan(groups, profiles)


def query_group_matches(spark, sf):
    rows = records(spark, sf).select("doc_id", "text")
    return match_plan(rows, _plan(spark), F.col("text"), use_negatives=True).select("doc_id", "group_id")


def query_group_counts(spark, sf):
    plan = _plan(spark)
    hits = match_plan(records(spark, sf).select("doc_id", "text"), plan, F.col("text"), use_negatives=False)
    counts = hits.groupBy("group_id").agg(F.count("*").alias("n_docs"))
    return plan.join(counts, "group_id", "left").select(
        "group_id", "scholarly_query", "news_query", F.coalesce("n_docs", F.lit(0)).alias("n_docs")
    )


def paper_type_split(spark, sf):
    kind = evidence.paper_type(F.array("lang"), F.col("title"), F.col("body"), TYPE_WORDS)
    return (
        records(spark, sf)
        .groupBy("source", kind.alias("paper_type"))
        .agg(F.count("*").alias("n_docs"), F.sum("n_chars").alias("chars"))
    )


def topk_per_source(spark, sf):
    rows = table(spark, sf, "documents").select(
        F.col("source").alias("profile_id"),
        F.col("doc_id").alias("ord"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("n_chars") % 28).cast("int")).alias("availability_date"),
        ((F.col("n_chars") % 101) / 100).alias("relevance_score"),
    )
    top = ranking.top_papers(rows)
    return top.select(F.col("profile_id").alias("source"), F.col("issue_rank").cast("bigint").alias("rank"), F.col("ord").alias("doc_id"))


def arrival_rank(spark, sf):
    """Position of every document in (date desc, size desc, id) order."""
    rows = table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    order = [F.col("n_chars").desc(), F.col("doc_id")]
    return ranking.global_rank(rows, order, "rank").select("doc_id", F.col("rank").cast("bigint").alias("rank"))


def issue_metrics(spark, sf):
    """Counts of each source: documents as found papers, those of good quality as kept ones, every third as news."""
    docs = records(spark, sf).withColumnRenamed("source", "profile_id")
    good = table(spark, sf, "labels").where(F.col("quality") == 1).select("doc_id")
    kind = evidence.paper_type(F.array("lang"), F.col("title"), F.col("body"), TYPE_WORDS)
    papers = docs.join(good, "doc_id", "left_semi").withColumns({"paper_type": kind, "title_translated": F.when(F.col("doc_id") % 3 != 0, F.col("doc_id") % 2 == 0)})
    found = docs.where(F.col("doc_id") % 3 == 0)
    news = found.where(F.col("n_chars") > 1000).withColumn("title_translated", F.col("lang") == "en")
    return metrics.issue_metrics(papers, news, docs, found)


def answer_validity(spark, sf):
    """Which answers fill at least three of their five fields."""
    key = F.col("o_orderkey")
    fields = [F.when(key % 2 == 0, F.col("o_totalprice").cast("string")), F.when(key % 3 == 0, F.col("o_custkey").cast("string")).otherwise("  "), F.col("o_orderstatus"), F.when(key % 5 < 3, F.col("o_orderpriority")), F.when(key % 7 == 0, F.lit("")).when(key % 7 == 1, F.lit("x"))]
    return table(spark, sf, "orders").select("o_orderkey", attempts.filled_elements(fields).cast("long").alias("n_filled"), attempts.answer_valid(fields).alias("valid"))


def metrics_rollup(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "source", "lang")
    joined = rows.join(table(spark, sf, "labels"), "doc_id", "left")
    rolled = metrics.type_rollup(
        joined,
        ["source", "lang"],
        F.count_if(F.col("quality") == 1).alias("good"),
        F.count_if(F.col("toxic") == 1).alias("toxic"),
        F.grouping_id().alias("level"),
    )
    return rolled.select(
        F.coalesce("source", F.lit("(all)")).alias("source"),
        F.coalesce("lang", F.lit("(all)")).alias("lang"),
        F.col("level").cast("bigint").alias("level"),
        "n",
        "good",
        "toxic",
    )


def similar_titles(spark, sf):
    pairs = similarity.similar_pairs(cut(titles(spark, sf)), fixed.NEWS_TITLE_RATIO)
    return pairs.select("a", "b", "score")


def similar_titles_strict(spark, sf):
    pairs = similarity.similar_pairs(cut(titles(spark, sf)), fixed.PAPER_TITLE_RATIO)
    return pairs.select("a", "b", "score")


def title_leaders(spark, sf):
    return leader_clusters(titles(spark, sf), fixed.NEWS_TITLE_RATIO)


def _doc_news(spark, sf) -> DataFrame:
    return records(spark, sf).select(
        F.col("doc_id").alias("record_id"),
        F.col("doc_id").alias("ord"),
        "source",
        "title",
        F.concat(F.lit("https://x.example/"), "doc_id").alias("url"),
        F.lit(None).cast("date").alias("published_date"),
        F.col("body").alias("excerpt"),
        F.col("lang").alias("publisher"),
    )


def news_dedup(spark, sf):
    merged = merge.dedup_news(_doc_news(spark, sf))
    return merged.records.select(
        F.col("ord").alias("head_doc"), "title", "news_id", F.md5("excerpt").alias("excerpt_md5"), "n_records"
    )


def news_duplicate_sources(spark, sf):
    merged = merge.dedup_news(_doc_news(spark, sf))
    return merged.values.select(F.col("leader").alias("head_doc"), F.col("ord").alias("doc_id"), "source", "url", "publisher")


def paper_dedup(spark, sf):
    """Identity groups, conflict split, title pass and merge in one run."""
    papers = _papers(spark, sf)
    merged = merge.dedup_papers(papers)
    return merged.records.select(
        F.col("ord").alias("head_doc"), "title", F.md5("abstract").alias("abstract_md5"), "n_records"
    )


def conflict_split(spark, sf):
    """Documents of one source and decade of ids share an invented identifier;
    those with foreign titles and no shared family name are split off."""
    shared = F.concat(F.lit("10.1/"), "source", F.lit("."), F.floor(F.col("ord") / 200))
    papers = _papers(spark, sf).withColumn("doi", shared)
    keyed = cut(identity.with_identity(papers).select("key", "norm", "ord", "authors"))
    odd = identity.split_conflicts(keyed)
    return odd.select(F.col("ord").alias("doc_id"))


def _page_news(spark, sf) -> DataFrame:
    title = text.squeeze(F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1))
    return table(spark, sf, "pages").select(
        "page_id", F.col("page_id").alias("ord"), title.alias("title"), F.lit("").alias("excerpt"), "url"
    )


def _doc_papers(spark, sf) -> DataFrame:
    return records(spark, sf).select(
        F.col("doc_id").cast("string").alias("paper_id"),
        F.col("doc_id").alias("ord"),
        "title",
        F.lit(None).cast("string").alias("doi"),
    )


def link_pages_to_docs(spark, sf):
    linked = link.link_news(_page_news(spark, sf), _doc_papers(spark, sf), event_words=GUARD_WORDS)
    return linked.select(
        "page_id",
        "is_event",
        F.coalesce("related_paper_id", F.lit("none")).alias("paper_id"),
        F.coalesce("link_score", F.lit(0.0)).alias("link_score"),
    )


def unlinked_pages(spark, sf):
    """News that no paper takes: events, and titles unlike any paper's."""
    linked = link.link_news(_page_news(spark, sf), _doc_papers(spark, sf), event_words=GUARD_WORDS)
    return link.remaining_news(linked).select("page_id", "is_event")


def mentions_per_doc(spark, sf):
    linked = link.link_news(_page_news(spark, sf), _doc_papers(spark, sf), event_words=GUARD_WORDS)
    return link.media_mentions(linked).groupBy("paper_id").agg(
        F.count("*").alias("n_mentions"), F.min("page_id").alias("first_page")
    )


def review_band(spark, sf):
    norm = text.normalize_title(F.col("title"))
    rows = records(spark, sf).select("source", "doc_id", norm.alias("norm")).where(F.col("norm") != "")
    items = rows.groupBy(F.col("source").alias("block"), "norm").agg(F.min("doc_id").alias("ord"))
    groups = review.review_groups(items.select("block", "ord", "norm"))
    return groups.select(
        F.col("block").alias("source"),
        F.col("group_no").cast("bigint").alias("group_no"),
        F.col("pos").cast("bigint").alias("pos"),
        F.col("ord").alias("doc_id"),
    )


def verdict_removal(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.col("source").alias("block"), F.col("doc_id").alias("ord"), F.floor(F.col("doc_id") / 100).alias("group_no")
    )
    bad = table(spark, sf, "labels").where(F.col("toxic") == 1).select(F.col("doc_id").alias("ord"))
    verdicts = (
        docs.join(bad, "ord", "left_semi")
        .groupBy("block", "group_no")
        .agg(F.array_sort(F.collect_list("ord")).alias("indexes"), F.min("ord").alias("keep"))
    )
    left = review.apply_verdicts(docs, docs, verdicts)
    return left.select(F.col("block").alias("source"), F.col("ord").alias("doc_id"))


WORK_WORDS = 8


def _shingles(tokens: Column, size: int) -> Column:
    """Runs of ``size`` words, each once per text."""
    last = F.size(tokens) - size
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(tokens, i + 1, size), " "))))


def identity_check(spark, sf):
    """Works are the benchmark texts; candidates are the documents that hold
    the first words of a work, found by an equi-join on word runs."""
    first = F.slice(text.title_tokens(F.col("text")), 1, WORK_WORDS)
    works = table(spark, sf, "benchmark").select(
        F.col("item_id").alias("work_id"),
        F.col("text").alias("title"),
        F.lit(None).cast("string").alias("doi"),
        F.array().cast("array<string>").alias("authors"),
        F.xxhash64(F.array_join(first, " ")).alias("h"),
    )
    docs = table(spark, sf, "documents").select("doc_id", "text")
    words = docs.select("doc_id", text.title_tokens(F.col("text")).alias("words"))
    runs = words.select("doc_id", F.explode(_shingles(F.col("words"), WORK_WORDS)).alias("h"))
    found = runs.join(works.select("work_id", "h"), "h").select("work_id", "doc_id").distinct()
    candidates = found.join(docs, "doc_id").select("work_id", F.col("doc_id").alias("pos"), "text")
    checked = content.verify_identity(works.drop("h"), candidates, scores=True)
    return checked.select(
        F.col("work_id").alias("item_id"),
        F.col("pos").alias("doc_id"),
        F.round("title_score", 6).alias("title_score"),
        "accepted",
    )


def enriched_papers(spark, sf):
    """Candidates of four kinds for every document, from payload to identity, best text and attached paper."""
    docs = records(spark, sf).select(F.col("doc_id").cast("string").alias("paper_id"), "title", "body", "lang")
    papers = docs.select("paper_id", "title", F.lit(None).cast("string").alias("doi"), F.array().cast("array<string>").alias("authors"), F.col("title").alias("abstract"), F.lit(1).alias("issue_rank"))
    whole = F.concat_ws(" ", "title", "body")
    passages = F.to_json(F.array(F.struct(F.array(F.struct(F.array(F.struct(F.col("title").alias("text")), F.struct(F.col("lang").alias("text"))).alias("passages"))).alias("documents"))))
    article = F.concat(F.lit("<article><body><sec><title>Results</title><p>"), _escaped(whole), F.lit("</p></sec></body></article>"))
    page = F.concat(F.lit("<html><body><main>"), _escaped(F.concat_ws(" ", "title", "body", "body")), F.lit("</main></body></html>"))
    refused = F.lit("<html><body><article>" + "-- " * 3000 + "</article></body></html>")
    listed = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(k).alias("kind"), x.alias("payload")) for i, (k, x) in enumerate([("html", refused), ("json", passages), ("xml", article), ("html", page)], 1)])
    fetched = docs.select("paper_id", F.explode(listed).alias("c")).select("paper_id", "c.*", F.lit("").alias("method"), F.concat(F.lit("https://c.example/"), "c.pos").alias("url"))
    chosen = content.full_texts(papers, content.candidate_texts(fetched))
    out = content.attach_content(papers, chosen)
    return out.select("paper_id", "full_text_method", F.coalesce("full_text_url", F.lit("")).alias("full_text_url"), F.md5("full_text").alias("text_md5"), F.char_length("full_text").cast("bigint").alias("n_chars"))


def page_main_text(spark, sf):
    pages = content.extract_pages(table(spark, sf, "pages"))
    return pages.select(
        "page_id",
        "method",
        content.content_status(F.col("content")).alias("content_status"),
        F.md5("content").alias("content_md5"),
        F.char_length("content").cast("bigint").alias("n_chars"),
        "page_title",
        "resolved_url",
    )


def page_dense_text(spark, sf):
    """Pages without their article elements: what the density of text finds."""
    bare = table(spark, sf, "pages").withColumn("html", F.regexp_replace("html", "</?article>", "<div>"))
    pages = content.extract_pages(bare)
    return pages.select("page_id", "method", F.md5("content").alias("content_md5"), F.char_length("content").cast("bigint").alias("n_chars"))


def page_contexts(spark, sf):
    pages = content.page_context(table(spark, sf, "pages"))
    return pages.select("page_id", "content_hash", F.char_length("text").cast("bigint").alias("n_chars"))


def page_links(spark, sf):
    links = content.harvest_links(table(spark, sf, "pages"), LINK_TERMS, "https://site.example", shortest=1)
    return links.select("page_id", F.col("pos").cast("bigint").alias("pos"), "term", "link_title", "link_url")


def candidate_rank(spark, sf):
    pattern = F.lit('href="([^"]+)"')
    rows = table(spark, sf, "pages").select(
        "page_id", F.posexplode(F.regexp_extract_all("html", pattern, F.lit(1))).alias("pos", "url")
    )
    first = rows.groupBy("page_id", "url").agg(F.min("pos").alias("pos"))
    kept = ranking.top_k(first, fixed.MAX_CANDIDATES, [F.col("pos")], ["page_id"])
    return kept.select("page_id", F.col("rank").cast("bigint").alias("rank"), "url")


def paper_candidates(spark, sf):
    """Where the text of each record may be found, in order."""
    doc = F.col("doc_id")
    papers = records(spark, sf).select(
        doc.cast("string").alias("paper_id"),
        F.when(doc % 3 == 0, F.create_map(F.lit("pmcid"), doc.cast("string")))
        .otherwise(F.create_map().cast("map<string,string>"))
        .alias("source_ids"),
        F.array(F.struct(F.concat(F.lit("https://l.example/"), "lang").alias("URL"))).alias("full_text_links"),
        F.when(doc % 2 == 0, F.concat(F.lit("https://l.example/"), "source")).alias("open_access_pdf"),
        F.array(F.concat(F.lit("https://l.example/"), "source"), F.concat(F.lit("https://l.example/"), "lang")).alias("full_text_urls"),
        F.when(doc % 5 != 0, F.concat(F.lit("10.1/"), doc)).alias("doi"),
        F.concat(F.lit("https://x.example/"), doc).alias("url"),
    )
    return content.candidate_urls(papers).select(
        "paper_id", F.col("pos").cast("bigint").alias("pos"), "method", "url"
    )


def best_turns(spark, sf):
    """The best accepted answer of each conversation as chosen content."""
    rows = table(spark, sf, "conversations")
    candidates = rows.select(
        F.col("conv_id").alias("work_id"),
        F.col("turn").cast("int").alias("pos"),
        "text",
        (F.col("role") == "assistant").alias("accepted"),
        F.col("role").alias("method"),
        F.lit("").alias("url"),
    )
    best = content.best_content(candidates, stop_at=400, min_chars=100)
    return best.select(
        F.col("work_id").alias("conv_id"), F.col("pos").cast("bigint").alias("turn"), F.md5("text").alias("text_md5")
    )


def budgeted_attach(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    papers = records(spark, sf).select(
        F.col("doc_id").alias("paper_id"), "source", F.col("doc_id").alias("ord"), F.col("title").alias("abstract")
    )
    ranked = ranking.global_rank(papers, [F.col("ord")], "issue_rank", by=["source"])
    good = table(spark, sf, "labels").where(F.col("quality") == 1).select("doc_id")
    texts = docs.join(good, "doc_id", "left_semi").select(
        F.col("doc_id").alias("paper_id"), text.squeeze(F.col("text")).alias("text"), F.lit("label").alias("method"), F.lit(None).cast("string").alias("url")
    )
    out = content.attach_content(ranked, texts)
    return out.select(
        F.col("paper_id").alias("doc_id"),
        "full_text_method",
        "evidence_level",
        F.char_length("full_text").cast("bigint").alias("n_chars"),
    )


def boilerplate_removed(spark, sf):
    rows = table(spark, sf, "documents")
    phrase = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("View full coverage - "), "text", F.lit(", by Google News."))).otherwise(F.col("text"))
    value = text.remove_boilerplate(phrase)
    return rows.select("doc_id", F.md5(value).alias("text_md5"), F.char_length(value).cast("bigint").alias("n_chars"))


def strip_tags_pages(spark, sf):
    value = text.strip_tags(F.col("html"))
    return table(spark, sf, "pages").select(
        "page_id", F.md5(value).alias("text_md5"), F.char_length(value).cast("bigint").alias("n_chars")
    )


def evidence_sentences(spark, sf):
    found = evidence.evidence_list(F.col("body"), "A")
    out = evidence.evidence_table(records(spark, sf), "doc_id", found)
    return out.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "evidence_id", "text")


def fallback_five(spark, sf):
    rows = records(spark, sf).select(
        "doc_id",
        evidence.paper_type(F.array("lang"), F.col("title"), F.col("body"), TYPE_WORDS).alias("kind"),
        evidence.evidence_list(F.col("body"), "A").alias("ev"),
    ).where(F.size("ev") > 0)
    research, reviews = evidence.fallback_research(F.col("ev")), evidence.fallback_review(F.col("ev"))
    is_review = F.col("kind") == "review"
    names = zip(fixed.RESEARCH_FIELDS, fixed.REVIEW_FIELDS)
    picked = [F.when(is_review, reviews[v]).otherwise(research[r]).alias(f"e{i}") for i, (r, v) in enumerate(names, 1)]
    return rows.select("doc_id", "kind", *picked)


def fallback_news_five(spark, sf):
    rows = records(spark, sf).select("doc_id", evidence.evidence_list(F.col("body"), "N").alias("ev"))
    none = F.lit(None).cast("string")
    told, empty = evidence.fallback_news(F.col("ev"), none), evidence.no_content_news(none)
    bare = F.size("ev") == 0
    picked = [F.when(bare, empty[f]).otherwise(told[f]).alias(f"{f}_text") for f in fixed.NEWS_FIELDS]
    return rows.select("doc_id", *picked)


def five_field_summaries(spark, sf):
    rows = records(spark, sf).select("doc_id", evidence.evidence_list(F.col("body"), "A").alias("ev")).where(F.size("ev") > 0)
    told = evidence.fallback_research(F.col("ev"))
    fields = F.array(*[told[f] for f in fixed.RESEARCH_FIELDS])
    labels = F.array(*[F.lit(v) for v in fixed.RESEARCH_LABELS])
    return rows.select("doc_id", text.five_field_summary(labels, fields).alias("summary"))


def task_payloads(spark, sf):
    rows = records(spark, sf).select(
        F.col("doc_id").cast("string").alias("paper_id"),
        "title",
        F.col("source").alias("journal"),
        F.lit(None).cast("int").alias("year"),
        F.lit(None).cast("string").alias("doi"),
        F.array("lang").alias("publication_types"),
        F.lit("E1").alias("evidence_level"),
        F.array("lang").alias("authors"),
        "body",
    )
    none = F.lit("")
    found = evidence.paper_evidence(F.col("body"), none)
    tasks = rows.select("paper_id", evidence.paper_task(found, F.col("authors"), evidence.evidence_scope(F.col("body"), none)).alias("payload"))
    read = F.from_json(
        "payload",
        "paper_id string, title string, evidence_scope string, evidence array<struct<id:string,text:string>>",
    )
    parsed = tasks.select(read.alias("p"))
    return parsed.select(
        F.col("p.paper_id").alias("paper_id"),
        F.col("p.title").alias("title"),
        F.col("p.evidence_scope").alias("evidence_scope"),
        F.size("p.evidence").cast("bigint").alias("n_evidence"),
        F.coalesce(F.get("p.evidence", F.lit(0))["text"], F.lit("")).alias("first_text"),
    )


def numbers_and_dois(spark, sf):
    rows = table(spark, sf, "documents")
    whole = F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit(" (doi:10.1234/AB."), "doc_id", F.lit(").")))
    value = F.coalesce(whole, F.col("text"))
    return rows.select(
        "doc_id",
        F.array_join(text.extract_numbers(value), "|").alias("numbers"),
        F.coalesce(text.extract_doi(value), F.lit("none")).alias("doi"),
    )


def number_preservation(spark, sf):
    turns = table(spark, sf, "conversations")
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", "text")
    answered = turns.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"), F.char_length("text").alias("n"))
    pairs = asked.join(answered, ["conv_id", "turn"])
    source = F.concat("text", F.lit(" 1,"), F.lpad("conv_id", 3, "0"), F.lit(" cases, "), "n", F.lit("% of them"))
    shown = F.when(F.col("conv_id") % 3 == 0, F.col("n") + 1).otherwise(F.col("n"))
    target = F.concat(F.lit("共报告1"), F.lpad("conv_id", 3, "0"), F.lit("例，其中占"), shown, F.lit("%"))
    return pairs.select(
        "conv_id",
        "turn",
        translation.check_translation(source, target).alias("reason"),
        F.array_join(F.array_sort(translation.missing_numbers(source, target)), "|").alias("missing"),
    )


def _answers(spark, sf) -> DataFrame:
    return table(spark, sf, "conversations").where(F.col("role") == "assistant").select(
        F.col("conv_id").alias("task_id"),
        F.when(F.col("turn") % 4 == 1, "beta").otherwise("alpha").alias("provider"),
        F.concat(F.lit("m"), "turn").alias("model"),
        F.col("turn").alias("model_rank"),
        F.col("text").alias("payload"),
    )


def first_valid_answer(spark, sf):
    tasks = table(spark, sf, "conversations").select(F.col("conv_id").alias("task_id")).distinct()
    best = attempts.first_valid(_answers(spark, sf), F.char_length("payload") >= 150, ["alpha", "beta"])
    out = attempts.resolve(tasks, best, F.lit("no answer"))
    return out.select(
        F.col("task_id").alias("conv_id"), "status", F.coalesce("provider", F.lit("")).alias("provider"),
        F.coalesce("model", F.lit("")).alias("model"), F.md5("payload").alias("payload_md5"),
    )


def attempts_best(spark, sf):
    log = table(spark, sf, "events").select(
        F.col("user_id").alias("task_id"),
        F.col("event_type").alias("provider"),
        F.col("event_id").cast("string").alias("model"),
        F.col("event_id").alias("model_rank"),
        F.col("props").alias("payload"),
        "value",
    )
    best = attempts.first_valid(log, F.col("value") > 60, ["click", "view", "purchase"])
    return best.select(F.col("task_id").alias("user_id"), "provider", "model", "payload", "failed_before")


def json_recovery(spark, sf):
    form, props = F.col("event_id") % 4, F.col("props")
    raw = (
        F.when(form == 0, F.concat(F.lit("```json\n"), props, F.lit("\n```")))
        .when(form == 1, F.concat(F.lit("Here it is: "), props, F.lit(" - done")))
        .when(form == 2, props)
        .otherwise(F.concat(F.lit("no answer "), "event_id"))
    )
    found = text.recover_json(raw)
    return table(spark, sf, "events").select(
        "event_id", F.coalesce(F.try_variant_get(found, "$.k", "bigint"), F.lit(-1)).alias("k")
    )


def glossary_protect(spark, sf):
    rows = records(spark, sf)
    hidden = translation.protect(F.col("body"), GLOSSARY)
    back = translation.restore(F.upper(hidden), GLOSSARY)
    return rows.select("doc_id", F.md5(hidden).alias("protected_md5"), F.md5(back).alias("restored_md5"))


def glossary_repair(spark, sf):
    rows = records(spark, sf)
    fixed_text = translation.repair(F.concat(F.lit("宋病毒 , "), "title", F.lit(" ; 汉塔病毒 。")), GLOSSARY)
    return rows.select("doc_id", fixed_text.alias("repaired"))


def _glossary_table(spark, sf) -> DataFrame:
    """Two glossaries that grow with the data: long words of the benchmark texts for one profile, of turns for the other."""

    def words(name: str, profile: str, least: int) -> DataFrame:
        found = F.regexp_extract_all(F.lower("text"), F.lit(f"[a-z]{{{least},}}"), 0)
        return table(spark, sf, name).select(F.lit(profile).alias("profile_id"), F.explode(found).alias("source"))

    pos = F.conv(F.substring(F.md5("source"), 1, 12), 16, 10).cast("long")
    return words("benchmark", "even", 6).union(words("conversations", "odd", 12)).distinct().withColumns({"pos": pos, "target": F.concat(F.lit("词"), pos.cast("string"))})


def _profiled(spark, sf) -> DataFrame:
    return records(spark, sf).select("doc_id", "title", "text", F.when(F.col("doc_id") % 2 == 0, "even").otherwise("odd").alias("profile_id"))


def glossary_by_profile(spark, sf):
    """Whole texts with the terms of their profile's glossary hidden, and with targets in their place."""
    found = glossary.with_terms(_profiled(spark, sf), glossary.glossary_entries(_glossary_table(spark, sf)), "text")
    hidden = found.select("doc_id", "profile_id", "terms", glossary.protect_terms(F.col("text"), F.col("terms")).alias("hidden"))
    back = glossary.restore_terms(F.col("hidden"), F.col("terms"))
    return hidden.select("doc_id", "profile_id", F.size("terms").cast("long").alias("n_terms"), F.md5("hidden").alias("protected_md5"), F.md5(back).alias("restored_md5"))


def glossary_repair_by_profile(spark, sf):
    entries = glossary.glossary_entries(_glossary_table(spark, sf))
    mixed = F.concat(F.lit("宋病毒 , "), "title", F.lit(" ; 汉塔病毒 。")).alias("answer")
    rows = _profiled(spark, sf).select("doc_id", "profile_id", mixed)
    return glossary.repair_terms(rows, entries, "answer").select("doc_id", "repaired")


def _memory(spark, sf) -> DataFrame:
    rows = records(spark, sf).where(F.col("doc_id") % 3 == 0)
    key = translation.memory_key(F.lit("title"), F.col("title"), GLOSSARY)
    return rows.groupBy(key.alias("key")).agg(F.concat(F.lit("译"), F.min("title")).alias("text"), F.lit(1).cast("bigint").alias("seq"))


def memory_routes(spark, sf):
    shown = F.when(F.col("doc_id") % 10 == 9, F.repeat(F.lit("汉坦病毒"), 8)).when(F.col("doc_id") % 10 == 8, "").otherwise(F.col("title"))
    rows = records(spark, sf).select("doc_id", shown.alias("title"))
    routed = translation.route_fields(translation.fields_long(rows, "doc_id", ["title"]), _memory(spark, sf), GLOSSARY)
    return routed.select("doc_id", "field", "route")


def _resolved(spark, sf) -> DataFrame:
    rows = records(spark, sf).select("doc_id", "title", "source")
    routed = translation.route_fields(translation.fields_long(rows, "doc_id", ["title", "source"]), _memory(spark, sf), GLOSSARY)
    doc = F.col("doc_id")
    spoken = F.array(
        F.struct(F.lit("model").alias("provider"), F.when(doc % 2 == 0, F.concat(F.lit("病毒标题编号"), doc)).otherwise("").alias("text")),
        F.struct(F.lit("second").alias("provider"), F.when(doc % 5 != 0, F.concat(F.lit("后备标题编号"), doc)).otherwise("bad").alias("text")),
    )
    answers = routed.where(F.col("field") == "title").select("doc_id", "field", F.explode(spoken).alias("a")).select("doc_id", "field", "a.*")
    return translation.resolve_fields(routed, answers, GLOSSARY, "doc_id", ["model", "second"])


def field_resolution(spark, sf):
    return _resolved(spark, sf).select("doc_id", "field", "status", F.coalesce("translated", F.lit("")).alias("translated"))


def record_translations(spark, sf):
    out = translation.record_fields(_resolved(spark, sf), "doc_id")
    return out.select("doc_id", "title_zh", "title_translated", F.col("analysis_zh")["source"].alias("source_zh"))


def memory_upserts(spark, sf):
    return translation.memory_upsert(_memory(spark, sf), _resolved(spark, sf), seq=2).select("key", "text", "seq")


def _word_index(rows: DataFrame, words: Column) -> DataFrame:
    """``rows`` with idx: map of word to positions, as one feed delivers texts. Built in the row: no word is shuffled."""
    placed = F.sort_array(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("pos"))))
    at = lambda i: F.get("_placed", i)["word"]
    starts = F.filter(F.sequence(F.lit(0), F.size("_placed") - 1), lambda i: (i == 0) | (at(i) != at(i - 1)))
    end = lambda k: F.coalesce(F.get("_starts", k + 1), F.size("_placed"))
    entry = F.transform("_starts", lambda s, k: F.struct(at(s).alias("word"), F.slice("_placed", s + 1, end(k) - s)["pos"].alias("at")))
    marked = rows.withColumn("_placed", placed).withColumn("_starts", starts)
    return marked.withColumn("idx", F.map_from_entries(entry)).drop("_placed", "_starts")


def inverted_index_rebuild(spark, sf):
    words = F.split(text.squeeze(F.col("text")), " ")
    index = _word_index(table(spark, sf, "documents").where(F.col("text").isNotNull()), words)
    rebuilt = text.rebuild_from_positions(F.col("idx"))
    return index.select("doc_id", F.md5(rebuilt).alias("text_md5"), F.char_length(rebuilt).cast("bigint").alias("n_chars"))


def ordered_distinct(spark, sf):
    kept = text.unique_strings(F.split(F.col("text"), " "))
    return records(spark, sf).select("doc_id", F.array_join(kept, "|").alias("words"))


def cjk_share(spark, sf):
    value = F.concat("title", F.repeat(F.lit("汉坦病毒"), (F.col("doc_id") % 7).cast("int")))
    return records(spark, sf).select(
        "doc_id", text.cjk_count(value).cast("bigint").alias("n_cjk"), text.is_chinese(value).alias("is_chinese")
    )


def history_upsert(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("profile_id"), day("o_orderdate").alias("issue_date"), "o_orderkey"
    )

    def issues(odd: int, run: str) -> DataFrame:
        part = orders.where(F.col("o_orderkey") % 2 == odd)
        return part.groupBy("profile_id", "issue_date").agg(F.count("*").alias("n")).withColumn("run", F.lit(run))

    index = sinks.update_index(issues(0, "old"), issues(1, "new"))
    return index.select("profile_id", "issue_date", "n", "run", F.col("pos").cast("bigint").alias("pos"))


def issue_snapshots(spark, sf):
    """Written twice; the second run replaces its own dates only."""
    path = scratch_path(spark, "issues")
    orders = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("profile_id"),
        F.date_format("o_orderdate", "yyyy").alias("issue_date"),
        "o_orderkey",
    )
    sinks.write_issue(orders.withColumn("run", F.lit(1)), path)
    sinks.write_issue(orders.where((F.col("profile_id") < "3") & (F.col("o_orderkey") % 2 == 0)).withColumn("run", F.lit(2)), path)
    latest = sinks.latest_issue(spark, path)
    return latest.select("profile_id", F.col("issue_date").cast("string").alias("issue_date"), "o_orderkey", F.col("run").cast("bigint").alias("run"))


def audit_lines(spark, sf):
    """JSON lines appended in two runs and read back."""
    path = scratch_path(spark, "audit")
    rows = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    for toxic in (0, 1):
        sinks.write_audit(rows.where(F.col("toxic") == toxic), path, ["doc_id", "source", "quality", "toxic"])
    return spark.read.schema("doc_id bigint, source string, quality int, toxic int").json(path)


def capped_batches(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey")
    out = ranking.capped_batches(rows, "l_partkey", "l_orderkey", per_query=2, by=["l_suppkey"])
    return out.select("l_partkey", F.col("pos").cast("bigint").alias("pos"), F.col("batch").cast("bigint").alias("batch"))


def sliding_issue_counts(spark, sf):
    out = daily.sliding_issue_counts(table(spark, sf, "events"), ["event_type"])
    return out.select(day("window_start").alias("window_start"), day("window_end").alias("window_end"), "event_type", "n")


def _stream(spark, sf) -> DataFrame:
    schema = table(spark, sf, "events").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def sliding_issue_counts_stream(spark, sf):
    counts = daily.sliding_issue_counts(_stream(spark, sf), ["event_type"])
    path = scratch_path(spark, "counts")
    query = daily.upsert_batches(counts, scratch_path(spark, "counts-state"), daily.write_updates(path))
    query.awaitTermination()
    key = ["window_start", "window_end", "event_type"]
    out = daily.latest_updates(spark.read.parquet(path), key)
    return out.select(day("window_start").alias("window_start"), day("window_end").alias("window_end"), "event_type", "n")


def first_seen(spark, sf):
    out = daily.first_seen(table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"])
    return out.select("user_id", "event_type", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


def first_seen_stream(spark, sf):
    path = scratch_path(spark, "seen")
    keys = _stream(spark, sf).select("user_id", "event_type", "ts")
    daily.run_once(daily.first_seen(keys, ["user_id", "event_type"], late="40 days"), path, scratch_path(spark, "seen-state"))
    return spark.read.parquet(path).select("user_id", "event_type")


def event_snapshot_stream(spark, sf):
    """The newest event of each user and type, published batch by batch in an order that is not that of time."""
    source, path = scratch_path(spark, "arrivals"), scratch_path(spark, "snapshot")
    events = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value", "props")
    events.repartition(4, "event_id").write.parquet(source)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(source)
    sink = snapshot.publish(path, ["user_id", "event_type"], ["ts", "event_id"], buckets=8)
    daily.upsert_batches(stream, scratch_path(spark, "snapshot-state"), sink, "append").awaitTermination()
    return snapshot.read_snapshot(spark, path).select("user_id", "event_type", "event_id", "value", "props")


def union_sources(spark, sf):
    docs = records(spark, sf).select(
        F.lit("documents").alias("source"), "title", F.concat(F.lit("doc:"), "doc_id").alias("url"), F.col("source").alias("publisher"), F.col("lang").alias("language")
    )
    pages = _page_news(spark, sf).select(F.lit("pages").alias("source"), "title", "url")
    talk = table(spark, sf, "conversations").select(
        F.lit("conversations").alias("source"), text.squeeze(F.col("text")).alias("title"), F.concat_ws(":", F.lit("conv"), "conv_id", "turn").alias("url"), F.col("role").alias("publisher")
    )
    rows = landing.union_sources({"a": docs, "b": pages, "c": talk, "d": None}, NEWS, spark)
    none = F.lit("")
    return rows.select("source", F.coalesce("title", none).alias("title"), "url", F.coalesce("publisher", none).alias("publisher"), F.coalesce("language", none).alias("language"))


def feed_selection(spark, sf):
    docs = records(spark, sf).select(
        F.col("lang").alias("profile_id"), F.col("doc_id").alias("ord"), "title",
        F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("译"), "title")).alias("title_zh"),
        F.lit(None).cast("string").alias("summary_zh"), F.concat(F.lit("u:"), "doc_id").alias("url"),
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("10.1/"), "doc_id")).alias("doi"),
    )
    papers = ranking.top_k(docs, 24, [F.col("ord")], ["profile_id"], name="issue_rank")
    news = ranking.top_k(docs.withColumn("resolved_url", F.when(F.col("ord") % 5 == 0, F.concat(F.lit("r:"), "ord"))), 36, [F.col("ord").desc()], ["profile_id"], name="issue_rank")
    return sinks.feed_rows(papers, news).withColumn("rank", F.col("rank").cast("bigint"))


def dictionary_split(spark, sf):
    """Seed rows per document: all title words as terms, those from the fourth on as names too, some in Chinese."""
    words = F.split(F.lower("title"), " ")
    docs = records(spark, sf).select(
        F.concat(F.lit("d"), "doc_id").alias("profile_id"),
        words.alias("seed_terms"),
        F.slice(words, 4, F.greatest(F.size(words), F.lit(1))).alias("virus_names"),
        F.lit(None).cast("array<string>").alias("disease_names_en"),
        F.when(F.col("doc_id") % 2 == 0, F.array(F.concat(F.lit("汉坦"), "doc_id"))).alias("disease_names_zh"),
        F.lit(None).cast("string").alias("display_name_en"),
        F.lit(None).cast("string").alias("display_name_zh"),
    )
    built = dictionary.build_dictionary(docs)
    return built.select(
        "profile_id",
        F.array_join("english_terms", "|").alias("english_terms"),
        F.array_join("chinese_terms", "|").alias("chinese_terms"),
        F.array_join(F.get("query_groups", F.lit(1))["terms"], "|").alias("clinical_terms"),
    )


def profile_overlay(spark, sf):
    """Proposed profiles overlay the fallback where they are usable."""
    part = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("profile_id"), F.split("p_name", " ").alias("english_terms"))
    groups = F.array(F.struct(F.lit("core").alias("id"), F.lit(None).cast("string").alias("purpose"), F.col("english_terms").alias("terms"), F.array().cast("array<string>").alias("topics"), F.array().cast("array<string>").alias("negative_terms")))
    fallback = part.withColumn("query_groups", groups)
    key = F.col("profile_id").cast("bigint")
    empty = F.array().cast("array<string>")
    proposed = part.where(key % 2 == 0).select(
        "profile_id", F.when(key % 4 == 0, F.array(F.lit("new"))).otherwise(empty).alias("english_terms"), groups.alias("query_groups")
    )
    out = dictionary.overlay_profile(fallback, proposed)
    return out.select("profile_id", F.array_join("english_terms", " ").alias("english_terms"))


# Feed adapters run on payloads that Spark derives from the documents.


def _payload_docs(spark, sf) -> DataFrame:
    return records(spark, sf).select("doc_id", "title", "body", "lang", "source", F.col("doc_id").cast("string").alias("id"))


def _date_text() -> Column:
    return F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 300).cast("int")), "yyyy-MM-dd")


def _adapted(df: DataFrame) -> DataFrame:
    none = F.lit("")
    return df.select(
        F.coalesce("doi", none).alias("doi"),
        F.coalesce("title", none).alias("title"),
        F.md5(F.coalesce("abstract", none)).alias("abstract_md5"),
        F.array_join("authors", "|").alias("authors"),
        F.coalesce("journal", none).alias("journal"),
        F.coalesce(day("online_date"), none).alias("online_date"),
        F.coalesce("url", none).alias("url"),
    )


def _json(payload: Column) -> Column:
    return F.to_json(payload)


def europe_pmc_feed(spark, sf):
    item = F.struct(
        "id", F.concat(F.lit("10.1/E"), "id").alias("doi"), F.concat(F.lit("<i>"), "title", F.lit("</i>")).alias("title"),
        F.col("body").alias("abstractText"), F.concat_ws(", ", F.lit("B A"), "lang", "lang").alias("authorString"),
        F.col("source").alias("journalTitle"), _date_text().alias("firstPublicationDate"), F.lit("Y").alias("isOpenAccess"),
    )
    rows = _payload_docs(spark, sf).select(_json(F.struct(F.struct(F.array(item).alias("result")).alias("resultList"))).alias("p"))
    return _adapted(scholarly.europe_pmc_rows(landing.from_json_payload(rows, "p", scholarly.EUROPE_PMC)))


def crossref_feed(spark, sf):
    parts = F.array(F.array(*[F.regexp_extract(_date_text(), r"(\d+)-(\d+)-(\d+)", i).cast("int") for i in (1, 2, 3)]))
    item = F.struct(
        F.concat(F.lit("10.1/C"), "id").alias("DOI"), F.array("title").alias("title"), F.col("body").alias("abstract"),
        F.array(F.struct(F.lit("Ada").alias("given"), F.col("lang").alias("family"))).alias("author"),
        F.array("source").alias("container-title"), F.struct(parts.alias("date-parts")).alias("published-online"),
    )
    rows = _payload_docs(spark, sf).select(_json(F.struct(F.struct(F.array(item).alias("items")).alias("message"))).alias("p"))
    return _adapted(scholarly.crossref_rows(landing.from_json_payload(rows, "p", scholarly.CROSSREF)))


def semantic_scholar_feed(spark, sf):
    item = F.struct(
        F.col("id").alias("paperId"), "title", F.col("body").alias("abstract"), F.array(F.struct(F.col("lang").alias("name"))).alias("authors"),
        _date_text().alias("publicationDate"), F.struct(F.col("source").alias("name")).alias("journal"),
        F.struct(F.concat(F.lit("10.1/S"), "id").alias("DOI")).alias("externalIds"), F.concat(F.lit("https://s.example/"), "id").alias("url"),
    )
    rows = _payload_docs(spark, sf).select(_json(F.struct(F.array(item).alias("data"))).alias("p"))
    return _adapted(scholarly.semantic_scholar_rows(landing.from_json_payload(rows, "p", scholarly.SEMANTIC_SCHOLAR)))


def openalex_feed(spark, sf):
    """The abstract travels as a word index built from the body's words."""
    # Cut: conditions on the payload would be pushed below and build the index again for each word.
    docs = cut(_word_index(_payload_docs(spark, sf), F.when(F.col("body") != "", F.split("body", " "))).drop("body"))
    index = F.col("idx")
    item = F.struct(
        F.concat(F.lit("https://o.example/W"), "id").alias("id"), F.struct(F.concat(F.lit("https://doi.org/10.1/O"), "id").alias("doi")).alias("ids"),
        "title", index.alias("abstract_inverted_index"),
        F.array(F.struct(F.struct(F.col("lang").alias("display_name")).alias("author"))).alias("authorships"),
        F.struct(F.struct(F.col("source").alias("display_name")).alias("source")).alias("primary_location"), _date_text().alias("publication_date"),
    )
    rows = docs.select(_json(F.struct(F.array(item).alias("results"))).alias("p"))
    return _adapted(scholarly.openalex_rows(landing.from_json_payload(rows, "p", scholarly.OPENALEX)))


def preprint_feed(spark, sf):
    item = F.struct(
        F.concat(F.lit("10.1/P"), "id").alias("doi"), "title", F.col("body").alias("abstract"),
        F.concat_ws("; ", F.lit("A, B"), "lang", F.lit("a")).alias("authors"), _date_text().alias("date"), F.lit("2").alias("version"), F.lit("biorxiv").alias("server"),
    )
    rows = _payload_docs(spark, sf).select(_json(F.struct(F.array(item).alias("collection"))).alias("p"))
    return _adapted(scholarly.preprint_rows(landing.from_json_payload(rows, "p", scholarly.PREPRINTS)))


def _escaped(value: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        value = F.replace(value, F.lit(raw), F.lit(safe))
    return value


def pubmed_feed(spark, sf):
    title, body = _escaped(F.col("title")), _escaped(F.col("body"))
    months = F.array(*[F.lit(m.title()) for m in fixed.MONTHS])
    month = F.element_at(months, (F.col("doc_id") % 12 + 1).cast("int"))
    markup = F.concat(
        F.lit("<PubmedArticle><MedlineCitation><PMID>"), "id", F.lit("</PMID><Article><Journal><Title>"), "source",
        F.lit("</Title><JournalIssue><PubDate><Year>2023</Year></PubDate></JournalIssue></Journal><ArticleTitle>A <i>b</i> "), title,
        F.lit('</ArticleTitle><Abstract><AbstractText Label="AIM">x<b>y</b></AbstractText><AbstractText>'), body,
        F.lit("</AbstractText></Abstract><AuthorList><Author><LastName>"), "lang",
        F.lit("</LastName><ForeName>Ada</ForeName></Author><Author><CollectiveName>Team</CollectiveName></Author></AuthorList><ArticleDate><Year>2024</Year><Month>"), month,
        F.lit("</Month><Day>05</Day></ArticleDate></Article></MedlineCitation><PubmedData><ArticleIdList><ArticleId IdType=\"doi\">10.1/M"), "id",
        F.lit("</ArticleId></ArticleIdList></PubmedData></PubmedArticle>"),
    )
    rows = _payload_docs(spark, sf).select(markup.alias("p"))
    return _adapted(scholarly.pubmed_rows(landing.from_xml_payload(rows, "p", scholarly.PUBMED)))


def _adapted_news(df: DataFrame) -> DataFrame:
    none = F.lit("")
    return df.select(
        "source", F.coalesce("title", none).alias("title"), "url", F.coalesce(day("published_date"), none).alias("published_date"),
        F.md5(F.coalesce("excerpt", none)).alias("excerpt_md5"), F.coalesce("publisher", none).alias("publisher"), "language",
    )


def rss_feed(spark, sf):
    stamp = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 300).cast("int")), "EEE, dd MMM yyyy")
    markup = F.concat(
        F.lit("<item><title>"), _escaped(F.col("title")), F.lit("</title><link>https://n.example/"), "id", F.lit("</link><description>&lt;p&gt;"),
        _escaped(F.col("body")), F.lit("&lt;/p&gt;</description><pubDate>"), stamp, F.lit(' 10:00:00 GMT</pubDate><source url="https://p.example">'),
        "source", F.lit("</source></item>"),
    )
    rows = _payload_docs(spark, sf).select(markup.alias("p"))
    return _adapted_news(news_feeds.rss_rows(landing.from_xml_payload(rows, "p", news_feeds.RSS), "rss", "en"))


def atom_feed(spark, sf):
    day_text = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 300).cast("int")), "yyyy-MM-dd")
    markup = F.concat(
        F.lit("<entry><title>"), _escaped(F.col("title")), F.lit('</title><link rel="self" href="https://s.example/x"/><link href="https://a.example/'), "id",
        F.lit('"/><content type="html">&lt;p&gt;'), _escaped(F.col("body")), F.lit("&lt;/p&gt;</content><updated>"), day_text,
        F.lit("T10:00:00Z</updated><author><name>"), "source", F.lit("</name></author></entry>"),
    )
    rows = _payload_docs(spark, sf).select(markup.alias("p"))
    return _adapted_news(news_feeds.atom_rows(landing.from_xml_payload(rows, "p", news_feeds.ATOM), "atom", "en"))


def gdelt_feed(spark, sf):
    item = F.struct("title", F.concat(F.lit("https://g.example/"), "id").alias("url"), F.concat(F.replace(_date_text(), F.lit("-"), F.lit("")), F.lit("T101500Z")).alias("seendate"), F.col("source").alias("domain"), F.col("lang").alias("language"))
    rows = _payload_docs(spark, sf).select(_json(F.struct(F.array(item).alias("articles"))).alias("p"))
    return _adapted_news(news_feeds.gdelt_rows(landing.from_json_payload(rows, "p", news_feeds.GDELT)))


def reliefweb_feed(spark, sf):
    fields = F.struct("title", F.concat(F.lit("https://r.example/"), "id").alias("url"), F.concat(F.lit("<p>"), "body", F.lit("</p>")).alias("body"), F.struct(F.concat(_date_text(), F.lit("T00:00:00+00:00")).alias("created")).alias("date"), F.array(F.struct(F.col("source").alias("name")), F.struct(F.col("lang").alias("name"))).alias("source"))
    rows = _payload_docs(spark, sf).select(_json(F.struct(F.array(F.struct(fields.alias("fields"))).alias("data"))).alias("p"))
    return _adapted_news(news_feeds.reliefweb_rows(landing.from_json_payload(rows, "p", news_feeds.RELIEFWEB)))


def section_buckets(spark, sf):
    title, body = _escaped(F.col("title")), _escaped(F.col("body"))
    markup = F.concat(
        F.lit("<article><front><abstract><p>"), title, F.lit("</p></abstract></front><body><sec><title>Study design</title><p>"), body,
        F.lit("</p><sec><title>Main findings</title><p>"), title, F.lit("</p></sec></sec><sec><title>Notes</title><p>"), F.col("lang"), F.lit("</p></sec></body></article>"),
    )
    rows = _payload_docs(spark, sf).select("doc_id", content.section_map(markup).alias("m"))
    return rows.select("doc_id", F.explode("m").alias("bucket", "t")).select("doc_id", "bucket", F.md5("t").alias("text_md5"))


def passage_texts(spark, sf):
    passages = F.transform(evidence.evidence_list(F.col("body"), "A"), lambda e: F.struct(e["text"].alias("text")))
    rows = _payload_docs(spark, sf).select("doc_id", _json(F.struct(F.array(F.struct(passages.alias("passages"))).alias("documents"))).alias("p"))
    joined = content.passages_text(F.col("p"))
    return rows.select("doc_id", F.md5(joined).alias("text_md5"), F.char_length(joined).cast("bigint").alias("n_chars"))


def linked_data_pages(spark, sf):
    """Pages with linked data, with meta tags only, or with a main element."""
    kind = F.col("doc_id") % 3
    graph = _json(F.struct(F.array(F.struct(F.lit("NewsArticle").alias("@type"), F.col("title").alias("headline"), F.col("body").alias("articleBody"))).alias("@graph")))
    safe = _escaped(F.col("title"))
    html = (
        F.when(kind == 0, F.concat(F.lit('<html><head><link rel="canonical" href="/c/'), "id", F.lit('"><script type="application/ld+json">'), F.replace(graph, F.lit("</"), F.lit("<\\/")), F.lit("</script></head><body><article>x</article></body></html>")))
        .when(kind == 1, F.concat(F.lit('<html><head><meta property="og:title" content="T '), "id", F.lit('"><meta name="description" content="about '), "id", F.lit('"></head><body><p>y</p></body></html>')))
        .otherwise(F.concat(F.lit("<html><body><nav>n</nav><div role=\"main\"><p>"), safe, F.lit("</p><script>s</script></div></body></html>")))
    )
    pages = _payload_docs(spark, sf).select("doc_id", F.lit("https://h.example/a/b").alias("url"), html.alias("html"))
    out = content.extract_pages(pages)
    return out.select("doc_id", "method", F.md5("content").alias("content_md5"), F.coalesce("content_title", F.lit("")).alias("content_title"), "resolved_url")


def flagship(spark, sf):
    """Score, group, merge and rank the corpus: one issue per source."""
    rows = records(spark, sf).select("doc_id", "source", "title", "body", "n_chars")
    scored = relevance.filter_relevant(relevance.relevance(rows, _terms(spark), body="body"))
    best = scored.withColumn("paper_id", text.stable_id("paper-", _key()))
    size = F.char_length("body")
    merged = best.groupBy("profile_id", "paper_id").agg(
        F.min("doc_id").alias("ord"),
        F.count("*").alias("n_records"),
        F.min_by("source", "doc_id").alias("source"),
        F.max_by(F.struct("title", "body"), F.struct(size, -F.col("doc_id"))).alias("b"),
        F.max("relevance_score").alias("relevance_score"),
        F.max("n_chars").alias("n_chars"),
    )
    top = ranking.top_k(merged, fixed.MAX_PAPERS, [F.col("relevance_score").desc(), F.col("n_chars").desc(), F.col("ord")], ["profile_id", "source"])
    return top.select(
        "profile_id", "source", F.col("rank").cast("bigint").alias("rank"), "paper_id", F.col("ord").alias("head_doc"), "n_records", "relevance_score", F.md5("b.body").alias("body_md5"),
    )


ALL: list[Query] = [
    flagship,
    normalize_titles,
    doc_identity_groups,
    merge_longest_text,
    availability_dates,
    window_filter_undated,
    parse_dates,
    relevance_scores,
    relevance_scores_large_dictionary,
    query_group_matches,
    query_group_counts,
    paper_type_split,
    topk_per_source,
    arrival_rank,
    metrics_rollup,
    issue_metrics,
    answer_validity,
    similar_titles,
    similar_titles_strict,
    title_leaders,
    news_dedup,
    news_duplicate_sources,
    paper_dedup,
    conflict_split,
    link_pages_to_docs,
    unlinked_pages,
    mentions_per_doc,
    review_band,
    verdict_removal,
    identity_check,
    enriched_papers,
    page_main_text,
    page_dense_text,
    page_contexts,
    page_links,
    candidate_rank,
    paper_candidates,
    best_turns,
    budgeted_attach,
    boilerplate_removed,
    strip_tags_pages,
    evidence_sentences,
    fallback_five,
    fallback_news_five,
    five_field_summaries,
    task_payloads,
    numbers_and_dois,
    number_preservation,
    first_valid_answer,
    attempts_best,
    json_recovery,
    glossary_protect,
    glossary_repair,
    glossary_by_profile,
    glossary_repair_by_profile,
    memory_routes,
    field_resolution,
    record_translations,
    memory_upserts,
    inverted_index_rebuild,
    ordered_distinct,
    cjk_share,
    history_upsert,
    issue_snapshots,
    audit_lines,
    capped_batches,
    sliding_issue_counts,
    sliding_issue_counts_stream,
    first_seen,
    first_seen_stream,
    event_snapshot_stream,
    union_sources,
    feed_selection,
    dictionary_split,
    profile_overlay,
    europe_pmc_feed,
    crossref_feed,
    semantic_scholar_feed,
    openalex_feed,
    preprint_feed,
    pubmed_feed,
    rss_feed,
    atom_feed,
    gdelt_feed,
    reliefweb_feed,
    section_buckets,
    passage_texts,
    linked_data_pages,
]


def all_queries() -> dict[str, Query]:
    return {q.__name__: q for q in ALL}
