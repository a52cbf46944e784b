"""News feeds to news rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litwire.functions.dates import feed_date, parse_date
from litwire.functions.text import blank_to_null, clean_array, clean_space, strip_tags
from litwire.operators.content import harvest_links
from litwire.schemas import NEWS, conform
from litwire.sources.landing import read_json, read_xml

RSS = (
    "title string,link string,description string,pubDate string,updated string,author string,"
    "source struct<_url:string,_VALUE:string>"
)
ATOM = (
    "title struct<_type:string,_VALUE:string>,link array<struct<_href:string,_rel:string,_VALUE:string>>,summary struct<_type:string,_VALUE:string>,"
    "content struct<_type:string,_VALUE:string>,published string,updated string,author array<struct<name:string>>,source struct<title:string>"
)
GDELT = "articles array<struct<title:string,url:string,seendate:string,socialimage:string,domain:string,language:string>>"
RELIEFWEB = (
    "data array<struct<fields:struct<title:string,url:string,body:string,date:struct<created:string>,"
    "source:array<struct<name:string>>>>>"
)


def rss_rows(rows: DataFrame, source: str, language: str) -> DataFrame:
    return conform(
        rows.select(
            F.lit(source).alias("source"),
            clean_space(F.col("title")).alias("title"),
            clean_space(F.col("link")).alias("url"),
            F.coalesce(feed_date(F.col("pubDate")), feed_date(F.col("updated"))).alias("published_date"),
            strip_tags(F.col("description")).alias("excerpt"),
            clean_space(F.coalesce(F.col("source._VALUE"), F.col("author"))).alias("publisher"),
            F.lit(language).alias("language"),
        ),
        NEWS,
    )


def atom_rows(rows: DataFrame, source: str, language: str) -> DataFrame:
    """Atom entries: the link that is no other relation's, else the first; the summary, else the content."""
    plain = F.filter("link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    link = F.coalesce(F.get(plain, F.lit(0)), F.get("link", F.lit(0)))["_href"]
    told = F.coalesce(blank_to_null(F.col("summary._VALUE")), F.col("content._VALUE"))
    return conform(
        rows.select(
            F.lit(source).alias("source"),
            clean_space(F.col("title._VALUE")).alias("title"),
            clean_space(link).alias("url"),
            F.coalesce(feed_date(F.col("published")), feed_date(F.col("updated"))).alias("published_date"),
            strip_tags(told).alias("excerpt"),
            clean_space(F.coalesce(F.col("source.title"), F.get("author.name", F.lit(0)))).alias("publisher"),
            F.lit(language).alias("language"),
        ),
        NEWS,
    )


def gdelt_rows(rows: DataFrame) -> DataFrame:
    r = rows.select(F.explode("articles").alias("r"))
    return conform(
        r.select(
            F.lit("GDELT DOC 2.0").alias("source"),
            clean_space(F.col("r.title")).alias("title"),
            clean_space(F.col("r.url")).alias("url"),
            F.coalesce(
                F.try_to_date(F.regexp_extract("r.seendate", r"^(\d{8})T?", 1), "yyyyMMdd"), parse_date(F.col("r.seendate"))
            ).alias("published_date"),
            clean_space(F.col("r.socialimage")).alias("image_url"),
            clean_space(F.col("r.domain")).alias("publisher"),
            F.coalesce(blank_to_null(clean_space(F.col("r.language"))), F.lit("unknown")).alias("language"),
        ),
        NEWS,
    )


def reliefweb_rows(rows: DataFrame, most_chars: int | None = None) -> DataFrame:
    """``most_chars`` cuts the excerpt; without it, the whole body is kept."""
    body = strip_tags(F.col("r.body"))
    r = rows.select(F.explode("data.fields").alias("r"))
    return conform(
        r.select(
            F.lit("ReliefWeb").alias("source"),
            clean_space(F.col("r.title")).alias("title"),
            clean_space(F.col("r.url")).alias("url"),
            parse_date(F.col("r.date.created")).alias("published_date"),
            (body if most_chars is None else F.left(body, F.lit(most_chars))).alias("excerpt"),
            F.array_join(clean_array(F.transform("r.source", lambda s: s["name"])), ", ").alias("publisher"),
            F.lit("en").alias("language"),
        ),
        NEWS,
    )


def official_page_rows(pages: DataFrame, terms: Sequence[str], base: str, source: str, publisher: str) -> DataFrame:
    links = harvest_links(pages, terms, base)
    return conform(
        links.select(
            F.lit(source).alias("source"),
            F.col("link_title").alias("title"),
            F.col("link_url").alias("url"),
            F.lit(publisher).alias("publisher"),
            F.lit("en").alias("language"),
            F.lit(True).alias("official"),
        ),
        NEWS,
    )


def read_rss(spark: SparkSession, path: str, source: str, language: str) -> DataFrame:
    """Items of RSS files and entries of Atom files; a folder may hold both kinds."""
    items = rss_rows(read_xml(spark, path, "item", RSS), source, language)
    return items.unionByName(atom_rows(read_xml(spark, path, "entry", ATOM), source, language))


def read_gdelt(spark: SparkSession, path: str, per_file: bool = False) -> DataFrame:
    return gdelt_rows(read_json(spark, path, GDELT, per_file))


def read_reliefweb(spark: SparkSession, path: str, per_file: bool = False) -> DataFrame:
    return reliefweb_rows(read_json(spark, path, RELIEFWEB, per_file))
