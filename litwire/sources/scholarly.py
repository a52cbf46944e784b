"""Scholarly feeds to paper rows. Each ``*_rows`` takes parsed payload rows,
so files and payload tables share it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litwire.functions.dates import date_from_parts, parse_date
from litwire.functions.text import (
    blank_to_null,
    clean_array,
    clean_space,
    rebuild_from_positions,
    squeeze,
    strip_tags,
    unique_strings,
)
from litwire.schemas import PAPER, conform
from litwire.sources.landing import read_json, read_xml

_PARTS = "struct<Year:string,Month:string,Day:string>"
PUBMED = (
    "MedlineCitation struct<PMID:string,DateCreated:" + _PARTS + ",Article:struct<"
    "Journal:struct<Title:string,JournalIssue:struct<Volume:string,Issue:string,PubDate:" + _PARTS + ">>,"
    "ArticleTitle:string,Abstract:string,"
    "AuthorList:struct<Author:array<struct<CollectiveName:string,ForeName:string,LastName:string>>>,"
    "Pagination:struct<MedlinePgn:string>,ArticleDate:array<" + _PARTS + ">,"
    "PublicationTypeList:struct<PublicationType:array<string>>>>,"
    "PubmedData struct<ArticleIdList:struct<ArticleId:array<struct<_IdType:string,_VALUE:string>>>>"
)
EUROPE_PMC = (
    "resultList struct<result:array<struct<id:string,source:string,pmid:string,pmcid:string,doi:string,title:string,"
    "abstractText:string,authorString:string,authorList:struct<author:array<struct<fullName:string>>>,"
    "journalTitle:string,pubYear:string,journalVolume:string,issue:string,pageInfo:string,"
    "firstPublicationDate:string,electronicPublicationDate:string,creationDate:string,"
    "journalInfo:struct<printPublicationDate:string>,pubType:string,isOpenAccess:string,"
    "fullTextUrlList:struct<fullTextUrl:array<struct<url:string>>>>>>"
)
_DATE_PARTS = "struct<`date-parts`:array<array<string>>>"
CROSSREF = (
    "message struct<items:array<struct<DOI:string,title:array<string>,abstract:string,"
    "author:array<struct<given:string,family:string>>,`container-title`:array<string>,"
    f"`published-online`:{_DATE_PARTS},published:{_DATE_PARTS},`published-print`:{_DATE_PARTS},"
    "created:struct<`date-time`:string>,indexed:struct<`date-time`:string>,volume:string,issue:string,page:string,"
    "type:string,link:array<struct<URL:string>>,URL:string>>>"
)
SEMANTIC_SCHOLAR = (
    "data array<struct<paperId:string,title:string,abstract:string,authors:array<struct<name:string>>,year:string,"
    "publicationDate:string,publicationTypes:array<string>,journal:struct<name:string,volume:string,pages:string>,"
    "externalIds:struct<DOI:string,PubMed:string,PubMedCentral:string>,openAccessPdf:struct<url:string>,url:string>>"
)
OPENALEX = (
    "results array<struct<id:string,doi:string,ids:struct<pmid:string,doi:string>,title:string,"
    "abstract_inverted_index:map<string,array<int>>,"
    "authorships:array<struct<author:struct<display_name:string>>>,"
    "primary_location:struct<source:struct<display_name:string>,pdf_url:string,landing_page_url:string>,"
    "publication_year:string,publication_date:string,type:string>>"
)
PREPRINTS = (
    "collection array<struct<doi:string,title:string,authors:string,abstract:string,date:string,version:string,"
    "server:string>>"
)


def _ids(**values: Column) -> Column:
    entries = [F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in values.items()]
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["v"].isNotNull() & (e["v"] != "")))


def _lower(text: Column) -> Column:
    return blank_to_null(F.lower(clean_space(text)))


def _one(value: Column) -> Column:
    return F.filter(F.array(value), lambda v: v.isNotNull() & (v != ""))


def _year(text: Column) -> Column:
    return text.try_cast("int")


def _flat(markup: Column) -> Column:
    """Text of an element kept as markup: inline tags vanish without a gap."""
    return clean_space(F.regexp_replace(markup, "<[^>]+>", ""))


def pubmed_rows(rows: DataFrame) -> DataFrame:
    citation, article = F.col("MedlineCitation"), F.col("MedlineCitation.Article")
    entries = F.coalesce(F.col("PubmedData.ArticleIdList.ArticleId"), F.array().cast("array<struct<_IdType:string,_VALUE:string>>"))

    def article_id(kind: str) -> Column:
        last = F.try_element_at(F.filter(entries, lambda e: e["_IdType"] == kind), F.lit(-1))
        return blank_to_null(F.trim(last["_VALUE"]))

    part = r"(?s)<AbstractText([^>]*)>(.*?)</AbstractText>"
    pieces = F.arrays_zip(
        F.regexp_extract_all(article["Abstract"], F.lit(part), F.lit(1)).alias("a"),
        F.regexp_extract_all(article["Abstract"], F.lit(part), F.lit(2)).alias("t"),
    )
    labelled = F.transform(
        pieces,
        lambda p: F.concat(
            F.when(
                p["a"].rlike(r'(?<![A-Za-z])Label="[^"]+"'),
                F.concat(F.regexp_extract(p["a"], r'(?<![A-Za-z])Label="([^"]*)"', 1), F.lit(": ")),
            ).otherwise(""),
            F.trim(F.regexp_replace(p["t"], "<[^>]+>", "")),
        ),
    )
    names = F.transform(
        article["AuthorList"]["Author"],
        lambda a: F.coalesce(blank_to_null(a["CollectiveName"]), F.concat_ws(" ", a["ForeName"], a["LastName"])),
    )

    def day(parts: Column) -> Column:
        return date_from_parts(F.trim(parts["Year"]), F.trim(parts["Month"]), F.trim(parts["Day"]))

    issue = article["Journal"]["JournalIssue"]
    online, printed = day(F.get(article["ArticleDate"], F.lit(0))), day(issue["PubDate"])
    pmid = F.coalesce(article_id("pubmed"), blank_to_null(F.trim(citation["PMID"])))
    staged = rows.where(article.isNotNull()).withColumn("_abstract", F.array_join(labelled, " "))
    return conform(
        staged.select(
            F.lit("PubMed").alias("source"),
            _ids(pmid=pmid, pmcid=article_id("pmc")).alias("source_ids"),
            F.lower(article_id("doi")).alias("doi"),
            _flat(article["ArticleTitle"]).alias("title"),
            clean_space(F.col("_abstract")).alias("abstract"),
            clean_array(names).alias("authors"),
            clean_space(article["Journal"]["Title"]).alias("journal"),
            F.year(F.coalesce(printed, online)).alias("year"),
            clean_space(issue["Volume"]).alias("volume"),
            clean_space(issue["Issue"]).alias("issue"),
            clean_space(article["Pagination"]["MedlinePgn"]).alias("pages"),
            online.alias("online_date"),
            day(citation["DateCreated"]).alias("created_date"),
            printed.alias("published_date"),
            printed.alias("print_date"),
            clean_array(article["PublicationTypeList"]["PublicationType"]).alias("publication_types"),
            F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), pmid, F.lit("/")).alias("url"),
        ),
        PAPER,
    )


def europe_pmc_rows(rows: DataFrame) -> DataFrame:
    r = rows.select(F.explode("resultList.result").alias("r"))
    listed = F.filter(F.transform("r.authorList.author", lambda a: a["fullName"]), lambda n: n != "")
    split = unique_strings(F.split(F.coalesce("r.authorString", F.lit("")), ","))
    first = F.coalesce(blank_to_null(F.col("r.firstPublicationDate")), F.col("r.electronicPublicationDate"))
    urls = F.filter(F.transform("r.fullTextUrlList.fullTextUrl", lambda u: u["url"]), lambda u: u != "")
    return conform(
        r.select(
            F.lit("Europe PMC").alias("source"),
            _ids(pmid=F.col("r.pmid"), pmcid=F.col("r.pmcid"), epmc=F.col("r.id")).alias("source_ids"),
            _lower(F.col("r.doi")).alias("doi"),
            strip_tags(F.col("r.title")).alias("title"),
            strip_tags(F.col("r.abstractText")).alias("abstract"),
            F.when(F.size(F.coalesce(listed, F.array().cast("array<string>"))) > 0, listed).otherwise(split).alias("authors"),
            clean_space(F.col("r.journalTitle")).alias("journal"),
            _year(F.col("r.pubYear")).alias("year"),
            clean_space(F.col("r.journalVolume")).alias("volume"),
            clean_space(F.col("r.issue")).alias("issue"),
            clean_space(F.col("r.pageInfo")).alias("pages"),
            parse_date(first).alias("online_date"),
            parse_date(F.col("r.firstPublicationDate")).alias("first_publication_date"),
            parse_date(F.col("r.creationDate")).alias("created_date"),
            parse_date(F.col("r.journalInfo.printPublicationDate")).alias("published_date"),
            _one(F.col("r.pubType")).alias("publication_types"),
            (F.upper(F.coalesce("r.isOpenAccess", F.lit(""))) == "Y").alias("open_access"),
            F.coalesce(urls, F.array().cast("array<string>")).alias("full_text_urls"),
            F.concat(
                F.lit("https://europepmc.org/article/"), F.coalesce("r.source", F.lit("MED")), F.lit("/"), F.col("r.id")
            ).alias("url"),
        ),
        PAPER,
    )


def crossref_rows(rows: DataFrame) -> DataFrame:
    r = rows.select(F.explode("message.items").alias("r"))

    def day(field: str) -> Column:
        parts = F.get(F.col(f"r.`{field}`.`date-parts`"), F.lit(0))
        return date_from_parts(F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), F.get(parts, F.lit(2)))

    names = F.transform("r.author", lambda a: F.concat_ws(" ", a["given"], a["family"]))
    doi = F.col("r.DOI")
    return conform(
        r.select(
            F.lit("Crossref").alias("source"),
            F.create_map().cast("map<string,string>").alias("source_ids"),
            _lower(doi).alias("doi"),
            strip_tags(F.array_join("r.title", " ")).alias("title"),
            strip_tags(F.col("r.abstract")).alias("abstract"),
            clean_array(F.coalesce(names, F.array().cast("array<string>"))).alias("authors"),
            clean_space(F.array_join(F.col("r.`container-title`"), " ")).alias("journal"),
            F.year(F.coalesce(day("published-online"), day("published"))).alias("year"),
            clean_space(F.col("r.volume")).alias("volume"),
            clean_space(F.col("r.issue")).alias("issue"),
            clean_space(F.col("r.page")).alias("pages"),
            day("published-online").alias("online_date"),
            parse_date(F.col("r.created.`date-time`")).alias("created_date"),
            parse_date(F.col("r.indexed.`date-time`")).alias("indexed_date"),
            day("published").alias("published_date"),
            day("published-print").alias("print_date"),
            _one(F.col("r.type")).alias("publication_types"),
            F.filter("r.link", lambda x: x["URL"].isNotNull() & (x["URL"] != "")).alias("full_text_links"),
            F.coalesce(blank_to_null(clean_space(F.col("r.URL"))), F.concat(F.lit("https://doi.org/"), blank_to_null(doi))).alias("url"),
        ),
        PAPER,
    )


def semantic_scholar_rows(rows: DataFrame) -> DataFrame:
    r = rows.select(F.explode("data").alias("r"))
    ids = F.col("r.externalIds")
    return conform(
        r.select(
            F.lit("Semantic Scholar").alias("source"),
            _ids(semantic_scholar=F.col("r.paperId"), pmid=ids["PubMed"], pmcid=ids["PubMedCentral"]).alias("source_ids"),
            _lower(ids["DOI"]).alias("doi"),
            clean_space(F.col("r.title")).alias("title"),
            clean_space(F.col("r.abstract")).alias("abstract"),
            clean_array(F.transform("r.authors", lambda a: a["name"])).alias("authors"),
            clean_space(F.col("r.journal.name")).alias("journal"),
            _year(F.col("r.year")).alias("year"),
            clean_space(F.col("r.journal.volume")).alias("volume"),
            clean_space(F.col("r.journal.pages")).alias("pages"),
            parse_date(F.col("r.publicationDate")).alias("online_date"),
            F.col("r.publicationTypes").alias("publication_types"),
            clean_space(F.col("r.openAccessPdf.url")).alias("open_access_pdf"),
            clean_space(F.col("r.url")).alias("url"),
        ),
        PAPER,
    )


def openalex_rows(rows: DataFrame) -> DataFrame:
    r = rows.select(F.explode("results").alias("r"))
    r = r.withColumn("_abstract", rebuild_from_positions(F.col("r.abstract_inverted_index")))
    place = F.col("r.primary_location")
    pmid = blank_to_null(F.element_at(F.split(squeeze(F.col("r.ids.pmid")), "/"), -1))
    return conform(
        r.select(
            F.lit("OpenAlex").alias("source"),
            _ids(openalex=F.col("r.id"), pmid=pmid).alias("source_ids"),
            blank_to_null(F.lower(F.regexp_replace(clean_space(F.col("r.ids.doi")), "^https://doi\\.org/", ""))).alias("doi"),
            clean_space(F.col("r.title")).alias("title"),
            clean_space(F.col("_abstract")).alias("abstract"),
            clean_array(F.transform("r.authorships", lambda a: a["author"]["display_name"])).alias("authors"),
            clean_space(place["source"]["display_name"]).alias("journal"),
            _year(F.col("r.publication_year")).alias("year"),
            parse_date(F.col("r.publication_date")).alias("online_date"),
            _one(F.col("r.type")).alias("publication_types"),
            clean_space(place["pdf_url"]).alias("open_access_pdf"),
            clean_space(F.coalesce(blank_to_null(place["landing_page_url"]), blank_to_null(F.col("r.doi")), F.col("r.id"))).alias("url"),
        ),
        PAPER,
    )


def preprint_rows(rows: DataFrame, server: str | None = None) -> DataFrame:
    r = rows.select(F.explode("collection").alias("r"))
    name = F.lit(server) if server else F.coalesce("r.server", F.lit("preprint"))
    r = r.withColumns({"_doi": _lower(F.col("r.doi")), "_authors": clean_space(F.coalesce("r.authors", F.lit("")))})
    doi = F.col("_doi")
    version = F.coalesce("r.version", F.lit("1"))
    return conform(
        r.select(
            name.alias("source"),
            _ids(preprint=doi).alias("source_ids"),
            doi.alias("doi"),
            strip_tags(F.col("r.title")).alias("title"),
            strip_tags(F.col("r.abstract")).alias("abstract"),
            unique_strings(F.split("_authors", "[;,]")).alias("authors"),
            name.alias("journal"),
            F.left("r.date", F.lit(4)).try_cast("int").alias("year"),
            parse_date(F.col("r.date")).alias("online_date"),
            parse_date(F.col("r.date")).alias("first_publication_date"),
            F.array(F.lit("preprint")).alias("publication_types"),
            F.concat(F.lit("https://www."), name, F.lit(".org/content/"), doi, F.lit("v"), version).alias("url"),
        ),
        PAPER,
    )


def read_pubmed(spark: SparkSession, path: str) -> DataFrame:
    return pubmed_rows(read_xml(spark, path, "PubmedArticle", PUBMED))


def read_europe_pmc(spark: SparkSession, path: str, per_file: bool = False) -> DataFrame:
    return europe_pmc_rows(read_json(spark, path, EUROPE_PMC, per_file))


def read_crossref(spark: SparkSession, path: str, per_file: bool = False) -> DataFrame:
    return crossref_rows(read_json(spark, path, CROSSREF, per_file))


def read_semantic_scholar(spark: SparkSession, path: str, per_file: bool = False) -> DataFrame:
    return semantic_scholar_rows(read_json(spark, path, SEMANTIC_SCHOLAR, per_file))


def read_openalex(spark: SparkSession, path: str, per_file: bool = False) -> DataFrame:
    return openalex_rows(read_json(spark, path, OPENALEX, per_file))


def read_preprints(spark: SparkSession, path: str, server: str | None = None, per_file: bool = False) -> DataFrame:
    return preprint_rows(read_json(spark, path, PREPRINTS, per_file), server)
