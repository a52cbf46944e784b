"""Reading landed payloads: JSON responses, XML documents, feeds."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litwire.schemas import conform


def read_json(spark: SparkSession, path: str, schema: str, per_file: bool = False) -> DataFrame:
    """One response per line, or ``per_file``; columns after ``schema``. Lines let Spark split a file between tasks."""
    if per_file:
        return from_json_payload(spark.read.text(path, wholetext=True), "value", schema)
    return spark.read.schema(schema).json(path)


def read_xml(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """One row per ``tag`` element; large files are split between tasks."""
    return spark.read.format("xml").option("rowTag", tag).schema(schema).load(path)


def from_json_payload(payloads: DataFrame, column: str, schema: str) -> DataFrame:
    """The same rows from a table that holds responses as text."""
    parsed = F.from_json(F.col(column), schema)
    return payloads.select(parsed.alias("_r")).select("_r.*")


def from_xml_payload(payloads: DataFrame, column: str, schema: str) -> DataFrame:
    parsed = F.from_xml(F.col(column), schema)
    return payloads.select(parsed.alias("_r")).select("_r.*")


def union_sources(parts: dict[str, DataFrame | None], schema: T.StructType, spark: SparkSession) -> DataFrame:
    """All feeds in one schema; a feed that is absent adds no rows."""
    frames = [conform(df, schema) for df in parts.values() if df is not None]
    return reduce(DataFrame.unionByName, frames, spark.createDataFrame([], schema))


def optional(load, *args) -> DataFrame | None:
    """A feed whose landing folder does not exist is skipped."""
    try:
        return load(*args)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def record_id(*parts: Column) -> Column:
    """A stable id from what the feed says about a record."""
    return F.concat(F.lit("rec-"), F.left(F.sha2(F.concat_ws("|", *parts), 256), F.lit(16)))
