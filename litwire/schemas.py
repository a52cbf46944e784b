"""The two record schemas every feed is brought to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRINGS = T.ArrayType(T.StringType())

PAPER = (
    T.StructType()
    .add("source", "string")
    .add("source_ids", T.MapType(T.StringType(), T.StringType()))
    .add("doi", "string")
    .add("title", "string")
    .add("abstract", "string")
    .add("authors", _STRINGS)
    .add("journal", "string")
    .add("year", "integer")
    .add("volume", "string")
    .add("issue", "string")
    .add("pages", "string")
    .add("online_date", "date")
    .add("first_publication_date", "date")
    .add("created_date", "date")
    .add("indexed_date", "date")
    .add("published_date", "date")
    .add("print_date", "date")
    .add("publication_types", _STRINGS)
    .add("open_access", "boolean")
    .add("full_text_urls", _STRINGS)
    .add("full_text_links", T.ArrayType(T.StructType().add("URL", "string")))
    .add("open_access_pdf", "string")
    .add("url", "string")
)

NEWS = (
    T.StructType()
    .add("source", "string")
    .add("title", "string")
    .add("url", "string")
    .add("published_date", "date")
    .add("excerpt", "string")
    .add("publisher", "string")
    .add("language", "string")
    .add("official", "boolean")
    .add("image_url", "string")
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in order; missing ones and blank texts are NULL."""
    columns = []
    for field in schema:
        if field.name not in df.columns:
            value = F.lit(None)
        elif isinstance(field.dataType, T.StringType):
            value = F.when(F.col(field.name) != "", F.col(field.name))
        else:
            value = F.col(field.name)
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)
