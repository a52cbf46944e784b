"""Which terms of a dictionary of any size occur in which texts.

Each term is filed under one of its grams, the one that a bounded look at the
texts shows least often. Texts give the grams that some term may be filed
under (a bit field of fixed size tells), terms and texts meet in an equi-join
on grams, and ``contains`` decides. Grams are hashes: equal ones only add a
candidate. No term reaches the driver, and the texts are scanned once for
candidates, whatever the number of terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litwire.session import cut

#: Characters in a gram; a shorter term is filed under itself.
GRAM = 12
#: A power of two.
FIELD_BITS = 1 << 25
#: Texts that the choice of grams looks at. They decide speed, never results.
LOOKED_AT = 500
#: Stands between two texts of a record; no term crosses it.
BREAK = "\ue000"

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
TEXT_KEY = ["_t1", "_t2"]


def text_key(*texts: Column) -> list[Column]:
    """Two columns that equal texts share; rows need no id to find their terms."""
    return [F.xxhash64(*texts).alias("_t1"), F.xxhash64(F.lit("k"), *texts).alias("_t2")]


def _hashes(text: str, sizes: set[int]) -> np.ndarray:
    """Hashes of all runs of these numbers of characters."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    found, value = [], np.zeros(len(code), np.uint64)
    for n in range(1, max(sizes) + 1):
        if len(code) < n:
            break
        value = (value[: len(code) - n + 1] + code[n - 1 :] + np.uint64(1)) * _FACTOR
        value ^= value >> np.uint64(29)
        if n in sizes:
            found.append(value)
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)).view(np.int64)


def _term_grams(terms: DataFrame) -> DataFrame:
    """term, size, gram: every gram of each term, all of one size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = batch.column(0).to_pylist()
            sizes = [min(GRAM, len(t)) for t in terms]
            grams = [np.unique(_hashes(t, {n})) for t, n in zip(terms, sizes, strict=True)]
            rows = np.repeat(np.arange(len(terms)), np.array([len(g) for g in grams], np.int64))
            values = np.concatenate(grams) if grams else np.zeros(0, np.int64)
            columns = [batch.column(0).take(pa.array(rows)), pa.array(np.array(sizes, np.int32)[rows]), pa.array(values)]
            yield pa.RecordBatch.from_arrays(columns, names=["term", "size", "gram"])

    return terms.mapInArrow(run, "term string, size int, gram long")


def _field(grams: DataFrame) -> tuple[np.ndarray, set[int]]:
    """A bit for each gram, in a field of fixed size, and the sizes of grams (at most GRAM * FIELD_BITS / 64 rows come to the driver)."""
    place = F.pmod(F.col("gram"), F.lit(FIELD_BITS))
    word, bit = F.shiftright(place, 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(gram, {FIELD_BITS}) % 64 as int))").alias("bit")
    words = grams.select("size", word, bit).groupBy("size", "word").agg(F.bit_or("bit").alias("bits"))
    field, sizes = np.zeros(FIELD_BITS // 64, np.int64), set()
    for row in words.collect():
        field[row["word"]] |= row["bits"]
        sizes.add(row["size"])
    return field.view(np.uint64), sizes


def _text_grams(texts: DataFrame, grams: DataFrame) -> DataFrame:
    """The key columns of ``texts`` (its last column is the text) and each gram that ``grams`` may hold."""
    shared = texts.sparkSession.sparkContext.broadcast(_field(grams))
    keep = texts.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field, sizes = shared.value
        for batch in batches:
            found = []
            for text in batch.column(batch.num_columns - 1):
                grams = _hashes(text.as_py() or "", sizes) if sizes else np.zeros(0, np.int64)
                place = grams & (FIELD_BITS - 1)  # like pmod by a power of two
                marked = (field[place >> 6] >> (place & 63).view(np.uint64)) & np.uint64(1)
                found.append(np.unique(grams[marked == 1]))
            rows = pa.array(np.repeat(np.arange(batch.num_rows), np.array([len(g) for g in found], np.int64)))
            columns = [batch.column(i).take(rows) for i in range(len(keep))]
            values = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.int64())], names=[*keep, "gram"])

    schema = ", ".join(f"{c} {texts.schema[c].dataType.simpleString()}" for c in keep)
    return texts.mapInArrow(run, f"{schema}, gram long")


def term_index(terms: DataFrame, texts: DataFrame) -> DataFrame:
    """term, size, gram: the gram that each distinct term is filed under, and its number of characters."""
    grams = _term_grams(terms.where(F.col("term") != "").select("term").distinct())
    seen = _text_grams(texts.limit(LOOKED_AT), grams).groupBy("gram").agg(F.count("*").alias("seen"))
    rated = grams.join(seen, "gram", "left").groupBy("term", "size")
    return cut(rated.agg(F.min_by("gram", F.struct(F.coalesce("seen", F.lit(0)), "gram")).alias("gram")))


def candidate_terms(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """``_t1``, ``_t2``, ``term``: every pair of a text and a term in it, and perhaps others.

    ``texts`` has the two key columns and the text; ``terms`` has a column
    ``term``. Both are compared as they are, so fold their case before. Empty
    terms are in no text.
    """
    index = term_index(terms, texts)
    return _text_grams(texts, index).join(index, "gram").select(*TEXT_KEY, "term")
