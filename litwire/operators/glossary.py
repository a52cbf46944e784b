"""Glossaries as tables: terms of each profile are found, hidden, restored and repaired without a list in the plan.

The term index says which entries of its profile a text may hold. Those few
travel with the record and are replaced one after the other; what is replaced
is marked with private characters, so no later term can match in it, or across
its border. Texts are taken to hold none of these characters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litwire import fixed
from litwire.functions.text import clean_space, squeeze
from litwire.operators.ranking import global_rank
from litwire.operators.terms import TEXT_KEY, candidate_terms, text_key

#: Around the number of a replaced entry, and the digits of that number.
OPEN, CLOSE = "\ue001", "\ue002"
DIGITS, MARKED = "0123456789", "".join(chr(0xE010 + i) for i in range(10))
#: Letters that are equal to another one apart from case, but that lower case alone leaves different (fixed values).
ALIKE, PLAIN = "İıſςµϐϑϕϖϰϱϵẛ", "iisσμβθφπκρεṡ"


def fold(text: Column) -> Column:
    """Equal for texts that a pattern regardless of case takes for equal."""
    return F.translate(F.lower(F.translate(text, ALIKE, PLAIN)), ALIKE, PLAIN)


def glossary_entries(glossary: DataFrame) -> DataFrame:
    """profile_id, place, number, source, target of ``glossary`` (profile_id, pos, source, target).

    ``place`` (from 1) is the order in which entries were given, ``number``
    (from 0) the order in which they are applied: longest source first, then
    as given. Entries without source or target are left out.
    """
    source, target = clean_space(F.col("source")), clean_space(F.col("target"))
    rows = glossary.select("profile_id", "pos", source.alias("source"), target.alias("target")).where("source <> '' and target <> ''")
    placed = global_rank(rows, [F.col("pos"), F.col("source"), F.col("target")], "place", by=["profile_id"])
    ranked = global_rank(placed, [F.desc(F.char_length("source")), F.col("place")], "_rank", by=["profile_id"])
    return ranked.select("profile_id", "place", (F.col("_rank") - 1).alias("number"), "source", "target")


def with_terms(records: DataFrame, entries: DataFrame, text: str, name: str = "terms") -> DataFrame:
    """``records`` (with profile_id) and the entries of their profile that ``text`` holds, by number.

    Each is a struct (number, place, source, target); records without any, or
    without a profile, get an empty array. Records need no id.
    """
    key = text_key(F.col(text))
    texts = records.select(*key, fold(F.coalesce(F.col(text), F.lit(""))).alias("_text"))
    owned = entries.select("profile_id", fold(F.col("source")).alias("term"), F.struct("number", "place", "source", "target").alias("_e"))
    met = candidate_terms(texts, owned.select("term")).join(owned, "term")
    lists = met.groupBy(*[F.col(k).alias(f"{k}_") for k in TEXT_KEY], F.col("profile_id").alias("_p")).agg(F.sort_array(F.collect_set("_e")).alias("_found"))
    # Folded before the join: inside the filter it would be folded again for each entry.
    rows = records.select("*", *key, fold(F.col(text)).alias("_folded"))
    same = (F.col("_t1") == F.col("_t1_")) & (F.col("_t2") == F.col("_t2_")) & (F.col("profile_id") == F.col("_p"))
    held = F.filter("_found", lambda e: F.contains(F.col("_folded"), fold(e["source"])))
    none = F.array().cast(lists.schema["_found"].dataType)
    return rows.join(lists, same, "left").select(*records.columns, F.coalesce(held, none).alias(name))


def _replaced(text: Column, terms: Column, mark: Callable[[Column], Column]) -> Column:
    def one(value: Column, e: Column) -> Column:
        quoted = F.concat(F.lit("(?iu)\\Q"), F.replace(e["source"], F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
        token = F.concat(F.lit(OPEN), F.translate(mark(e).cast("string"), DIGITS, MARKED), F.lit(CLOSE))
        return F.regexp_replace(value, quoted, token)

    return F.aggregate(terms, text, one)


def token(number: Column) -> Column:
    return F.concat(F.lit("[T"), F.lpad(number.cast("string"), F.greatest(F.lit(4), F.char_length(number.cast("string"))), "0"), F.lit("]"))


def protect_terms(text: Column, terms: Column) -> Column:
    """``text`` with its ``terms`` (as ``with_terms`` gives them) hidden behind tokens, the longest first."""
    marked = _replaced(text, terms, lambda e: e["number"])

    def show(value: Column, e: Column) -> Column:
        number = F.translate(e["number"].cast("string"), DIGITS, MARKED)
        return F.replace(value, F.concat(F.lit(OPEN), number, F.lit(CLOSE)), token(e["number"]))

    return F.aggregate(terms, marked, show)


def restore_terms(text: Column, terms: Column) -> Column:
    """Targets in place of tokens, also of tokens in lower case."""

    def one(value: Column, e: Column) -> Column:
        name = token(e["number"])
        return F.replace(F.replace(value, name, e["target"]), F.lower(name), e["target"])

    return F.aggregate(terms, text, one)


def repair_terms(records: DataFrame, entries: DataFrame, text: str, name: str = "repaired") -> DataFrame:
    """``records`` with ``name``: fixed corrections, source terms left in ``text`` (in the order given), Chinese punctuation."""
    value = clean_space(F.col(text))
    for wrong, right in fixed.REPAIRS:
        value = F.replace(value, F.lit(wrong), F.lit(right))
    found = with_terms(records.withColumn("_value", value), entries, "_value", "_terms")
    placed = F.sort_array(F.transform("_terms", lambda e: F.struct(e["place"].alias("place"), e["source"].alias("source"), e["target"].alias("target"))))
    marked = _replaced(F.col("_value"), placed, lambda e: e["place"])

    def show(value: Column, e: Column) -> Column:
        number = F.translate(e["place"].cast("string"), DIGITS, MARKED)
        return F.replace(value, F.concat(F.lit(OPEN), number, F.lit(CLOSE)), e["target"])

    value = F.aggregate(placed, marked, show)
    for ascii_mark, mark in ((",", "，"), (";", "；")):
        value = F.replace(F.replace(value, F.lit(f" {ascii_mark}"), F.lit(mark)), F.lit(ascii_mark), F.lit(mark))
    value = F.replace(value, F.lit(" :"), F.lit("："))
    return found.select(*records.columns, squeeze(F.regexp_replace(value, r"\s+([。！？；，])", "$1")).alias(name))
