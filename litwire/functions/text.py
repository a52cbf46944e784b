"""Column builders for record text. All but one stay in the JVM."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litwire import fixed

# Text outside these ranges may change under entity decoding or NFKC.
_MAY_CHANGE = (
    r"[^\x00-\x25\x27-\x7FÀ-ıĴ-ľŁ-ňŊ-ž"
    r"Α-Ωα-ωА-я–—‘-”"
    r"、。〈-】一-鿿가-힣\uE000]"
)
_SEPARATOR = "\ue000"


@F.pandas_udf(T.StringType())
def _decode_nfkc(text: pd.Series) -> pd.Series:
    def one(value: str) -> str:
        return unicodedata.normalize("NFKC", html.unescape(value))

    return text.map(one, na_action="ignore")


def squeeze(text: Column) -> Column:
    """Collapse any run of white space to one space and trim."""
    return F.trim(F.regexp_replace(text, r"(?U)[\s\x1C-\x1F]+", " "))


def clean_space(text: Column) -> Column:
    """Decode entities, apply NFKC, collapse white space.

    Only text that can change is sent to Python; the rest passes as NULL.
    """
    decoded = _decode_nfkc(F.when(text.rlike(_MAY_CHANGE), text))
    return squeeze(F.coalesce(decoded, text))


def clean_array(values: Column) -> Column:
    """``clean_space`` for every element, empty ones dropped.

    Python functions cannot run inside array expressions, so the elements
    travel as one text with a private separator.
    """
    joined = clean_space(F.array_join(values, _SEPARATOR))
    return F.filter(F.split(joined, f" ?{_SEPARATOR} ?"), lambda v: v != "")


def strip_tags(text: Column) -> Column:
    return clean_space(F.regexp_replace(text, "<[^>]+>", " "))


def blank_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def title_tokens(text: Column) -> Column:
    words = F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))
    for article in fixed.TITLE_ARTICLES:
        words = F.array_remove(words, article)
    return words


def normalize_title(text: Column) -> Column:
    """Lower case words without articles or punctuation, one space apart."""
    return F.array_join(title_tokens(text), " ")


def family_name(author: Column) -> Column:
    return F.element_at(F.split(normalize_title(author), " "), -1)


def fold_case(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def unique_strings(values: Column) -> Column:
    """Distinct non-empty strings regardless of case, first spelling kept.

    Sorted by folded value and place, the first of each run of equal values
    stays: the cost is that of sorting, also for the words of a long text.
    """
    clean = F.filter(F.transform(F.array_distinct(values), squeeze), lambda v: v != "")
    placed = F.sort_array(F.transform(clean, lambda v, i: F.struct(fold_case(v).alias("key"), i.alias("at"), v.alias("value"))))

    def firsts(placed: Column) -> Column:
        before = F.slice(F.concat(F.array(F.lit(None).cast("string")), placed["key"]), 1, F.size(placed))
        pairs = F.arrays_zip(placed.alias("x"), before.alias("before"))
        first = F.filter(pairs, lambda p: p["before"].isNull() | (p["before"] != p["x"]["key"]))
        return F.sort_array(F.transform(first, lambda p: F.struct(p["x"]["at"].alias("at"), p["x"]["value"].alias("value"))))["value"]

    # As the element of an array the sorted list is computed once; named four times, it would be four times.
    return F.transform(F.array(placed), firsts)[0]


def truncate(text: Column, limit: int) -> Column:
    """At most ``limit`` characters, the last being an ellipsis if cut."""
    cut = F.rtrim(F.substring(text, 1, max(1, limit - 1)))
    return F.when(F.char_length(text) <= limit, text).otherwise(F.concat(cut, F.lit("…")))


def extract_doi(text: Column) -> Column:
    hit = F.regexp_extract(text, f"(?i)({fixed.DOI})", 1)
    return blank_to_null(F.lower(F.regexp_replace(hit, r"[.,;)\]}]+$", "")))


def extract_dois(text: Column) -> Column:
    hits = F.regexp_extract_all(text, F.lit(f"(?i)({fixed.DOI})"), F.lit(1))
    return F.transform(hits, lambda d: F.lower(F.regexp_replace(d, r"[.,;)\]}]+$", "")))


def extract_numbers(text: Column, thousands_only: bool = False) -> Column:
    """Numbers with optional decimals and percent sign, not after a letter."""
    comma = r"(?<=\d),(?=\d{3}(?:\D|$))" if thousands_only else ","
    joined = F.regexp_replace(squeeze(text), comma, "")
    joined = F.regexp_replace(joined, r"(?<=\d)\s+(?=\d{3}(?:\D|$))", "")
    return F.regexp_extract_all(joined, F.lit(r"((?<![A-Za-z])\d+(?:\.\d+)?%?)"), F.lit(1))


def split_sentences(text: Column, most: int | None = None) -> Column:
    """Sentences of at least 20 characters, in order."""
    parts = F.split(squeeze(text), r"(?<=[.!?。！？])\s+|(?<=；)|(?<=;)\s+")
    # ``F.trim`` itself would take the place in the array as the characters to trim.
    kept = F.filter(
        F.transform(parts, lambda s: F.trim(s)), lambda s: F.char_length(s) >= fixed.MIN_SENTENCE_CHARS
    )
    return kept if most is None else F.slice(kept, 1, most)


def stable_id(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), F.left(F.sha2(key, 256), F.lit(16)))


def first_nonempty(*values: Column) -> Column:
    return F.coalesce(*[blank_to_null(v) for v in values])


def ensure_array(values: Column) -> Column:
    return F.coalesce(values, F.array().cast(T.ArrayType(T.StringType())))


def remove_boilerplate(text: Column, patterns: Sequence[str] = tuple(fixed.BOILERPLATE)) -> Column:
    """Drop stock phrases, then punctuation left at either end."""
    value = squeeze(text)
    for pattern in patterns:
        value = F.regexp_replace(value, f"(?i){pattern}", " ")
    edge = r"[\s,;:.\-–—]+"
    return squeeze(F.regexp_replace(value, f"^{edge}|{edge}$", ""))


def rebuild_from_positions(index: Column) -> Column:
    """Text from a map of word to positions; equal positions sort by word."""
    placed = F.flatten(
        F.transform(
            F.map_entries(index),
            lambda e: F.transform(
                e["value"], lambda p: F.struct(p.alias("pos"), e["key"].alias("word"))
            ),
        )
    )
    return F.array_join(F.transform(F.array_sort(placed), lambda s: s["word"]), " ")


def cjk_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[一-鿿]"))


def is_chinese(text: Column) -> Column:
    """More than a fifth of the characters are Chinese."""
    return cjk_count(text) > F.char_length(text) * 0.2


def recover_json(text: Column) -> Column:
    """The JSON inside an answer as VARIANT; NULL if there is none.

    Tries the whole text without its code fence, then the widest ``{...}``,
    then the widest ``[...]``.
    """
    raw = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    bare = F.regexp_replace(F.regexp_replace(raw, r"^```(?:json)?\s*", ""), r"\s*```$", "")
    raw = F.when(raw.startswith("```"), bare).otherwise(raw)
    tries = [raw, F.regexp_extract(raw, r"(?s)(\{.*\})", 1), F.regexp_extract(raw, r"(?s)(\[.*\])", 1)]
    return F.coalesce(*[F.try_parse_json(blank_to_null(t)) for t in tries])


def five_field_summary(labels: Column, fields: Column) -> Column:
    """``label：text`` for five elements, shortened until it fits 300 chars."""

    def joined(width: int) -> Column:
        parts = F.transform(
            F.arrays_zip(labels.alias("l"), fields.alias("f")),
            lambda p: F.concat(p["l"], F.lit("："), truncate(p["f"], width)),
        )
        return F.array_join(parts, " ")

    wide = joined(72)
    return F.when(F.char_length(wide) <= 300, wide).otherwise(truncate(joined(48), 300))
