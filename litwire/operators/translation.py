"""Glossary protection, translation checks, memory and field resolution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litwire import fixed
from litwire.functions.text import (
    blank_to_null,
    cjk_count,
    clean_space,
    extract_numbers,
    is_chinese,
    squeeze,
)

MAX_GLOSSARY = 2_000


def ordered_glossary(rows: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """Non-empty entries, longest source first; equals keep their order."""
    kept = [(" ".join(s.split()), " ".join(t.split())) for s, t in rows if s and t]
    if len(kept) > MAX_GLOSSARY:
        raise ValueError(f"more than {MAX_GLOSSARY} entries do not go into a plan: keep them in a table (operators/glossary.py)")
    return sorted((e for e in kept if e[0] and e[1]), key=lambda e: -len(e[0]))


def _token(i: int) -> str:
    return f"[T{i:04d}]"


def _literal(text: str) -> str:
    return "(?iu)\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def _replacement(text: str) -> str:
    return text.replace("\\", "\\\\").replace("$", "\\$")


def protect(text: Column, glossary: Sequence[tuple[str, str]]) -> Column:
    """Glossary terms become tokens that survive an external translator."""
    for i, (source, _) in enumerate(ordered_glossary(glossary)):
        text = F.regexp_replace(text, _literal(source), _token(i))
    return text


def protected_tokens(text: Column, glossary: Sequence[tuple[str, str]]) -> Column:
    tokens = F.array(*[F.lit(_token(i)) for i, _ in enumerate(ordered_glossary(glossary))]) if glossary else F.array()
    return F.filter(tokens.cast("array<string>"), lambda t: F.contains(text, t))


def restore(text: Column, glossary: Sequence[tuple[str, str]]) -> Column:
    for i, (_, target) in enumerate(ordered_glossary(glossary)):
        for token in (_token(i), _token(i).lower()):
            text = F.replace(text, F.lit(token), F.lit(target))
    return text


def repair(text: Column, glossary: Sequence[tuple[str, str]], repairs=tuple(fixed.REPAIRS)) -> Column:
    """Fixed corrections, leftover source terms, then Chinese punctuation."""
    value = clean_space(text)
    for wrong, right in repairs:
        value = F.replace(value, F.lit(wrong), F.lit(right))
    for source, target in glossary:
        value = F.regexp_replace(value, _literal(source), _replacement(target))
    for ascii_mark, mark in ((",", "，"), (";", "；")):
        value = F.replace(F.replace(value, F.lit(f" {ascii_mark}"), F.lit(mark)), F.lit(ascii_mark), F.lit(mark))
    value = F.replace(value, F.lit(" :"), F.lit("："))
    return squeeze(F.regexp_replace(value, r"\s+([。！？；，])", "$1"))


def restore_repair(text: Column, glossary: Sequence[tuple[str, str]]) -> Column:
    return repair(restore(text, glossary), glossary)


def missing_numbers(source: Column, target: Column, thousands_only: bool = False) -> Column:
    return F.array_except(extract_numbers(source, thousands_only), extract_numbers(target, thousands_only))


def check_translation(source: Column, target: Column, thousands_only: bool = False) -> Column:
    """``ok`` or the reason a Chinese translation is refused."""
    value = squeeze(F.coalesce(target, F.lit("")))
    chinese = cjk_count(value)
    letters = F.regexp_count(value, F.lit(r"[A-Za-z一-鿿]"))
    forbidden = F.lit(False)
    for bad in fixed.FORBIDDEN:
        forbidden = forbidden | F.contains(value, F.lit(bad))
    return (
        F.when(value == "", "empty")
        .when((chinese < 2) | ((letters > 0) & (chinese < letters * 0.28)), "insufficient_chinese")
        .when(value.rlike(r"(.)\1{5,}"), "repeated_character_gibberish")
        .when(forbidden, "forbidden_pathogen_translation")
        .when(F.size(missing_numbers(F.coalesce(source, F.lit("")), value, thousands_only)) > 0, "number_loss")
        .otherwise("ok")
    )


def memory_key(field: Column, text: Column, glossary: Sequence[tuple[str, str]]) -> Column:
    listed = "\n".join(f"{s}\t{t}" for s, t in glossary)
    return F.sha2(F.concat_ws("|", field, text, F.sha2(F.lit(listed), 256)), 256)


def fields_long(records: DataFrame, id_col: str, fields: Sequence[str]) -> DataFrame:
    """(id, field, source_text), one row per record and field."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), squeeze(F.coalesce(f, F.lit(""))).alias("source_text")) for f in fields])
    return records.select(id_col, F.explode(pairs).alias("e")).select(id_col, "e.*")


def route_fields(fields: DataFrame, memory: DataFrame, glossary: Sequence[tuple[str, str]]) -> DataFrame:
    """Add key, memory text and route to (id, field, source_text).

    Routes: empty_source, source_already_chinese, from_memory, unresolved.
    The memory has one row per key, so repeated texts cost one probe each and
    the join side is chosen at run time from real sizes.
    """
    keyed = fields.withColumn("key", memory_key(F.col("field"), F.col("source_text"), glossary))
    known = memory.where(F.col("text") != "").select("key", F.col("text").alias("memory_text"))
    text = F.col("source_text")
    return keyed.join(known, "key", "left").withColumn(
        "route",
        F.when(text == "", "empty_source")
        .when(is_chinese(text), "source_already_chinese")
        .when(F.col("memory_text").isNotNull(), "from_memory")
        .otherwise("unresolved"),
    )


def resolve_fields(
    routed: DataFrame, answers: DataFrame, glossary: Sequence[tuple[str, str]], id_col: str, providers: Sequence[str]
) -> DataFrame:
    """Best translation per field: the first provider whose restored and
    repaired text passes the checks; a good field survives bad siblings.

    ``answers``: (id, field, provider, text), at most one per provider.
    """
    rank = F.array_position(F.array(*[F.lit(p) for p in providers]), F.col("provider"))
    open_rows = routed.where(F.col("route") == "unresolved").select(id_col, "field", "source_text")
    tried = (
        open_rows.join(answers, [id_col, "field"])
        .withColumn("_rank", rank)
        .where(F.col("_rank") > 0)
        .withColumn("_text", restore_repair(F.col("text"), glossary))
        .withColumn("_reason", check_translation(F.col("source_text"), F.col("_text")))
    )
    ok = F.col("_reason") == "ok"
    best = tried.groupBy(id_col, "field").agg(
        F.min_by(F.struct("provider", F.col("_text").alias("text")), F.when(ok, F.col("_rank"))).alias("_w"),
        F.max_by("_reason", F.when(~ok, F.col("_rank"))).alias("reason"),
    )
    route = F.col("route")
    done = F.col("_w.text").isNotNull()
    return (
        routed.join(best, [id_col, "field"], "left")
        .withColumns(
            {
                "translated": F.when(route == "source_already_chinese", F.col("source_text"))
                .when(route == "from_memory", F.col("memory_text"))
                .otherwise(F.col("_w.text")),
                "status": F.when(route != "unresolved", route)
                .when(done, F.concat(F.lit("passed_"), "_w.provider"))
                .otherwise("translation_unavailable"),
                "reason": F.when((route == "unresolved") & ~done, F.col("reason")),
            }
        )
        .drop("_w")
    )


def record_fields(resolved: DataFrame, id_col: str) -> DataFrame:
    """(id, fields map, title_zh, title_translated); absent texts get the
    fixed statements. A record has a handful of fields, so the map is small."""
    shown = F.coalesce(blank_to_null(F.col("translated")), F.lit(fixed.NEWS_NOT_REPORTED))
    title = F.col("field") == "title"
    return resolved.groupBy(id_col).agg(
        F.map_from_entries(F.collect_list(F.when(~title, F.struct("field", shown)))).alias("analysis_zh"),
        F.coalesce(F.max(F.when(title, blank_to_null(F.col("translated")))), F.lit(fixed.TITLE_UNAVAILABLE)).alias("title_zh"),
        F.bool_or(title & (F.col("translated") != "")).alias("title_translated"),
    )


def memory_upsert(memory: DataFrame, resolved: DataFrame, seq: int, cap: int | None = None) -> DataFrame:
    """Add newly accepted texts; the newest of a key wins. Without a cap no
    global sort is needed; with one the newest ``cap`` keys are kept."""
    fresh = resolved.where(F.col("status").startswith("passed_")).select(
        "key", F.col("translated").alias("text"), F.lit(seq).cast("bigint").alias("seq")
    )
    both = memory.select("key", "text", F.col("seq").cast("bigint").alias("seq")).unionByName(fresh)
    merged = both.groupBy("key").agg(F.max(F.struct("seq", "text")).alias("m")).select("key", "m.text", "m.seq")
    return merged if cap is None else merged.orderBy(F.col("seq").desc(), "key").limit(cap)
