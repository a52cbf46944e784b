"""Profiles: seed rows to term lists, glossaries and query groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litwire import fixed
from litwire.functions.text import blank_to_null, unique_strings

SEED_LISTS = ["seed_terms", "virus_names", "disease_names_en", "disease_names_zh"]
SCORED_LISTS = ["english_terms", "chinese_terms", "virus_names", "disease_names_en", "disease_names_zh"]
_GROUPS = "array<struct<id:string,purpose:string,terms:array<string>,topics:array<string>,negative_terms:array<string>>>"


def _list(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast("array<string>"))


def build_dictionary(seeds: DataFrame) -> DataFrame:
    """One profile per seed row: merged terms split by script, with default
    query groups where the seed names none. Lists belong to one profile, so
    everything stays within the row."""
    merged = unique_strings(F.concat(*[_list(c) for c in SEED_LISTS]))
    chinese = r"[一-鿿]"
    rows = seeds.withColumn("_terms", F.when(F.size(merged) > 0, merged).otherwise(F.array("profile_id")))
    rows = rows.withColumns(
        {
            "english_terms": F.filter("_terms", lambda t: ~t.rlike(chinese)),
            "chinese_terms": F.filter("_terms", lambda t: t.rlike(chinese)),
        }
    )
    anchor = F.coalesce(F.get("english_terms", F.lit(0)), F.col("profile_id"), F.lit("pathogen"))
    empty = F.array().cast("array<string>")
    defaults = F.array(
        *[
            F.struct(
                F.lit(name).alias("id"),
                F.lit(None).cast("string").alias("purpose"),
                F.slice("english_terms", 1, most).alias("terms"),
                (F.array(*[F.lit(t) for t in topics]) if topics else empty).alias("topics"),
                F.lit(None).cast("array<string>").alias("negative_terms"),
            )
            for name, most, topics in fixed.DEFAULT_GROUPS
        ]
    )
    given = F.col("query_groups").cast(_GROUPS) if "query_groups" in seeds.columns else F.lit(None).cast(_GROUPS)
    keep = ["hosts", "transmission_terms", "negative_terms", "disease_names_en", "disease_names_zh"]
    viruses = unique_strings(_list("virus_names"))
    return rows.select(
        F.coalesce("profile_id", F.replace(F.lower(anchor), F.lit(" "), F.lit("_"))).alias("profile_id"),
        F.coalesce(blank_to_null(F.col("display_name_en")), anchor).alias("display_name_en"),
        F.coalesce(blank_to_null(F.col("display_name_zh")), anchor).alias("display_name_zh"),
        "english_terms",
        "chinese_terms",
        F.when(F.size(viruses) > 0, viruses).otherwise(F.col("english_terms")).alias("virus_names"),
        *[(unique_strings(_list(c)) if c in seeds.columns else empty).alias(c) for c in keep],
        F.when(F.size(given) > 0, given).otherwise(defaults).alias("query_groups"),
        F.lit("deterministic_seed_fallback").alias("generated_by"),
    )


def choose_profile(saved: DataFrame, bundled: DataFrame) -> DataFrame:
    """A saved profile comes before the bundled one of the same id."""
    rest = bundled.join(saved.select("profile_id"), "profile_id", "left_anti")
    return saved.unionByName(rest, allowMissingColumns=True)


def overlay_profile(fallback: DataFrame, proposed: DataFrame) -> DataFrame:
    """Overlay proposed values key by key where the proposal has both terms
    and query groups."""
    fields = [c for c in proposed.columns if c != "profile_id" and c in fallback.columns]
    ok = (F.size("english_terms") > 0) & (F.size("query_groups") > 0)
    good = proposed.where(ok).select("profile_id", F.struct(*fields).alias("_n"))
    joined = fallback.join(good, "profile_id", "left")
    return joined.select(
        *[F.coalesce(F.col(f"_n.{c}"), F.col(c)).alias(c) if c in fields else F.col(c) for c in fallback.columns]
    )


def profile_terms(profiles: DataFrame) -> DataFrame:
    """(profile_id, kind, term) of the lists used for scoring."""
    parts = [
        profiles.select("profile_id", F.lit(kind).alias("kind"), F.explode(kind).alias("term"))
        for kind in SCORED_LISTS
        if kind in profiles.columns
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def query_groups(profiles: DataFrame) -> DataFrame:
    """(profile_id, pos, id, purpose, terms, topics, negative_terms)."""
    rows = profiles.select("profile_id", F.posexplode("query_groups").alias("pos", "g"))
    return rows.select("profile_id", "pos", "g.*")
