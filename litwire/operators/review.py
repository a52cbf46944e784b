"""Groups of near duplicates for adjudication, and the verdicts on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litwire import fixed
from litwire.functions.text import squeeze
from litwire.operators.ranking import top_k
from litwire.operators.similarity import gram_stats, similar_pairs
from litwire.session import cut


def review_groups(
    items: DataFrame,
    low: int = fixed.REVIEW_LOW,
    high: float = fixed.REVIEW_HIGH,
    groups: int = fixed.REVIEW_GROUPS,
    size: int = fixed.REVIEW_GROUP_SIZE,
    first_heads: int = 64,
) -> DataFrame:
    """(block, group_no, pos, head, ord): the first groups of each block.

    ``items`` has (block, ord, norm). Only as many leading items are compared
    as it takes to fill the groups, so the whole band is never listed.
    """
    items = cut(items)
    stats = gram_stats(items, low)
    open_items, parts, start, stop = items, [], 0, first_heads
    order = [F.col("ord")]
    while True:
        ranked = top_k(open_items, stop, order, ["block"], name="_r").where(F.col("_r") > start).drop("_r")
        pairs = similar_pairs(ranked, low, below=high, right=open_items, stats=stats, ids_only=True).where(F.col("a") < F.col("b"))
        near = top_k(pairs.select("block", "a", "b"), size - 1, [F.col("b")], ["block", "a"], name="pos")
        parts.append(cut(near))
        found = reduce(DataFrame.unionByName, parts)
        filled = found.groupBy("block").agg(F.countDistinct("a").alias("n")).where(F.col("n") >= groups)
        # Few rows per block: blocks not yet filled that still have items left.
        seen = open_items.groupBy("block").agg(F.count("*").alias("n")).where(F.col("n") > stop)
        more = cut(seen.join(filled.select("block"), "block", "left_anti").select("block"))
        if more.isEmpty():
            break
        open_items = open_items.join(more, "block", "left_semi")
        start, stop = stop, stop * 8
    heads = top_k(found.select("block", "a").distinct(), groups, [F.col("a")], ["block"], name="group_no")
    kept = found.join(heads, ["block", "a"])
    first = heads.select("block", "group_no", F.lit(0).alias("pos"), F.col("a").alias("head"), F.col("a").alias("ord"))
    rest = kept.select("block", "group_no", "pos", F.col("a").alias("head"), F.col("b").alias("ord"))
    return first.unionByName(rest)


def review_tasks(groups: DataFrame, items: DataFrame) -> DataFrame:
    """One JSON payload per group for an external adjudicator.

    A group has at most ``size`` members, so collecting it is bounded.
    """
    fields = F.struct(
        F.col("ord").alias("index"),
        "title",
        "doi",
        F.slice("authors", 1, 4).alias("authors"),
        F.col("venue").alias("journal_or_publisher"),
        F.col("date").cast("string").alias("date"),
        F.left(squeeze(F.col("text")), F.lit(1200)).alias("abstract_or_excerpt"),
    )
    rows = groups.join(items, ["block", "ord"]).select("block", "group_no", F.struct("pos", fields.alias("item")).alias("m"))
    listed = rows.groupBy("block", "group_no").agg(F.array_sort(F.collect_list("m")).alias("ms"))
    return listed.select("block", "group_no", F.to_json(F.transform("ms", lambda m: m["item"])).alias("payload"))


def apply_verdicts(items: DataFrame, groups: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Drop the members a verdict declares duplicates of the kept one.

    ``verdicts`` has (block, group_no, indexes, keep); an index outside the
    asked group is ignored, as is a verdict on fewer than two.
    """
    cases = verdicts.where(F.size("indexes") >= 2).select(
        "block",
        "group_no",
        F.explode("indexes").alias("ord"),
        F.coalesce("keep", F.get("indexes", F.lit(0))).alias("keep"),
    )
    asked = groups.select("block", "group_no", "ord")
    gone = cases.where(F.col("ord") != F.col("keep")).join(asked, ["block", "group_no", "ord"], "left_semi")
    return items.join(gone.select("block", "ord").distinct(), ["block", "ord"], "left_anti")
