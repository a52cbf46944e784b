"""Leader clustering: each record joins the first earlier leader it resembles.

A record's title never changes once it leads, so the leaders are the
lexicographically first maximal independent set of the similarity graph, and a
follower belongs to its earliest leader. The set is found by prefixes (Blelloch,
Fineman and Shun, SPAA 2012): decide an early part of the order, match all later
records against its leaders only, drop the matched ones, go on with the rest.
A large group of near copies thus costs one comparison per copy, and its pairs
are never listed.

With authors, a leader that has none takes that of its first follower with one,
and later records are judged by it. Who follows whom then depends on what was
adopted, and the reverse: both are computed in turn until nothing changes. What
is decided about a record depends on earlier records only, so there is one such
state, that of the loop over the records in order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litwire import fixed
from litwire.functions.fuzzy import indel_ratio
from litwire.operators.joins import lookup_join
from litwire.operators.similarity import GramStats, gram_stats, similar_pairs
from litwire.session import cut

SMALL_BATCH = 2_000
#: Like pairs that a prefix may hold: for each open title, and at least. Titles of the sample they are estimated from.
PAIRS_PER_TITLE, LEAST_PAIRS, SAMPLE = 20, 1_000_000, 2_000
LEVELS = 10


def same_author(a: str = "author_a", b: str = "author_b"):
    """Either first author is missing, or the two are alike."""
    return (F.col(a) == "") | (F.col(b) == "") | (indel_ratio(F.col(a), F.col(b)) >= fixed.AUTHOR_RATIO)


def _edges(titles: DataFrame, threshold: int, stats: GramStats, right: DataFrame | None = None) -> DataFrame:
    """a, b of like titles; with authors also theirs, and whether these allow the pair as long as ``a`` adopts none."""
    pairs = similar_pairs(titles, threshold, right=right, stats=stats, ids_only=True).select("a", "b")
    if "author" not in titles.columns:
        return pairs
    for side, known in (("a", titles), ("b", titles if right is None else right)):
        pairs = lookup_join(pairs, known.select(F.col("ord").alias(side), F.col("author").alias(f"author_{side}")), side)
    return pairs.select("a", "b", "author_a", "author_b", same_author().alias("alike"))


def _settle(edges: DataFrame, decide: Callable[[DataFrame], DataFrame], adopted: DataFrame | None) -> tuple[DataFrame, DataFrame | None]:
    """(b, leader) of the followers by ``decide``, and the authors (a, adopted, since) that leaders without one have by then."""
    if "author_a" not in edges.columns:
        return decide(edges), None
    known = adopted if adopted is not None else edges.sparkSession.createDataFrame([], "a long, adopted string, since long")
    before = known
    while True:
        placed = edges.join(known, "a", "left")
        later = (F.col("author_a") == "") & (F.col("author_b") != "") & (F.col("since") < F.col("b"))
        fits = F.when(later, indel_ratio(F.col("adopted"), F.col("author_b")) >= fixed.AUTHOR_RATIO).otherwise(F.col("alike"))
        led = cut(decide(cut(placed.where(fits).select("a", "b"))))
        named = edges.where((F.col("author_a") == "") & (F.col("author_b") != ""))
        first = led.withColumnRenamed("leader", "a").join(named, ["a", "b"]).groupBy("a").agg(F.min_by("author_b", "b").alias("adopted"), F.min("b").alias("since"))
        # What was adopted from earlier records stays.
        now = cut(before.unionByName(first).groupBy("a").agg(F.min_by("adopted", "since").alias("adopted"), F.min("since").alias("since")))
        changed = now.exceptAll(known).union(known.exceptAll(now))
        if changed.isEmpty():
            return led, now
        known = now


def resolve_leaders(edges: DataFrame) -> DataFrame:
    """Followers (b) and their leader (a) in a graph of edges a < b."""
    live, followers = edges, []
    while True:
        first = live.select("a").distinct().join(live.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
        lost = cut(live.join(first, "a", "left_semi").select("b").distinct())
        followers.append(lost)
        as_a = lost.withColumnRenamed("b", "a")
        live = cut(live.join(as_a, "a", "left_anti").join(lost, "b", "left_anti").select("a", "b"))
        if live.isEmpty():
            break
    lost = reduce(DataFrame.unionByName, followers)
    led = edges.join(lost.withColumnRenamed("b", "a"), "a", "left_anti")
    return led.groupBy("b").agg(F.min("a").alias("leader"))


def _prefix_cut(open_titles: DataFrame, threshold: int, left: int, small: int, budget: int) -> int | None:
    """Last ``ord`` of the largest prefix with about ``budget`` pairs at most of like titles.

    NULL means everything fits. The like pairs of a sample are counted by
    level, and one row reaches the driver. They only decide where prefixes
    end; a prefix has about ``small`` titles at least.
    """
    shares = sorted({4.0**-k for k in range(LEVELS, 0, -1) if 4.0**-k * left > small} | {min(1.0, small / left)})
    cuts = sorted(set(open_titles.agg(F.percentile_approx("ord", shares, 10_000)).first()[0]))
    step = max(1, left // SAMPLE)
    # Ids are spread by another function than the one that deals titles to pieces.
    sample = cut(open_titles.where(F.pmod(F.hash("ord"), F.lit(step)) == 0))
    pairs = similar_pairs(sample, threshold, ids_only=True)
    like = pairs.agg(*[F.count_if(F.col("b") <= c).alias(f"c{i}") for i, c in enumerate(cuts)], F.count("*").alias("all")).first()
    if like["all"] * step**2 <= budget:
        return None
    return max([c for c, n in zip(cuts, like) if n * step**2 <= budget], default=cuts[0])


def leader_clusters(titles: DataFrame, threshold: int, budget: int | None = None, small: int = SMALL_BATCH) -> DataFrame:
    """(ord, leader) for every title; leaders point to themselves.

    ``titles`` holds distinct rows (block, ord, norm[, author]), ``ord`` a
    unique BIGINT. Pairs are sought inside a block.
    """
    everything = cut(titles)
    stats = gram_stats(everything, threshold)
    rest, found, adopted = everything, [], None
    while True:
        left = rest.count()
        stop = None if left <= small else _prefix_cut(rest, threshold, left, small, budget or max(LEAST_PAIRS, PAIRS_PER_TITLE * left))
        batch = rest if stop is None else rest.where(F.col("ord") <= stop)
        edges = cut(_edges(batch, threshold, stats))
        if not edges.isEmpty():
            led, own = _settle(edges, resolve_leaders, None)
            found.append(led.select(F.col("b").alias("ord"), "leader"))
            adopted = own if adopted is None else cut(adopted.unionByName(own))
        if stop is None:
            break
        later = rest.where(F.col("ord") > stop)
        leaders = batch if edges.isEmpty() else batch.join(found[-1].select("ord"), "ord", "left_anti")
        # Leaders are compared with later titles only, and the partial minimum
        # keeps one row per matched title.
        ahead = _edges(leaders, threshold, stats, right=later)
        ahead = cut(ahead) if "author" in titles.columns else ahead
        matched, own = _settle(ahead, lambda live: live.groupBy("b").agg(F.min("a").alias("leader")), adopted)
        matched, adopted = cut(matched), own
        found.append(matched.select(F.col("b").alias("ord"), "leader"))
        rest = cut(later.join(matched.select(F.col("b").alias("ord")), "ord", "left_anti"))
    ids = everything.select("ord")
    if not found:
        return ids.withColumn("leader", F.col("ord"))
    followers = reduce(DataFrame.unionByName, found)
    return ids.join(followers, "ord", "left").select("ord", F.coalesce("leader", "ord").alias("leader"))
