"""Sharding by best-fit-decreasing bin packing of groups that stay together.

Rows of a group are added up; groups are put in order of size by a range
shuffle. Groups of at least a small share of a shard are items of their own,
smaller ones that follow each other are bundled up to that share, so the
number of items depends on the number of shards, not on the rows. Items enter
the bin with the least room that is enough, found in a balanced tree.
"""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litwire.llm.common import LAST, packed, with_results
from litwire.llm.running import running
from litwire.session import cut

#: A bundle of small groups starts within this part of a shard.
GRAIN = 1024
#: Fixed-capacity shards that one task packs.
SECTION = 512


class RoomTree:
    """Balanced search tree (a treap) over (room, bin): the tightest bin with enough room."""

    def __init__(self):
        self.root, self.odds = None, random.Random(1)

    def _split(self, node, key):
        """Trees of keys below ``key`` and of the others; a node is [key, priority, left, right]."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _merge(self, left, right):
        if left is None or right is None:
            return left or right
        if left[1] > right[1]:
            left[3] = self._merge(left[3], right)
            return left
        right[2] = self._merge(left, right[2])
        return right

    def add(self, room: int, bin: int) -> None:
        left, right = self._split(self.root, (room, bin))
        self.root = self._merge(self._merge(left, [(room, bin), self.odds.random(), None, None]), right)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the (room, bin) with the least room of at least ``size``; ties to the first bin."""
        node, found = self.root, None
        while node is not None:
            found, node = (node[0], node[2]) if node[0] >= (size, -1) else (found, node[3])
        if found:
            left, rest = self._split(self.root, found)
            _, right = self._split(rest, (found[0], found[1] + 1))
            self.root = self._merge(left, right)
        return found


def best_fit(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The bin of each of the descending ``sizes``; None if more than ``most`` bins are needed.

    A size beyond the capacity fills a bin of its own.
    """
    tree, bins, opened = RoomTree(), [], 0
    for size in sizes:
        found = tree.take(size)
        if found:
            room, bin = found
        else:
            if opened == most:
                return None
            room, bin, opened = max(capacity, size), opened, opened + 1
        if room > size:
            tree.add(room - size, bin)
        bins.append(bin)
    return bins


def even_fit(sizes: list[int], shards: int) -> list[int]:
    """Bins of nearly equal content: best fit at the least capacity (to one part in 2 * GRAIN) that needs no more than ``shards``.

    A size beyond an equal share of what is left gets a bin of its own.
    """
    alone, rest = 0, sum(sizes)
    while alone < min(len(sizes), shards - 1) and sizes[alone] * (shards - alone) > rest:
        rest -= sizes[alone]
        alone += 1
    left, free = sizes[alone:], shards - alone
    low, best = max(-(-rest // free), left[0] if left else 0), None
    high = low
    while best is None:
        best = best_fit(left, high, free)
        low, high = (low, high) if best is not None else (high, high + max(1, high // 16))
    while high - low > max(1, low // (2 * GRAIN)):
        middle = (low + high) // 2
        found = best_fit(left, middle, free)
        low, high, best = (middle, high, best) if found is None else (low, middle, found)
    return [*range(alone), *[alone + b for b in best]]


def pack_items(items: DataFrame, shards: int | None, capacity: int | None) -> DataFrame:
    """item, section, bin of items (item, section, bytes): each section is packed in one task."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["bytes", "item"], ascending=[False, True])
        sizes = group["bytes"].tolist()
        group["bin"] = even_fit(sizes, shards) if shards else best_fit(sizes, capacity)
        return group[["item", "section", "bin"]]

    return items.groupBy("section").applyInPandas(pack, "item long, section int, bin long")


def shard_rows(docs: DataFrame, group: list[Column], size: Column, shards: int | None = None, capacity: int | None = None, id_col: str = "doc_id") -> DataFrame:
    """All columns of ``docs`` with ``size``, ``shard`` and ``slot`` (these replace columns of the same names).

    Give either the number of ``shards``, to be filled as evenly as groups
    allow, or the ``capacity`` of a shard, of which as few as possible are
    filled. Rows with equal ``group`` expressions (nulls are equal) share a
    shard, also where a group is larger than a shard: it then has one of its
    own. Sizes are whole numbers above 0. Groups of equal size are ordered by
    a hash of the group. Slots number a shard's rows from 0 without gaps, by
    id (missing ids last), rows with equal ids by group; the order of equal
    rows does not matter. An empty table gives an empty table.

    With ``capacity``, groups are dealt to sections of about ``SECTION``
    shards, each packed by one task; at most one shard of each section stays
    badly filled for want of groups.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give either shards or capacity")
    order = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST))
    marks = [F.xxhash64(*group).alias("_ka"), F.xxhash64(F.lit("b"), *group).alias("_kb")]
    rows = cut(docs.select(packed(docs).alias("_row"), order.alias("_o"), *marks, size.cast("long").alias("_size")))
    groups = rows.groupBy("_ka", "_kb").agg(F.sum("_size").alias("_bytes"))
    total = rows.agg(F.coalesce(F.sum("_size"), F.lit(0))).first()[0]
    grain = max(1, (capacity or total // shards) // GRAIN)
    placed = running(groups, [], [F.desc("_bytes"), F.col("_ka"), F.col("_kb")], {"_end": (F.sum, F.col("_bytes"))})
    item = F.expr(f"(_end - _bytes) div {grain}L").alias("item")
    sections = 1 if shards else max(1, total // (capacity * SECTION))
    placed = cut(placed.select("_ka", "_kb", "_bytes", item).withColumn("section", F.pmod(F.hash("item"), F.lit(sections))))
    bins = cut(pack_items(placed.groupBy("item", "section").agg(F.sum("_bytes").alias("bytes")), shards, capacity))
    # Numbers of shards go on from section to section.
    counts = bins.groupBy("section").agg(F.max("bin").alias("n")).orderBy("section").collect()  # a row for SECTION shards
    before, first = {}, 0
    for row in counts:
        before[row["section"]], first = first, first + row["n"] + 1
    starts = docs.sparkSession.createDataFrame(list(before.items()), "section int, _first long")
    bins = bins.join(F.broadcast(starts), "section").select("item", (F.col("_first") + F.col("bin")).cast("int").alias("_shard"))
    where = placed.join(bins, "item").select("_ka", "_kb", "_shard")
    dealt = rows.join(where, ["_ka", "_kb"])
    dealt = running(dealt, ["_shard"], [F.col("_o"), F.col("_ka"), F.col("_kb")], {"_slot": (F.sum, F.lit(1).cast("long"))})
    results = {"size": F.col("_size"), "shard": F.col("_shard"), "slot": F.col("_slot") - 1}
    return dealt.select(*with_results("_row", docs.columns, results))
