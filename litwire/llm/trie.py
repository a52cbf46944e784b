"""Conversation prefix trie by whole-sequence collapse.

Conversations are put in order once, each turn known by a digest. Running
exclusive-ors of the digests at their depth name every prefix by 128 bits.
Identical whole conversations collapse to one weighted sequence with a list of
ends; an anti-join against proper prefixes finds the leaves; and nodes are the
weighted prefixes of the sequences, added up. Sums over subtrees need no walk:
every node belongs to the sequence of its smallest member, a sequence owns the
lower end of its path, and the total of what it owns counts for every prefix
above that end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litwire.llm.running import running
from litwire.session import cut

KEY = ["depth", "ka", "kb"]
#: Ids in one piece of an end list.
CHUNK_IDS = 1 << 16


@dataclass
class Trie:
    """``nodes``: a row for each distinct prefix; ``ends``: depth, ka, kb of a node and the conv_id of each conversation that ends there."""

    nodes: DataFrame
    ends: DataFrame


def turn_digest(role: Column, text: Column) -> Column:
    """32 bytes that tell turns apart by role and text; missing ones are empty."""
    role, text = F.coalesce(role.cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit(""))
    return F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256))


def ordered_turns(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, pos (from 1), digest and n_bytes (UTF-8, of the text) of every turn.

    A null turn comes first. Turns with the same number are ordered by their
    digest, and equal rows stay, one after the other. Rows without id are left
    out: there is no conversation that they belong to.
    """
    rows = turns.where(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("conv_id"),
        F.col(f"`{turn_col}`").alias("turn"),
        turn_digest(F.col(f"`{role_col}`"), F.col(f"`{text_col}`")).alias("digest"),
        F.octet_length(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).cast("long").alias("n_bytes"),
    )
    placed = running(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("digest")], {"pos": (F.sum, F.lit(1).cast("long"))})
    return cut(placed.select("conv_id", "pos", "digest", "n_bytes"))


def whole(ordered: DataFrame) -> DataFrame:
    """conv_id, length, depth, digest, n_bytes of conversations as they are; see ``with_openings`` for the rows of depth 0."""
    return with_openings(ordered, F.col("conv_id"), F.lit(0))


def with_openings(ordered: DataFrame, source: Column, opening: Column) -> DataFrame:
    """Conversations that open with turns of another one.

    ``source`` and ``opening`` are expressions over ``conv_id``: its first
    ``opening`` turns are those of conversation ``source`` (all of them if
    there are fewer, none if there is no such conversation); its own turns
    after its first ``opening`` follow. Each conversation has a row of depth 0
    without digest, then a row per turn; ``length`` is the number of turns.
    """
    counts = ordered.groupBy("conv_id").agg(F.max("pos").alias("n"))
    plans = counts.select("conv_id", "n", source.cast("long").alias("source"), opening.cast("long").alias("opening"))
    found = counts.select(F.col("conv_id").alias("source"), F.col("n").alias("n_source"))
    shared = F.least("opening", F.coalesce("n_source", F.lit(0)))
    plans = plans.join(found, "source", "left").withColumn("shared", shared)
    plans = cut(plans.withColumn("length", F.col("shared") + F.greatest(F.col("n") - F.col("opening"), F.lit(0))))
    columns = ["conv_id", "length", "depth", "digest", "n_bytes"]
    own = ordered.join(plans.select("conv_id", "opening", "shared", "length"), "conv_id").where("pos > opening")
    own = own.withColumn("depth", F.col("pos") - F.col("opening") + F.col("shared"))
    asked = plans.where("shared > 0").select("conv_id", "length", "source", F.explode(F.sequence(F.lit(1).cast("long"), "shared")).alias("depth"))
    source_turns = ordered.select(F.col("conv_id").alias("source"), F.col("pos").alias("depth"), "digest", "n_bytes")
    opened = asked.join(source_turns, ["source", "depth"])
    root = plans.select("conv_id", "length", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("n_bytes"))
    return root.union(own.select(*columns)).union(opened.select(*columns))


def prefixes(sequences: DataFrame) -> DataFrame:
    """conv_id, length, depth, n_bytes, the key (ka, kb) of each prefix and that of the one before it (pa, pb)."""
    a = F.when(F.col("depth") > 0, F.xxhash64("depth", "digest")).otherwise(0)
    b = F.when(F.col("depth") > 0, F.xxhash64("digest", "depth", F.lit("b"))).otherwise(0)
    rows = sequences.select("conv_id", "length", "depth", "n_bytes", a.alias("xa"), b.alias("xb"))
    keyed = running(rows, ["conv_id"], [F.col("depth")], {"ka": (F.bit_xor, F.col("xa")), "kb": (F.bit_xor, F.col("xb"))})
    before = [F.col(k).bitwiseXOR(F.col(x)).alias(p) for k, x, p in (("ka", "xa", "pa"), ("kb", "xb", "pb"))]
    return cut(keyed.select("conv_id", "length", *KEY, "n_bytes", *before))


def prefix_trie(sequences: DataFrame) -> Trie:
    """The trie of ``sequences`` (as ``with_openings`` or ``whole`` give them).

    Columns of nodes: the key (depth, ka, kb), conv_id (the smallest member),
    parent_conv_id (that of the node above; null at the root), n_convs,
    n_children, n_leaves (nodes without children in the subtree, itself
    included) and saved_tokens ((n_convs - 1) * bytes of the last text, summed
    over the subtree). Without conversations there are no nodes.
    """
    every = prefixes(sequences)
    full = every.where("depth = length")
    # Identical conversations: one sequence, called by its smallest member.
    collapsed = cut(full.groupBy(*KEY).agg(F.count("*").alias("weight"), F.min("conv_id").alias("conv_id")))
    paths = cut(every.join(collapsed.select("conv_id", "weight"), "conv_id"))
    proper = paths.where("depth < length").select(*KEY).distinct()
    leaves = collapsed.join(proper, KEY, "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    added = paths.join(leaves, "conv_id", "left").groupBy(*KEY).agg(
        F.sum("weight").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.coalesce(F.sum("leaf"), F.lit(0)).alias("n_leaves"),
        F.min("n_bytes").alias("n_bytes"),
        F.min("pa").alias("pa"),
        F.min("pb").alias("pb"),
    )
    nodes = cut(added.withColumn("saved", (F.col("n_convs") - 1) * F.col("n_bytes")).drop("n_bytes"))
    # The lower end of a sequence's path that it owns: where it starts, and the total there.
    owned = nodes.groupBy("conv_id").agg(F.min("depth").alias("top"), F.sum("saved").alias("total"), F.min_by(F.struct("pa", "pb"), "depth").alias("p"))
    owned = cut(owned.select("conv_id", "top", "total", "p.pa", "p.pb"))
    above = paths.join(owned.select("conv_id", "top", "total"), "conv_id").where("depth < top")
    none = F.lit(0).cast("long")
    given = above.select(*KEY, F.col("total").alias("given"), none.alias("child"))
    child = nodes.where("depth > 0").select(F.col("depth") - 1, "pa", "pb", none, none + 1)
    sums = given.union(child).groupBy(*KEY).agg(F.sum("given").alias("given"), F.sum("child").alias("n_children"))
    # The root has by far the most children, and one owner; other parents are looked up.
    root = nodes.where("depth = 0").select((F.col("depth") + 1).alias("top"), F.col("conv_id").alias("root_conv"))
    heads = owned.where("top > 1").select(F.col("conv_id"), (F.col("top") - 1).alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb"))
    parents = heads.join(nodes.select(*KEY, F.col("conv_id").alias("parent")), KEY).select("conv_id", "parent")
    tops = owned.select("conv_id", "top").join(parents, "conv_id", "left").join(F.broadcast(root), "top", "left")
    below = running(nodes, ["conv_id"], [F.desc("depth")], {"own": (F.sum, F.col("saved"))})
    rows = below.join(tops, "conv_id").join(sums, KEY, "left")
    parent = F.when(F.col("depth") > F.col("top"), F.col("conv_id")).otherwise(F.coalesce("root_conv", "parent"))
    rows = rows.select(
        *KEY,
        "conv_id",
        parent.alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", none).alias("n_children"),
        "n_leaves",
        (F.col("own") + F.coalesce("given", none)).alias("saved_tokens"),
    )
    return Trie(rows, full.select(*KEY, "conv_id"))


LISTS = pa.schema([*[(k, pa.int64()) for k in [*KEY, "first"]], ("ids", pa.string())])
DIGESTS = pa.schema([*[(k, pa.int64()) for k in KEY], ("ends_sha256", pa.string())])


def rows_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True)) for row in rows], schema)


def end_lists(ends: DataFrame) -> DataFrame:
    """depth, ka, kb, first, ids: the ends of a node in ascending order, as text in pieces of bounded length."""

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, done = None, [], []
        for batch in batches:
            for *key, member in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if ids and (key != now or len(ids) == CHUNK_IDS):
                    done.append((*now, ids[0], ",".join(map(str, ids))))
                    ids = []
                now = key
                ids.append(member)
            yield rows_of(done, LISTS)
            done = []
        if ids:
            yield rows_of([(*now, ids[0], ",".join(map(str, ids)))], LISTS)

    pieces = ends.sparkSession.sparkContext.defaultParallelism * 4
    placed = ends.repartitionByRange(pieces, *KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    return placed.mapInArrow(join_ids, "depth long, ka long, kb long, first long, ids string")


def end_digests(ends: DataFrame) -> DataFrame:
    """depth, ka, kb, ends_sha256: the digest of each comma-joined end list, fed piece by piece."""

    def feed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["depth"], row["ka"], row["kb"])
                if key != now:
                    if state:
                        done.append((*now, state.hexdigest()))
                    now, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(row["ids"].encode())
            yield rows_of(done, DIGESTS)
            done = []
        if state:
            yield rows_of([(*now, state.hexdigest())], DIGESTS)

    lists = end_lists(ends).repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return lists.mapInArrow(feed, "depth long, ka long, kb long, ends_sha256 string")


def node_turns(nodes: DataFrame, sequences: DataFrame, turns: DataFrame, role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``nodes`` with the role and text of the last turn of each (null at the root)."""
    named = sequences.where("depth > 0").select("conv_id", "depth", "digest")
    role, text = F.col(f"`{role_col}`"), F.col(f"`{text_col}`")
    turns = turns.select(turn_digest(role, text).alias("digest"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    turns = turns.groupBy("digest").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    return nodes.join(named, ["conv_id", "depth"], "left").join(turns, "digest", "left").drop("digest")
