"""Line dedup: documents probe a sharded minimal perfect hash instead of joining lines.

Every line key is known by two hashes: 64 bits that lead to its shard and slot,
32 more that are its fingerprint. One aggregation finds the keys that several
documents hold; each shard lays them out as a minimal perfect hash with three
parallel arrays (fingerprint, count of lines, first document). Lines travel to
the shards as hashes and positions; texts are shuffled once, at the end.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from litwire.llm.common import LAST, WHITE, fold_ascii, mixed, packed, with_results
from litwire.session import cut

MIN_CHARS = 10
SHARD_KEYS = 20_000
SHARDS = (64, 4096)
PROBES = 100_000
LEVELS = 48


class PerfectHash:
    """Distinct 64-bit keys to 0..n-1: a cascade of bit fields, a slot being the rank of its bit.

    Keys that meet in one level go on to the next; what is left after the last
    level is kept as a sorted list.
    """

    def __init__(self, sizes: list[int], bits: list[np.ndarray], rest: np.ndarray):
        self.sizes, self.bits, self.rest = sizes, bits, rest
        self.ranks = [np.concatenate(([0], np.cumsum(b))) for b in bits]
        self.starts = np.concatenate(([0], np.cumsum([int(r[-1]) for r in self.ranks]))).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, bits, left = [], [], np.unique(keys)
        for level in range(LEVELS):
            if not len(left):
                break
            size = 2 * len(left) + 1
            place = (mixed(left, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            left = left[~alone[place]]
        return cls(sizes, bits, left)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; a key that was not built in gets any slot, or -1."""
        found, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (size, bits) in enumerate(zip(self.sizes, self.bits, strict=True)):
            if not len(left):
                return found
            place = (mixed(keys[left], level) % np.uint64(size)).astype(np.int64)
            here = bits[place]
            found[left[here]] = self.starts[level] + self.ranks[level][place[here]]
            left = left[~here]
        if len(left) and len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[left]), len(self.rest) - 1)
            here = self.rest[at] == keys[left]
            found[left[here]] = self.starts[-1] + at[here]
        return found

    def pack(self) -> tuple[list[int], bytes, bytes]:
        return self.sizes, b"".join(np.packbits(b).tobytes() for b in self.bits), self.rest.tobytes()

    @classmethod
    def unpack(cls, sizes, bits: bytes, rest: bytes) -> PerfectHash:
        fields, at = [], 0
        for size in sizes:
            width = (size + 7) // 8
            fields.append(np.unpackbits(np.frombuffer(bits, np.uint8, width, at))[:size].astype(bool))
            at += width
        return cls(list(sizes), fields, np.frombuffer(rest, np.uint64))


def _slot_key(route: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """What the perfect hash is built over: keys that share the 64 bits differ in the fingerprint."""
    return mixed(route.astype(np.int64).view(np.uint64) ^ (mark.astype(np.int64).view(np.uint64) << np.uint64(32)))


def line_key(line: Column) -> Column:
    return fold_ascii(F.trim(line, F.lit(WHITE)))


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """Each line that may be dropped: order of its document, position, hash and fingerprint."""
    lines = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("_o"),
        F.xxhash64(text_col).alias("_t"),
        F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("_at", "_line"),
    )
    keyed = lines.select("_o", "_t", "_at", line_key(F.col("_line")).alias("_key")).where(F.char_length("_key") >= min_chars)
    return keyed.select("_o", "_t", "_at", F.xxhash64("_key").alias("_h"), F.hash("_key").alias("_f"))


def shared_lines(hashes: DataFrame) -> tuple[DataFrame, int]:
    """Keys that several documents hold, with their lines and first document; the number of all lines."""
    seen = Observation()
    keys = hashes.groupBy("_h", "_f").agg(F.count("*").alias("_n"), F.min("_o").alias("_first"), F.max("_o").alias("_last"))
    keys = keys.observe(seen, F.sum("_n").alias("lines"))
    shared = cut(keys.where(F.col("_first") < F.col("_last")).select("_h", "_f", "_n", "_first"))
    return shared, seen.get["lines"] or 0


def _build(group: pd.DataFrame) -> pd.DataFrame:
    keys = _slot_key(group["_h"].to_numpy(), group["_f"].to_numpy())
    table = PerfectHash.build(keys)
    slots = table.slots(keys)
    marks, counts, first = (np.zeros(len(keys), kind) for kind in (np.int32, np.int64, np.int64))
    marks[slots], counts[slots], first[slots] = group["_f"], group["_n"], group["_first"]
    sizes, bits, rest = table.pack()
    row = (int(group["_shard"].iloc[0]), sizes, bits, rest, marks.tobytes(), counts.tobytes(), first.tobytes())
    return pd.DataFrame([row], columns=["_shard", "_sizes", "_bits", "_rest", "_marks", "_counts", "_firsts"])


INDEX = "_shard int, _sizes array<long>, _bits binary, _rest binary, _marks binary, _counts binary, _firsts binary"


def _probe(index: pd.DataFrame, probes: pd.DataFrame) -> pd.DataFrame:
    columns = ["_o", "_t", "_at"]
    if index.empty or probes.empty:
        return probes[columns].iloc[:0]
    row = index.iloc[0]
    table = PerfectHash.unpack(row["_sizes"], row["_bits"], row["_rest"])
    marks, counts, first = (np.frombuffer(row[c], k) for c, k in (("_marks", np.int32), ("_counts", np.int64), ("_firsts", np.int64)))
    mark = probes["_f"].to_numpy()
    slots = table.slots(_slot_key(probes["_h"].to_numpy(), mark))
    at = np.maximum(slots, 0)
    drop = (slots >= 0) & (marks[at] == mark) & (counts[at] > 1) & (first[at] < probes["_o"].to_numpy())
    return probes.loc[drop, columns]


def dropped_lines(hashes: DataFrame) -> DataFrame:
    """Positions of the lines that go, one row for each document that loses any."""
    shared, lines = shared_lines(hashes)
    shards = min(max(SHARDS[0], 1 << max(0, shared.count() // SHARD_KEYS).bit_length()), SHARDS[1])
    shard = F.pmod(F.xxhash64("_h"), F.lit(shards)).cast("int")
    shared = shared.withColumn("_shard", shard)
    # At most SHARDS[1] rows, whatever the corpus: lines to expect in each shard.
    hot = {r["_shard"]: r["n"] for r in shared.groupBy("_shard").agg(F.sum("_n").alias("n")).collect()}
    parts = [max(1, math.ceil((lines / shards + hot.get(s, 0)) / PROBES)) for s in range(shards)]
    spark, deal = shared.sparkSession, list(enumerate(parts))
    salts = spark.createDataFrame(pa.table([pa.array(c, pa.int32()) for c in zip(*deal, strict=True)], ["_shard", "_parts"]))
    copies = salts.select("_shard", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_salt"))
    index = shared.groupBy("_shard").applyInPandas(_build, INDEX).join(copies, "_shard")
    probes = hashes.withColumn("_shard", shard).join(F.broadcast(salts), "_shard")
    probes = probes.withColumn("_salt", F.pmod(F.xxhash64("_o", "_t", "_at"), F.col("_parts")).cast("int")).drop("_parts")
    pairs = index.groupBy("_shard", "_salt").cogroup(probes.groupBy("_shard", "_salt"))
    gone = pairs.applyInPandas(_probe, "_o long, _t long, _at int")
    return gone.groupBy("_o", "_t").agg(F.collect_set("_at").alias("_gone"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """Keep a line that several documents hold only in the first of them.

    All columns of ``docs`` stay; the text is the kept lines, and ``n_lines``
    (before) and ``n_dropped`` are added (they replace columns of these
    names). A line counts by its key: white space stripped, A-Z lower-cased;
    keys under ``min_chars`` code points stay always. Lines repeated within
    the first document stay. A missing or empty text is one empty line. Rows
    with the same id are one document, and so are all rows without id, which
    come after the others; equal rows lose equal lines. An empty table gives
    an empty table.
    """
    # Lines are split and hashed once: counting and probing both read the written hashes.
    gone = dropped_lines(cut(line_hashes(docs, id_col, text_col, min_chars)))
    order = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST))
    rows = docs.select(packed(docs).alias("_row"), order.alias("_o"), F.xxhash64(f"`{text_col}`").alias("_t"))
    rows = rows.join(gone, ["_o", "_t"], "left")
    text = F.coalesce(F.col("_row").getField(text_col), F.lit(""))
    lines = F.split(text, "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    results = {
        text_col: F.when(F.col("_gone").isNull(), text).otherwise(kept),
        "n_lines": (F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"))) + 1).cast("long"),
        "n_dropped": F.coalesce(F.size("_gone"), F.lit(0)).cast("long"),
    }
    return rows.select(*with_results("_row", docs.columns, results))
