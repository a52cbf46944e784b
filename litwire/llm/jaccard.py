"""N-gram Jaccard join: prefixes, groups of equal prefixes, members verified.

A document is the set of 64-bit hashes of its five-word shingles. Documents
with one set are one class. Shingles have a global order, rare ones first
(counts come from a fixed-size sketch that all documents are counted into;
any fixed order gives the same result). Two sets with a Jaccard index of at
least t share one of the first n - ceil(t n) + 1 shingles of either, so the
prefixes, not the sets, are joined. Classes with equal prefix and size form a
group; groups of like size that share a prefix shingle are candidates.

The result asked for is connected classes, so pairs inside a component that is
already connected are not needed. Each prefix shingle has a leader for
each band of sizes, its smallest group there. Members are first verified against the leader that they share
most with, then against leaders of other components, then for some rounds
against other members; in the end pairs with a prefix shingle in common that
are still in different components are compared exactly. Sizes and bit
signatures rule out pairs before their sets are fetched, and never rule out a
link. So do places in the order: at the first shingle that two linked sets have
in common, enough of either set is still to come, and the smaller one is in the
shorter part of its prefix. A pair is looked at where that holds, not at each
shingle it shares. Copies of a hot text cost a few verifications each, not all
pairs.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litwire.llm.common import as_bytes, mixed
from litwire.llm.components import connect, relabel
from litwire.session import cut, discard

WORDS, SHARE = 5, 80
SKETCH, CHUNK, FAN_IN = 1 << 22, 1 << 14, 16
FILTER_BITS = 1 << 25
MEMBERS = 1000
SIGNATURE, WIDEST, ROUNDS = 16, 1024, 4
CACHE = 150_000
SLICE = 500
FACTOR = np.uint64(0xD6E8FEB86659FD93)


class WordHashes(dict):
    """Hash of each word, computed once; emptied now and then, so its size is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: bytes | None, cache: WordHashes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer words than a shingle are one shingle, none are none."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    values = np.fromiter(map(cache.__getitem__, tokens), np.uint64, len(tokens))
    width = min(words, len(values))
    total = np.full(len(values) - width + 1, width, np.uint64)
    for i in range(width):
        total *= FACTOR
        total += values[i : len(values) - width + 1 + i]
    total = np.sort(mixed(total))
    return total[np.concatenate(([True], total[1:] != total[:-1]))]


def sliced(batches, size: int = SLICE):
    """Batches of at most ``size`` rows, which bounds what a task holds of sets."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def signature(own: np.ndarray) -> np.ndarray:
    """Parities of shingle counts in 64 * SIGNATURE cells: two sets differ in as many shingles as bits, at least.

    Parities, unlike marks, still tell sets apart that are larger than the number of cells.
    """
    cells = np.bincount((own % np.uint64(64 * SIGNATURE)).astype(np.int64), minlength=64 * SIGNATURE)
    return np.packbits((cells & 1).astype(np.uint8)).view(np.int64)


def wide_signature(own: np.ndarray) -> np.ndarray:
    """The same in cells that grow with the set, in words of 64: a power of two of them, none where ``signature`` is as wide.

    Up to 64 * WIDEST cells; larger sets are told apart less well, and never wrongly.
    """
    width = SIGNATURE
    while width < WIDEST and 32 * width < len(own):
        width *= 2
    if width == SIGNATURE:
        return np.empty(0, np.int64)
    cells = np.bincount((own % np.uint64(64 * width)).astype(np.int64), minlength=64 * width)
    return np.packbits((cells & 1).astype(np.uint8)).view(np.int64)


def need(size: int, share: int) -> int:
    """Shingles that a set of this size must have in common with any partner, at least."""
    return -(-size * share // 100)


def sketch_counts(docs: DataFrame, text_col: str, words: int = WORDS) -> np.ndarray:
    """For each of SKETCH cells the binary logarithm of the shingles counted into it: SKETCH bytes."""

    def count(batches):
        cells, cache = np.zeros(SKETCH, np.uint32), WordHashes()
        for batch in sliced(batches):
            sets = [shingle_set(text, cache, words) for text in as_bytes(batch.column(0))]
            met, times = np.unique(np.concatenate(sets) % np.uint64(SKETCH), return_counts=True)
            cells[met.astype(np.int64)] += times.astype(np.uint32)
        packed = [zlib.compress(cells[i : i + CHUNK].tobytes(), 1) for i in range(0, SKETCH, CHUNK) if cells[i : i + CHUNK].any()]
        chunk = [i // CHUNK for i in range(0, SKETCH, CHUNK) if cells[i : i + CHUNK].any()]
        salt = xxhash.xxh3_64_intdigest(cells.tobytes()) % FAN_IN
        yield pa.RecordBatch.from_arrays([pa.array(chunk, pa.int32()), pa.array([salt] * len(chunk), pa.int32()), pa.array(packed, pa.binary())], names=["chunk", "salt", "cells"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(c), np.uint32).astype(np.uint64) for c in group["cells"])
        total = np.minimum(total, 0xFFFFFFFF).astype(np.uint32)
        return pd.DataFrame({"chunk": [group["chunk"].iloc[0]], "cells": [zlib.compress(total.tobytes(), 1)]})

    parts = docs.select(text_col).mapInArrow(count, "chunk int, salt int, cells binary")
    once = parts.groupBy("chunk", "salt").applyInPandas(add, "chunk int, cells binary")
    rows = once.groupBy("chunk").applyInPandas(add, "chunk int, cells binary").collect()  # SKETCH cells in all
    cells = np.zeros(SKETCH, np.uint32)
    for row in rows:
        cells[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(zlib.decompress(row["cells"]), np.uint32)
    # At most 31, so that shingles with their level in front are in one order as signed and as unsigned numbers.
    # By chunks, as doubles for all cells would take the driver eight times the sketch at once, several times over.
    parts = (cells[i : i + CHUNK] for i in range(0, SKETCH, CHUNK))
    return np.concatenate([np.minimum(np.ceil(np.log2(part + np.float64(1))), 31).astype(np.uint8) for part in parts])


def prefixes(docs: DataFrame, id_col: str, text_col: str, words: int = WORDS, share: int = SHARE) -> DataFrame:
    """doc_id, set size, class (hash of the set), group (hash of prefix and size), prefix."""
    spark = docs.sparkSession
    levels = spark.sparkContext.broadcast(sketch_counts(docs, text_col, words))  # SKETCH bytes

    def describe(batches):
        cache = WordHashes()
        for batch in sliced(batches):
            size, kind, group, prefix = [], [], [], []
            for text in as_bytes(batch.column(1)):
                own = shingle_set(text, cache, words)
                size.append(n := len(own))
                kind.append(xxhash.xxh3_64_intdigest(own.tobytes(), seed=n) - (1 << 63) if n else None)
                # Level first, then 58 bits of the hash: equal ones only add a candidate, which is verified.
                level = levels.value[(own % np.uint64(SKETCH)).astype(np.int64)].astype(np.uint64)
                order = np.sort((level << np.uint64(58)) | (own >> np.uint64(6)))
                first = order[: n - need(n, share) + 1].tobytes() if n else b""
                group.append(xxhash.xxh3_64_intdigest(first, seed=n) - (1 << 63) if n else None)
                prefix.append(np.frombuffer(first, np.int64))
            arrays = [batch.column(0), pa.array(size, pa.int64()), pa.array(kind, pa.int64()), pa.array(group, pa.int64()), pa.array(prefix, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "kind", "grp", "prefix"])

    taken = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col)
    return cut(taken.mapInArrow(describe, "doc_id long, n long, kind long, grp long, prefix array<long>"))


def _id_filter(ids: DataFrame) -> bytes:
    """A bit field of fixed size that holds every id of ``ids``."""

    def mark(batches):
        bits = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            bits[_places(batch.column(0))] = True
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(np.packbits(bits).tobytes(), 1)], pa.binary())], names=["bits"])

    total = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in ids.repartition(8).mapInArrow(mark, "bits binary").toLocalIterator():
        total |= np.frombuffer(zlib.decompress(row["bits"]), np.uint8)
    return total.tobytes()


def _places(ids: pa.Array) -> np.ndarray:
    return (mixed(np.asarray(ids.fill_null(0)).view(np.uint64)) % np.uint64(FILTER_BITS)).astype(np.int64)


def class_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """Sets (kind, own) and marks (kind, n, sign, wide) of the classes in ``wanted`` (kind, rep): only their documents are hashed again.

    The sets are written in buckets by class, so that a join with them moves its other side and not all sets.
    """
    bits = docs.sparkSession.sparkContext.broadcast(_id_filter(wanted.select("rep")))

    def hash_again(batches):
        cache, field = WordHashes(), np.frombuffer(bits.value, np.uint8)
        for batch in sliced(batches):
            place = _places(batch.column(0))
            batch = batch.filter(pa.array((field[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1))
            sets = [shingle_set(text, cache, words) for text in as_bytes(batch.column(1))]
            kind = [xxhash.xxh3_64_intdigest(s.tobytes(), seed=len(s)) - (1 << 63) for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kind, pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["rep", "kind", "own"])

    made = docs.select(F.col(id_col).cast("long").alias("rep"), text_col).mapInArrow(hash_again, "rep long, kind long, own binary")
    # Sets shuffle once: by class alone, for the join and for rows with one id and text twice, which are kept once.
    # The ids are compared by difference, as an equality would become a join key.
    named = wanted.select("kind", F.col("rep").alias("_rep"))
    rows = made.join(named, "kind").where(F.col("rep").bitwiseXOR(F.col("_rep")) == 0).dropDuplicates(["kind"])
    sets = cut(rows.select("kind", "own"), buckets="kind")

    def mark(batches):
        for batch in sliced(batches):
            own = [np.frombuffer(value.as_buffer(), np.uint64) for value in batch.column(1)]
            signs = [pa.array([make(s) for s in own], pa.list_(pa.int64())) for make in (signature, wide_signature)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in own], pa.int64()), *signs], names=["kind", "n", "sign", "wide"])

    return sets, cut(sets.mapInArrow(mark, "kind long, n long, sign array<long>, wide array<long>"))


def verify(pairs: DataFrame, sets: DataFrame, marks: DataFrame, share: int = SHARE) -> DataFrame:
    """Those of the class pairs (a, b) that link; sets are fetched only for pairs that sizes and signatures leave open.

    Members of a hot ``a`` are dealt to several tasks. A task reads the set of
    each ``a`` before those of its partners, and holds one ``a`` at a time.
    """
    mark = F.struct("n", "sign", "wide")
    marked = pairs.distinct().join(marks.select(F.col("kind").alias("a"), mark.alias("x")), "a")
    marked = marked.join(marks.select(F.col("kind").alias("b"), mark.alias("y")), "b")
    pairs = cut(marked.where(_may_link("x", "y", share) & _wide_may_link("x", "y", share)).select("a", "b"))
    load = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("parts"))
    left = load.join(sets.select(F.col("kind").alias("a"), "own"), "a")
    left = left.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), F.lit(None).cast("long").alias("b"), "own")
    right = pairs.join(load, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    right = right.join(sets.select(F.col("kind").alias("b"), "own"), "b").select("a", "salt", "b", "own")

    def compare(batches):
        of, base = None, None
        for batch in batches:
            a, b, own = batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)
            linked = []
            for i in range(batch.num_rows):
                if b[i] is None:
                    of, base = a[i], np.frombuffer(own[i].as_py(), np.uint64)
                elif a[i] == of:
                    other = np.frombuffer(own[i].as_buffer(), np.uint64)
                    common = int(np.count_nonzero(base[np.minimum(np.searchsorted(base, other), len(base) - 1)] == other))
                    if 100 * common >= share * (len(base) + len(other) - common):
                        linked.append((of, b[i]))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in linked], pa.int64()) for k in (0, 1)], names=["a", "b"])

    rows = left.union(right).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return rows.mapInArrow(compare, "a long, b long")


def _near(a, b, share: int):
    return (F.lit(100) * F.least(a, b)) >= (F.lit(share) * F.greatest(a, b))


def _band(n, share: int):
    """Bands of sizes: two sizes that may link are in one, or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / (math.log(100 / share) + 1e-9)).cast("long")


def _may_link(a: str, b: str, share: int):
    """Whether sizes and signatures of the structs ``a`` and ``b`` (n, sign) leave a link possible; never false for one."""
    apart = sum((F.bit_count(F.get(f"{a}.sign", F.lit(i)).bitwiseXOR(F.get(f"{b}.sign", F.lit(i)))) for i in range(SIGNATURE)), F.lit(0))
    sizes = F.col(f"{a}.n") + F.col(f"{b}.n")
    return _near(F.col(f"{a}.n"), F.col(f"{b}.n"), share) & (apart * (100 + share) <= sizes * (100 - share))


def _wide_may_link(a: str, b: str, share: int):
    """The same by wide signatures. One twice as wide as the other is folded; others that differ in width decide nothing."""
    wide = F.greatest(F.size(f"{a}.wide"), F.size(f"{b}.wide"))
    least = F.least(F.size(f"{a}.wide"), F.size(f"{b}.wide"))

    def folded(side: str, i):
        other = F.when(F.size(f"{side}.wide") > least, F.get(f"{side}.wide", i + least)).otherwise(F.lit(0).cast("long"))
        return F.get(f"{side}.wide", i).bitwiseXOR(other)

    apart = F.aggregate(F.sequence(F.lit(0), least - 1), F.lit(0), lambda sum_, i: sum_ + F.bit_count(folded(a, i).bitwiseXOR(folded(b, i))))
    sizes = F.col(f"{a}.n") + F.col(f"{b}.n")
    return F.when((least == 0) | (wide > 2 * least), F.lit(True)).otherwise(apart * (100 + share) <= sizes * (100 - share))


def _early(n, place, share: int):
    """Whether the smaller of two linked sets may have their first common shingle at this place (from 0)."""
    return place * (100 + share) <= n * (100 - share)


def _enough_left(a: str, b: str, share: int):
    """Whether the structs' sets may link if the shingle at their ``place`` is the first in common; never false for a link there."""
    left = F.least(F.col(f"{a}.n") - F.col(f"{a}.place"), F.col(f"{b}.n") - F.col(f"{b}.place"))
    return left * (100 + share) >= (F.col(f"{a}.n") + F.col(f"{b}.n")) * share


def _expand(pairs: DataFrame, members: DataFrame, heads: DataFrame) -> DataFrame:
    """Class pairs (head of the leading group, member) of group pairs (lead, grp)."""
    led = pairs.select("grp", "lead").join(heads.withColumnsRenamed({"grp": "lead", "head": "a"}), "lead")
    return led.join(members.select("grp", F.col("kind").alias("b")), "grp").select("a", "b")


def met_shingles(described: DataFrame, share: int = SHARE) -> DataFrame:
    """grp, n, place, t: prefix shingles that more than one group has, early in one of them.

    All prefixes shuffle once, by shingle alone; few shingles are left to be looked at by sizes.
    """
    posts = described.where("n > 0 and doc_id is not null").select("grp", "n", F.posexplode("prefix").alias("place", "t")).repartition("t")
    early = F.max(_early(F.col("n"), F.col("place"), share)).alias("early")
    met = posts.groupBy("t").agg(F.min("grp").alias("lead"), F.max("grp").alias("last"), early).where("lead < last and early")
    # ``met`` has a shingle once. A semi join would go below the shuffle, and a second one be needed.
    return cut(posts.join(met.select("t"), "t").select("grp", "n", "place", "t"))


def linked_classes(docs: DataFrame, described: DataFrame, met: DataFrame, id_col: str, text_col: str, words: int = WORDS, share: int = SHARE) -> DataFrame:
    """kind, comp: components of the classes that link with any other class, by the shingles in ``met``."""
    classes = described.where("n > 0 and doc_id is not null")
    # Equal prefix and size: one group, led by its smallest class.
    posts = met.select("grp", "n", _band(F.col("n"), share).alias("band"), "place", "t")
    # Sizes that may link are in one band or in neighbouring ones. So each group counts in the cell of its band and in the next;
    # whoever shares no cell of a shingle with another group has no partner by it. The size of the leader decides nothing here.
    # Nor has a shingle a pair to show that comes late in all its groups.
    cells = posts.select("t", "grp", _early(F.col("n"), F.col("place"), share).alias("early"), F.explode(F.array("band", F.col("band") + 1)).alias("cell"))
    cells = cells.groupBy("t", "cell").agg(F.min("grp").alias("lead"), F.max("grp").alias("last"), F.max("early").alias("early")).where("lead < last and early")
    shared = cells.select("t", "lead", F.explode(F.array("cell", F.col("cell") - 1)).alias("band")).groupBy("t", "band").agg(F.min("lead").alias("lead"))
    posts = cut(posts.join(shared, ["t", "band"]).select("t", "lead", "grp", "n", "place").distinct())
    discard(met)

    sizes = posts.select("grp", "n").distinct()
    pairs = posts.where("grp <> lead").groupBy("grp", "lead").agg(F.count("*").alias("votes"), F.first("n").alias("n"))
    pairs = pairs.join(sizes.select(F.col("grp").alias("lead"), F.col("n").alias("m")), "lead").where(_near(F.col("n"), F.col("m"), share))
    pairs = cut(pairs.select("grp", "lead", "votes"))

    members = classes.groupBy("kind", "grp").agg(F.min("doc_id").alias("rep"))
    inner = members.groupBy("grp").agg(F.min("kind").alias("head"), F.max("kind").alias("last")).where("head < last").select("grp", "head")
    active = posts.select("grp").union(inner.select("grp")).distinct()
    members = cut(members.join(active, "grp"))
    sets, marks = class_sets(docs, members, id_col, text_col, words)
    heads = members.groupBy("grp").agg(F.min("kind").alias("head"))

    # Expand groups: every member meets the head of its own and of the leading group.
    best = pairs.groupBy("grp").agg(F.max_by("lead", F.struct("votes", "lead")).alias("lead"))
    own = members.join(heads, "grp").where("kind <> head").select(F.col("head").alias("a"), F.col("kind").alias("b"))
    comps = connect(verify(own.union(_expand(best, members, heads)), sets, marks, share))

    rest = relabel(relabel(_expand(pairs, members, heads), comps, "a"), comps, "b").where("a_comp <> b_comp").select("a", "b")
    comps = connect(verify(rest, sets, marks, share), comps)

    # What may still link: pairs of members with a prefix shingle in common, in different components.
    known = marks.select("kind", F.struct("n", "sign").alias("x"))
    rows = posts.select("t", "grp", "place").join(members.select("grp", "kind"), "grp").select("t", "kind", "place")
    # Shingles with the same members say the same: the first of them stays.
    lists = rows.groupBy("t").agg(F.count("*").alias("c"), *[F.bit_xor(F.xxhash64("kind", F.lit(i))).alias(f"h{i}") for i in (1, 2)])
    once = lists.where("c > 1").groupBy("c", "h1", "h2").agg(F.min("t").alias("t"))
    rows = cut(rows.join(once.select("t"), "t"))

    def in_question() -> DataFrame:
        """Members (t, kind, comp, x) of shingles whose members are in several components."""
        placed = relabel(rows, comps, "kind").select("t", "kind", "place", F.col("kind_comp").alias("comp"))
        apart = placed.groupBy("t").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("t")
        met = placed.join(apart, "t").join(known, "kind")
        return cut(met.select("t", "kind", "comp", F.struct("x.n", "x.sign", "place").alias("x")))

    # First, members meet one of theirs, another in each round: that joins what is well linked without all pairs.
    # Rounds go on while they settle a tenth of what is open; what they leave is compared exactly below.
    live, open_rows = in_question(), None
    for turn in range(ROUNDS):
        before, open_rows = open_rows, live.count()
        if not open_rows or (before and 10 * open_rows > 9 * before):
            break
        lead = live.groupBy("t").agg(F.min(F.struct(F.xxhash64("kind", F.lit(turn)).alias("h"), "kind", "comp")).alias("l")).select("t", F.col("l.kind").alias("a"), F.col("l.comp").alias("ca"))
        lead = lead.join(known.select(F.col("kind").alias("a"), F.col("x").alias("y")), "a")
        met = live.join(lead, "t").where((F.col("comp") != F.col("ca")) & _may_link("x", "y", share)).select("a", F.col("kind").alias("b"))
        comps = connect(verify(met, sets, marks, share), comps)
        discard(live)
        live = in_question()
    sizes_in = live.groupBy("t", "comp").agg(F.count("*").alias("m"))
    main = sizes_in.groupBy("t").agg(F.max(F.struct("m", "comp")).alias("l")).select("t", F.col("l.comp").alias("main"))
    placed = live.join(main, "t")
    minor = placed.where("comp <> main").select("t", F.col("kind").alias("a"), F.col("comp").alias("ca"), F.col("x").alias("xa"))
    other = placed.select("t", F.col("kind").alias("b"), F.col("comp").alias("cb"), F.col("x").alias("xb"), "main")
    found = minor.join(other, "t").where((F.col("ca") != F.col("cb")) & ((F.col("cb") == F.col("main")) | (F.col("a") < F.col("b"))) & _enough_left("xa", "xb", share) & _may_link("xa", "xb", share))
    # The same within a group: members that its head did not link, against all other members.
    inside = relabel(relabel(own, comps, "a"), comps, "b")
    loose = inside.where("a_comp <> b_comp").select("a", F.col("b").alias("one"), F.col("b_comp").alias("one_comp"))
    twins = loose.join(inside, "a").where((F.col("one_comp") != F.col("b_comp")) & ((F.col("b_comp") == F.col("a_comp")) | (F.col("one") < F.col("b"))))
    twins = twins.select(F.col("one").alias("a"), "b")
    comps = connect(verify(found.select("a", "b").union(twins), sets, marks, share), comps)
    discard(posts, pairs, members, sets, marks, rows, live)
    return comps


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, share: int = SHARE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, class_id, component_id.

    Documents link when 100 * common shingles >= ``share`` * all shingles of
    the two. ``class_id`` is the smallest id with the same set, and
    ``component_id`` the smallest id that links lead to. Missing, empty and
    wordless texts have no shingles and stand alone. Repeated rows are rows of
    one class. Rows without id stand alone and have a null component. Other
    columns are left aside. An empty table gives an empty table. Sets are
    compared by 64-bit hashes.
    """
    whole = prefixes(docs, id_col, text_col, words, share)
    met = met_shingles(whole, share)
    # Prefixes, the larger part of the copy, are of no more use.
    described = cut(whole.drop("prefix"))
    discard(whole)
    comps = linked_classes(docs, described, met, id_col, text_col, words, share)
    linkable = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    classes = described.where(linkable).groupBy("kind").agg(F.min("doc_id").alias("class_id"))
    named = classes.join(comps.withColumnRenamed("node", "kind"), "kind", "left")
    named = named.withColumn("comp", F.coalesce("comp", "kind"))
    least = named.groupBy("comp").agg(F.min("class_id").alias("component_id"))
    named = cut(named.join(least, "comp").select("kind", "class_id", "component_id"))
    rows = described.where(linkable).select("doc_id", "n", "kind").join(named, "kind")
    rows = rows.select("doc_id", F.col("n").alias("n_shingles"), "class_id", "component_id")
    alone = described.where(~linkable).select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"))
    return rows.union(alone)


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, share: int = SHARE) -> DataFrame:
    """``docs`` without the documents that link to one with a smaller id; of repeated rows, one stays.

    Rows without id, and rows without words, all stay.
    """
    found = jaccard_components(docs, id_col, text_col, words, share)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    rows = docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
    kept = rows.where(F.col(f"`{id_col}`").isNotNull()).dropDuplicates([id_col, text_col])
    return kept.unionByName(rows.where(F.col(f"`{id_col}`").isNull()))
