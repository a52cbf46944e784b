"""Importance resampling towards a target's n-grams, over deduplicated lines.

No word holds a line feed, so every n-gram lies in one line or crosses lines.
The buckets of n-grams inside a line are computed once for each distinct line:
corpus counts are these times the line's occurrences, and a document's weight
is the sum over its lines. N-grams that cross lines are found document by
document, from the words next to line ends, and added. Only bucket counts, a
fixed number of them, reach the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litwire.llm.common import LAST
from litwire.operators.ranking import global_rank
from litwire.session import cut

BUCKETS = 10_000
LEAST_WORDS = 20
#: Bytes that one numpy step takes (at least one text).
STEP = 1 << 22
#: Words up to this length are hashed column by column, longer ones singly.
SHORT = 64
ONES = np.uint32(0xFFFFFFFF)

#: Bytes of words (0-9, a-z and all beyond ASCII), after A-Z is lower-cased.
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
IN_WORD = np.zeros(256, bool)
IN_WORD[48:58] = IN_WORD[97:123] = IN_WORD[128:] = True


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> 1), table >> 1)
    return table


CRC = _crc_table()


def _passed(state: np.ndarray, byte) -> np.ndarray:
    return CRC[(state ^ byte) & 255] ^ (state >> 8)


def _shift_tables() -> np.ndarray:
    """What a state becomes after 0..SHORT zero bytes, by each of its four bytes: CRC-32 is linear."""
    state = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    tables = [state]
    for _ in range(SHORT):
        tables.append(_passed(tables[-1], np.uint32(0)))
    return np.stack(tables)


SHIFT = _shift_tables()


def _after(state: np.ndarray, raw: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The state after a word of ``length`` bytes whose own CRC from state 0 is ``raw``."""
    length, state = length.copy(), state.copy()
    while True:
        n = np.minimum(length, SHORT)
        state = SHIFT[n, 0, state & 255] ^ SHIFT[n, 1, (state >> 8) & 255] ^ SHIFT[n, 2, (state >> 16) & 255] ^ SHIFT[n, 3, state >> 24]
        length -= n
        if not length.any():
            return state ^ raw


def word_hashes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 from state 0, without final inversion, of each word."""
    raw = np.zeros(len(start), np.uint32)
    order = np.argsort(np.minimum(length, SHORT + 1).astype(np.uint8), kind="stable")[::-1]
    sizes = length[order]
    longer = int(np.searchsorted(-sizes, -SHORT, "left"))
    for i in order[:longer]:
        raw[i] = zlib.crc32(data[start[i] : start[i] + length[i]], 0xFFFFFFFF) ^ 0xFFFFFFFF
    order, sizes = order[longer:], sizes[longer:]
    at, state = start[order], np.zeros(len(order), np.uint32)
    for j in range(int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -j, "left"))  # words longer than j come first
        state[:n] = _passed(state[:n], data[at[:n] + j])
    raw[order] = state
    return raw


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of each word of the lower-cased ``data``, and the text (by ``offsets``) that it is in."""
    inside = IN_WORD[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(data))]
    first[borders] = inside[borders]
    last[borders - 1] = inside[borders - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1 - start, np.searchsorted(offsets, start, "right") - 1


def gram_buckets(data: np.ndarray, start: np.ndarray, length: np.ndarray, wanted: list[np.ndarray], buckets: int) -> np.ndarray:
    """Bucket of the runs of 1, 2 and 3 words from each word on; right where ``wanted`` says so."""
    found = np.zeros((len(start), 3), np.uint16)
    used = np.zeros(len(start), bool)
    for n, mask in enumerate(wanted):
        for k in range(n + 1):
            used[k:] |= mask[: len(mask) - k]
    raw = np.zeros(len(start), np.uint32)
    raw[used] = word_hashes(data, start[used], length[used])
    for n, mask in enumerate(wanted):
        at = np.flatnonzero(mask)
        state = np.full(len(at), ONES)
        for k in range(n + 1):
            state = _passed(state, np.uint32(32)) if k else state
            state = _after(state, raw[at + k], length[at + k])
        found[at, n] = (state ^ ONES) % np.uint32(buckets)
    return found


def _follows(group: np.ndarray) -> list[np.ndarray]:
    """Per run length: whether a run from each word stays in the word's group."""
    two, three = np.zeros(len(group), bool), np.zeros(len(group), bool)
    two[:-1] = group[1:] == group[:-1]
    three[:-2] = group[2:] == group[:-2]
    return [np.ones(len(group), bool), two, three]


def _texts(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number of texts, their lower-cased bytes and offsets, in steps of bounded size."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + STEP, "right")) - 1)
        yield to - at, LOWERED[data[offsets[at] : offsets[to]]], offsets[at : to + 1] - offsets[at]
        at = to


def _packed(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    """Buckets per text (number, values) as a binary column of 16-bit numbers."""
    counts = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
    values = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.uint16)
    offsets = np.concatenate(([0], 2 * np.cumsum(counts)))
    whole = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(values.tobytes())])
    return whole.cast(pa.binary())


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets into, and values of, a column of 16-bit numbers."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    values = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(np.uint16) if data and len(column) else np.zeros(0, np.uint16)
    return (offsets - offsets[0]) // 2, values


def _with_columns(batch: pa.RecordBatch, keep: int, added: list[tuple[str, pa.Array]]) -> pa.RecordBatch:
    names = [*batch.schema.names[:keep], *[n for n, _ in added]]
    return pa.RecordBatch.from_arrays([*batch.columns[:keep], *[a for _, a in added]], names=names)


def _schema(df: DataFrame, columns: list[str], more: str) -> str:
    return ", ".join([f"{c} {df.schema[c].dataType.simpleString()}" for c in columns] + [more])


def line_grams(lines: DataFrame, buckets: int) -> DataFrame:
    """``lines`` with ``grams`` in place of its last column, the text: buckets of the n-grams inside it."""

    def run(batches):
        for batch in batches:
            parts = []
            for n, data, offsets in _texts(batch.column(batch.num_columns - 1)):
                start, length, row = words_of(data, offsets)
                wanted = _follows(row)
                found = gram_buckets(data, start, length, wanted, buckets)
                mask = np.stack(wanted, 1)
                parts.append((np.bincount(row, mask.sum(1), n).astype(np.int64), found[mask]))
            yield _with_columns(batch, batch.num_columns - 1, [("grams", _packed(parts))])

    keep = lines.columns[:-1]
    return lines.mapInArrow(run, _schema(lines, keep, "grams binary"))


def crossing_grams(texts: DataFrame, buckets: int) -> DataFrame:
    """``texts`` with ``n_words`` and ``grams`` in place of its last column: buckets of the n-grams that cross lines."""

    def run(batches):
        for batch in batches:
            words, parts = [], []
            for n, data, offsets in _texts(batch.column(batch.num_columns - 1)):
                start, length, row = words_of(data, offsets)
                line = np.searchsorted(np.flatnonzero(data == 10), start)
                _, two, three = _follows(row)
                in_text, in_line = [np.zeros(len(row), bool), two, three], _follows(line)
                wanted = [own & ~inner for own, inner in zip(in_text, in_line, strict=True)]
                found = gram_buckets(data, start, length, wanted, buckets)
                mask = np.stack(wanted, 1)
                words.append(np.bincount(row, minlength=n))
                parts.append((np.bincount(row, mask.sum(1), n).astype(np.int64), found[mask]))
            n_words = pa.array(np.concatenate(words) if words else [], pa.int64())
            yield _with_columns(batch, batch.num_columns - 1, [("n_words", n_words), ("grams", _packed(parts))])

    keep = texts.columns[:-1]
    return texts.mapInArrow(run, _schema(texts, keep, "n_words long, grams binary"))


def summed_buckets(rows: DataFrame, buckets: int) -> DataFrame:
    """bucket, n: how often each bucket occurs in ``rows`` (occurrences, grams)."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            offsets, values = _unpacked(batch.column(1))
            times = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), np.diff(offsets))
            total += np.bincount(values, times, buckets).astype(np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    return rows.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def summed_gains(rows: DataFrame, gains: np.ndarray) -> DataFrame:
    """``rows`` with ``weight`` in place of its last column, the grams: the sum of their gains."""

    def run(batches):
        for batch in batches:
            offsets, values = _unpacked(batch.column(batch.num_columns - 1))
            sums = np.concatenate(([0], np.cumsum(gains[values])))
            yield _with_columns(batch, batch.num_columns - 1, [("weight", pa.array(sums[offsets[1:]] - sums[offsets[:-1]], pa.int64()))])

    keep = rows.columns[:-1]
    return rows.mapInArrow(run, _schema(rows, keep, "weight long"))


def _mark(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """o, t (what a document is known by) and every line of it that can hold a word."""
    order = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST))
    rows = docs.select(order.alias("o"), _mark(F.col(f"`{text_col}`")).alias("t"), F.explode(F.split(F.col(f"`{text_col}`"), "\n", -1)).alias("line"))
    return rows.where(F.col("line") != "")


def _counted(docs: DataFrame, id_col: str, text_col: str, buckets: int) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """Distinct lines and documents with their grams (written), and the counts of all buckets."""
    lines = _lines(docs, id_col, text_col).groupBy("line").agg(F.count("*").alias("times"))
    lines = lines.select(F.xxhash64("line").alias("h"), F.hash("line").alias("f"), "times", "line")
    lines = cut(line_grams(lines, buckets))
    order = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    crossing = cut(crossing_grams(docs.select(F.col(f"`{id_col}`").alias("doc_id"), order.alias("o"), _mark(text).alias("t"), text.alias("text")), buckets))
    once = F.lit(1).cast("long").alias("times")
    counts = np.zeros(buckets, np.int64)
    for row in summed_buckets(lines.select("times", "grams").union(crossing.select(once, "grams")), buckets).collect():  # at most ``buckets`` rows
        counts[row["bucket"]] = row["n"]
    return lines, crossing, counts


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log of the smoothed share in the target over that in the corpus) of each bucket."""
    k = len(raw)
    top = (target + 1.0) * (float(raw.sum()) + k)
    return np.floor(1000.0 * np.log(top / ((raw + 1.0) * (float(target.sum()) + k)))).astype(np.int64)


def importance_draw(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 5,
    least_words: int = LEAST_WORDS,
    seed: int = 42,
    buckets: int = BUCKETS,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs``; undrawn rows have no rank.

    ``percent`` of the documents with ``least_words`` words are drawn without
    replacement, with odds by their weight (Gumbel noise from the id is added,
    and the highest scores are drawn; ties go to the smaller id, and missing
    ids, whose noise is that of an empty id, come last). A missing text is
    empty: no features, weight 0. Repeated rows are documents of their own and
    get equal scores. Other columns of ``docs`` are left aside; an empty
    target has no features; empty documents give an empty table.
    """
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets are kept as 16-bit numbers")
    lines, documents, raw = _counted(docs, id_col, text_col, buckets)
    wanted = target.select(F.lit(None).cast("long").alias("id"), F.col(f"`{target_col}`").alias("text"))
    gains = bucket_gains(raw, _counted(wanted, "id", "text", buckets)[2])
    line_weights = summed_gains(lines.select("h", "f", "grams"), gains)
    own = summed_gains(documents.select("doc_id", "o", "t", "n_words", "grams"), gains)
    hashed = _lines(docs, id_col, text_col).select("o", "t", F.xxhash64("line").alias("h"), F.hash("line").alias("f"))
    inner = hashed.join(line_weights, ["h", "f"]).groupBy("o", "t").agg(F.sum("weight").alias("inner"))
    # Rows with the same id and text had their lines added up together: equal shares.
    shares = documents.groupBy("o", "t").agg(F.count("*").alias("rows")).join(inner, ["o", "t"], "left")
    shares = shares.select("o", "t", F.expr("coalesce(inner, 0L) div rows").alias("inner"))
    n = F.col("n_words")
    features = F.when(n < 2, n).otherwise(3 * n - 3)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(-1000.0 * F.ln(-F.ln(uniform))).cast("long")
    rows = own.join(shares, ["o", "t"])
    weight = F.col("weight") + F.col("inner")
    rows = rows.select("doc_id", "o", "t", "n_words", features.alias("n_features"), weight.alias("weight"), (weight + noise).alias("score"))
    rows = cut(rows)
    eligible = n >= least_words
    drawn = rows.where(eligible).count() * percent // 100
    ranked = global_rank(rows.where(eligible).drop("n_words"), [F.desc("score"), F.col("o"), F.col("t")])
    results = ["doc_id", "n_features", "weight", "score"]
    ranked = ranked.select(*results, F.when(F.col("ord") <= drawn, F.col("ord")).alias("rank"))
    return ranked.union(rows.where(~eligible).select(*results, F.lit(None).cast("long").alias("rank")))


def drawn_documents(docs: DataFrame, draw: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose ids were drawn."""
    drawn = draw.where(F.col("rank").isNotNull()).select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(drawn, id_col, "left_semi")
