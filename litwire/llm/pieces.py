"""SentencePiece encoding and decoding over a relational lattice.

A text is a sequence of units: a run of blank marks and what follows up to the
next one. No piece has a blank mark after another character, so units are
encoded one by one; where two neighbouring characters stand next to each other
in no piece, a unit can be cut further. Both cuts are checked against the model.

Units that are frequent in the corpus are encoded once, in Spark: substrings
up to the longest piece are exploded and equi-joined to the piece table, the
edges found are grouped by unit, and a higher-order aggregate folds each group
into its best path: Viterbi for unigram models. Merge models (BPE) define
their encoding by merges in order of rank, which no best path over scores
gives, so their fold takes the lattice's edges as merges. All other units are
encoded where they stand, by the same recurrences over the same edges.
"""

from __future__ import annotations

import heapq
import struct
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litwire.llm.common import as_bytes, free_name
from litwire.session import cut

BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2
#: Units encoded in Spark, at most, and their longest; the others are encoded where they stand.
FREQUENT_UNITS, UNIT_CHARS = 50_000, 24
MOST_PIECES = 2_000_000
#: Units that a task counts before it hands them on; units, and parts of units, whose ids it holds; rows that it works on at a time.
COUNTED, HELD, SLICE = 300_000, 100_000, 500
PENALTY = 10.0
SHORT = 48


def _fields(data: bytes):
    """(field number, value) of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = number() if kind == 2 else 8 if kind == 1 else 4
        yield key >> 3, data[at : at + size]
        at += size


@dataclass
class Model:
    """Pieces with scores and kinds, and how texts become pieces."""

    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    algorithm: int = UNIGRAM
    dummy_prefix: bool = True
    ids: dict[str, int] = field(default_factory=dict)
    byte_ids: dict[int, int] = field(default_factory=dict)
    unknown: int = 0

    def __post_init__(self):
        for i, (piece, kind) in enumerate(zip(self.pieces, self.kinds, strict=True)):
            if kind in (NORMAL, USER):
                self.ids[piece] = i
            elif kind == BYTE:
                self.byte_ids[int(piece[3:5], 16)] = i
            elif kind == UNKNOWN:
                self.unknown = i
        self.rank = {piece: self.scores[i] for piece, i in self.ids.items()}
        self.parts: dict[str, list[int]] = {}
        self.longest = max(map(len, self.ids), default=1)
        self.neighbours = {pair for piece in self.ids for pair in zip(piece, piece[1:], strict=False)}
        self.floor = min((self.scores[i] for i in self.ids.values()), default=0.0) - PENALTY
        if any(b == BLANK != a for a, b in self.neighbours):
            raise ValueError("pieces that go on after a blank are not supported")

    @classmethod
    def load(cls, path: str) -> Model:
        """A SentencePiece model file with identity normalisation."""
        with open(path, "rb") as file:
            data = file.read()
        pieces, scores, kinds, algorithm, prefix = [], [], [], UNIGRAM, True
        for number, value in _fields(data):
            if number == 1:
                entry = dict(_fields(value))
                pieces.append(entry.get(1, b"").decode())
                scores.append(struct.unpack("<f", entry[2])[0] if 2 in entry else 0.0)
                kinds.append(entry.get(3, NORMAL))
            elif number == 2:
                algorithm = dict(_fields(value)).get(3, UNIGRAM)
            elif number == 3:
                entry = dict(_fields(value))
                prefix = bool(entry.get(3, 1))
                if entry.get(1, b"identity") != b"identity" or entry.get(4, 1):
                    raise ValueError("only models that keep texts as they are can be used")
        if algorithm not in (UNIGRAM, BPE):
            raise ValueError(f"model type {algorithm} is not supported")
        if len(pieces) > MOST_PIECES:
            raise ValueError(f"more than {MOST_PIECES} pieces")
        return cls(pieces, scores, kinds, algorithm, prefix)

    def fallback(self, char: str) -> list[int]:
        """Ids of a character that is no piece: its bytes, or the unknown piece."""
        raw = char.encode()
        return [self.byte_ids[b] for b in raw] if all(b in self.byte_ids for b in raw) else [self.unknown]

    def encode_unit(self, unit: str) -> list[int]:
        out, start = [], 0
        for i in range(1, len(unit) + 1):
            if i == len(unit) or (unit[i - 1], unit[i]) not in self.neighbours:
                part = unit[start:i]
                ids = self.parts.get(part)
                if ids is None:
                    ids = self.merge(part) if self.algorithm == BPE else self.viterbi(part)
                    if len(self.parts) >= HELD:
                        self.parts.clear()
                    if len(part) <= 4 * UNIT_CHARS:
                        self.parts[part] = ids
                out += ids
                start = i
        return out

    def viterbi(self, part: str) -> list[int]:
        """The best path; of equal ones, the one whose last edge starts first."""
        best: list[tuple[float, int, list[int]]] = [(0.0, 0, [])]
        for end in range(1, len(part) + 1):
            top = None
            for start in range(max(0, end - self.longest), end):
                i = self.ids.get(part[start:end])
                if i is not None:
                    score, ids = best[start][0] + self.scores[i], [i]
                elif end - start == 1:
                    score, ids = best[start][0] + self.floor, self.fallback(part[start])
                else:
                    continue
                if top is None or score > top[0]:
                    top = (score, start, ids)
            best.append(top)
        out, end = [], len(part)
        while end:
            _, start, ids = best[end]
            out.append(ids)
            end = start
        return [i for ids in reversed(out) for i in ids]

    def merge(self, part: str) -> list[int]:
        """Merges by score, of equal ones the leftmost first."""
        if part in self.ids and len(part) == 1:
            return [self.ids[part]]
        symbols = self._merge_short(part) if len(part) <= SHORT else self._merge_long(part)
        return [i for s in symbols for i in ([self.ids[s]] if s in self.ids else self.fallback(s))]

    def _merge_short(self, part: str) -> list[str]:
        symbols, rank, never = list(part), self.rank, -np.inf
        worth = [rank.get(a + b, never) for a, b in zip(symbols, symbols[1:], strict=False)]
        while worth:
            top = max(worth)
            if top == never:
                break
            i = worth.index(top)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del worth[i]
            if i:
                worth[i - 1] = rank.get(symbols[i - 1] + symbols[i], never)
            if i < len(worth):
                worth[i] = rank.get(symbols[i] + symbols[i + 1], never)
        return symbols

    def _merge_long(self, part: str) -> list[str]:
        symbols: list[str | None] = list(part)
        after, before = [*range(1, len(part)), -1], list(range(-1, len(part) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0:
                both = symbols[i] + symbols[after[i]]
                if both in self.ids:
                    heapq.heappush(heap, (-self.scores[self.ids[both]], i, both))

        for i in range(len(part) - 1):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i]
            if symbols[i] is None or j < 0 or symbols[i] + symbols[j] != both:
                continue
            symbols[i], symbols[j], after[i] = both, None, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [s for s in symbols if s is not None]


class Merges:
    """Merges of many short units at once: in each round every unit makes its best merge, the leftmost of equal ones."""

    def __init__(self, model: Model):
        symbols = {c for piece in model.ids for c in piece} - set(model.ids)
        number = dict(model.ids)
        number.update({c: len(model.pieces) + i for i, c in enumerate(sorted(symbols))})
        self.base = len(model.pieces) + len(symbols)
        self.pieces = len(model.pieces)
        self.of_char = np.full(0x110000, -1, np.int64)
        for piece, i in number.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = i
        pairs = {}
        for piece, i in model.ids.items():
            for at in range(1, len(piece)):
                a, b = number.get(piece[:at]), number.get(piece[at:])
                if a is not None and b is not None:
                    pairs[a * self.base + b] = i
        # The last entry stands for pairs that are no piece.
        self.keys = np.array([*sorted(pairs), 1 << 62], np.int64)
        self.merged = np.array([*[pairs[k] for k in sorted(pairs)], 0], np.int64)
        self.worth = np.array([*[model.scores[i] for i in self.merged[:-1]], -np.inf])
        self.worth[-1] = -np.inf

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The entry of each pair of symbols."""
        wanted = left * self.base + right
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, at, len(self.keys) - 1)

    def encode(self, units: list[str]) -> dict[str, bytes]:
        """Ids (32-bit little-endian) of distinct units; those with characters that are no pieces are left out."""
        code = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbol = self.of_char[code]
        unit = np.repeat(np.arange(len(units)), [len(u) for u in units])
        known = np.ones(len(units), bool)
        known[unit[(symbol < 0) | (symbol >= self.pieces)]] = False
        symbol, unit = symbol[known[unit]], unit[known[unit]]
        none = len(self.keys) - 1
        entry = np.full(len(symbol), none)
        inner = np.flatnonzero(unit[1:] == unit[:-1])
        entry[inner] = self.pair(symbol[inner], symbol[inner + 1])
        done = []
        while len(symbol):
            starts = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1])))
            sizes = np.diff(np.append(starts, len(unit)))
            worth = self.worth[entry]
            top = np.maximum.reduceat(worth, starts)
            open_ = np.repeat(top > -np.inf, sizes)
            done.append((unit[~open_], symbol[~open_]))
            best = np.flatnonzero(open_ & (worth == np.repeat(top, sizes)))
            best = best[np.concatenate(([True], unit[best][1:] != unit[best][:-1]))] if len(best) else best
            symbol[best] = self.merged[entry[best]]
            open_[best + 1] = False
            place = np.cumsum(open_)[best] - 1
            symbol, unit, entry = symbol[open_], unit[open_], entry[open_]
            changed = np.concatenate((place, place[place > 0] - 1))
            entry[changed] = none
            changed = changed[changed + 1 < len(unit)]
            changed = changed[unit[changed] == unit[changed + 1]]
            entry[changed] = self.pair(symbol[changed], symbol[changed + 1])
        if not done:
            return {}
        owner, symbol = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(owner, kind="stable")
        ids = symbol[order].astype("<i4").tobytes()
        ends = np.cumsum(np.bincount(owner, minlength=len(units))) * 4
        begins = np.concatenate(([0], ends[:-1]))
        return {u: ids[a:b] for u, a, b, k in zip(units, begins.tolist(), ends.tolist(), known.tolist(), strict=True) if k}


def lines_of_units(text: str, prefix: bool) -> list[list[str]]:
    """Units of each line; the line breaks between them stand by themselves."""
    marked = text.replace(" ", BLANK)
    if prefix and text:
        marked = BLANK + marked
    lines = []
    for line in marked.split("\n"):
        parts = line.split(BLANK)
        if "" in parts[1:]:  # two blanks in a row, or one at the end
            units, run = ([parts[0]] if parts[0] else []), 1
            for part in parts[1:]:
                if part:
                    units.append(BLANK * run + part)
                    run = 1
                else:
                    run += 1
            if run > 1:
                units.append(BLANK * (run - 1))
        else:
            units = ([parts[0]] if parts[0] else []) + [BLANK + p for p in parts[1:]]
        lines.append(units)
    return lines


def piece_table(spark: SparkSession, model: Model) -> DataFrame:
    """piece, id, score of the pieces that texts can be made of; the size of the vocabulary bounds it."""
    rows = [(p, i, float(model.scores[i])) for p, i in model.ids.items()]
    return spark.createDataFrame(rows, "piece string, id int, score double")


def lattice(units: DataFrame, table: DataFrame, model: Model) -> DataFrame:
    """unit, edges: array<struct<start, end, score, ids>> of each unit (column ``unit``, distinct)."""
    n = F.char_length("unit")
    starts = units.select("unit", n.alias("n"), F.explode(F.sequence(F.lit(0), n - 1)).alias("start"))
    ends = starts.select("unit", "start", F.explode(F.sequence(F.col("start") + 1, F.least(F.col("n"), F.col("start") + model.longest))).alias("end"))
    parts = ends.withColumn("piece", F.substring("unit", F.col("start") + 1, F.col("end") - F.col("start")))
    found = parts.join(F.broadcast(table), "piece", "left").where("id is not null or end - start = 1")
    # A character that is no piece becomes its bytes, if the model has byte pieces.
    raw = F.hex(F.encode("piece", "UTF-8"))
    codes = F.transform(F.sequence(F.lit(0), (F.char_length(raw) / 2 - 1).cast("int")), lambda i: F.conv(F.substring(raw, (2 * i + 1).cast("int"), F.lit(2)), 16, 10).cast("int"))
    first = model.byte_ids.get(0, 0)
    consecutive = len(model.byte_ids) == 256 and all(i == first + b for b, i in model.byte_ids.items())
    if model.byte_ids and not consecutive:
        raise ValueError("byte pieces must be 256 in a row")
    spare = F.transform(codes, lambda c: c + first) if consecutive else F.array(F.lit(model.unknown))
    ids = F.when(F.col("id").isNotNull(), F.array("id")).otherwise(spare)
    edge = F.struct("start", "end", F.coalesce("score", F.lit(float(model.floor))).alias("score"), F.col("id").isNotNull().alias("piece"), ids.alias("ids"))
    return found.groupBy("unit").agg(F.collect_list(edge).alias("edges"))


def viterbi_fold(edges: DataFrame) -> DataFrame:
    """unit, ids: the best path of each lattice, folded over the places where edges end."""
    kind = "array<struct<score:double,ids:array<int>>>"
    origin = F.array(F.struct(F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("ids"))).cast(kind)

    def step(paths, end):
        into = F.array_sort(F.filter("edges", lambda e: e["end"] == end))  # by start
        ways = F.transform(into, lambda e, i: F.struct((F.get(paths, e["start"])["score"] + e["score"]).alias("score"), (-i).alias("order"), F.concat(F.get(paths, e["start"])["ids"], e["ids"]).alias("ids")))
        # An array of one is a name for its element: the maximum is found once.
        best = F.transform(F.array(F.array_max(ways)), lambda b: F.struct(b["score"].alias("score"), b["ids"].alias("ids")))
        return F.concat(paths, best)

    path = F.aggregate(F.sequence(F.lit(1), F.char_length("unit")), origin, step, lambda paths: F.element_at(paths, -1)["ids"])
    return edges.select("unit", path.alias("ids"))


def merge_fold(edges: DataFrame) -> DataFrame:
    """unit, ids: the lattice's edges taken as merges, the best score first and then the leftmost, folded over the merges there can be."""
    n = F.char_length("unit")

    def step(cuts, _):
        def joins(e):
            inside = F.filter(cuts, lambda c: (c > e["start"]) & (c < e["end"]))
            return e["piece"] & F.array_contains(cuts, e["start"]) & F.array_contains(cuts, e["end"]) & (F.size(inside) == 1)

        ways = F.transform(F.filter("edges", joins), lambda e: F.struct(e["score"].alias("score"), (-e["start"]).alias("left"), e["end"].alias("end")))
        # An array of one is a name for its element: the maximum is found once.
        named = F.array(F.array_max(ways))
        return F.flatten(F.transform(named, lambda best: F.filter(cuts, lambda c: best.isNull() | (c <= -best["left"]) | (c >= best["end"]))))

    cuts = F.when(n > 1, F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), F.sequence(F.lit(0), n), step)).otherwise(F.sequence(F.lit(0), n))
    rows = edges.withColumn("_cuts", cuts)
    used = F.filter("edges", lambda e: F.array_contains("_cuts", e["start"]) & F.array_contains("_cuts", e["end"]) & (F.size(F.filter("_cuts", lambda c: (c > e["start"]) & (c < e["end"]))) == 0))
    return rows.select("unit", F.flatten(F.transform(F.array_sort(used), lambda e: e["ids"])).alias("ids"))


def encode_units(units: DataFrame, model: Model) -> DataFrame:
    """unit, ids of a table of units, by the relational lattice."""
    distinct = units.select("unit").where("unit <> ''").distinct()
    edges = lattice(distinct, piece_table(units.sparkSession, model), model)
    return viterbi_fold(edges) if model.algorithm == UNIGRAM else merge_fold(edges)


def frequent_units(docs: DataFrame, text_col: str, prefix: bool, most: int = FREQUENT_UNITS) -> DataFrame:
    """unit: the units that occur most often, at most ``most``, none of them longer than UNIT_CHARS."""

    def count(batches):
        def rows(held: Counter) -> pa.RecordBatch:
            kept = [u for u in held if 0 < len(u) <= UNIT_CHARS]
            return pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), pa.array([held[u] for u in kept], pa.int64())], names=["unit", "n"])

        held: Counter = Counter()
        for batch in batches:
            for text in as_bytes(batch.column(0)):
                for units in lines_of_units((text or b"").decode("utf-8", "replace"), prefix):
                    held.update(units)
                if len(held) > COUNTED:
                    yield rows(held)
                    held.clear()
        yield rows(held)

    counts = docs.select(text_col).mapInArrow(count, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))
    counts = cut(counts.where("n > 1"))
    # How many units have each count, over powers of two and their eighths: a few hundred rows.
    level = F.floor(F.log2("n") * 8).cast("int")
    least, room = None, most
    for row in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        room -= row["count"]
        if room < 0:
            break
        least = row["level"]
    return counts.where(level >= least if least is not None else F.lit(False)).select("unit")


class UnitIds(dict):
    """Ids (32-bit little-endian) of each unit; those not from Spark are held up to a bound."""

    def __init__(self, model: Model, frequent: dict[str, bytes]):
        super().__init__(frequent)
        self.model, self.frequent = model, frequent
        self.merges = Merges(model) if model.algorithm == BPE else None

    def learn(self, texts: list[list[list[str]]]) -> None:
        """Take in the short units of some texts, all at once where the model merges."""
        if self.merges:
            met = set().union(*[units for lines in texts for units in lines])
            self.update(self.merges.encode([u for u in met - self.keys() if len(u) <= SHORT]))

    def forget(self) -> None:
        """Keep the number of units bounded."""
        if len(self) > len(self.frequent) + HELD:
            self.clear()
            self.update(self.frequent)

    def __missing__(self, unit: str) -> bytes:
        self.forget()
        ids = np.array(self.model.encode_unit(unit), "<i4").tobytes()
        if len(unit) <= 4 * UNIT_CHARS:
            self[unit] = ids
        return ids


def _with_columns(df: DataFrame, source: str, made: dict[str, str], start) -> DataFrame:
    """``df`` with columns (name: type) made in tasks: ``start()`` gives a function from a slice of ``source`` to their arrays."""
    keep = [c for c in df.columns if c not in made]
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + [f"{name} {kind}" for name, kind in made.items()])

    def run(batches):
        make = start()
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                arrays = [batch.column(i) for i in range(len(keep))] + make(batch.column(len(keep)))
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *made])

    columns = [F.col(f"`{c}`") for c in keep]
    return df.select(*columns, F.col(f"`{source}`").alias(free_name(df))).mapInArrow(run, schema)


def _encoder(docs: DataFrame, model: Model, text_col: str):
    """For tasks: starts a function from texts to arrays of ids."""
    prefix = model.dummy_prefix
    # At most FREQUENT_UNITS rows.
    rows = encode_units(frequent_units(docs, text_col, prefix), model).toLocalIterator()
    shared = docs.sparkSession.sparkContext.broadcast((model, {r["unit"]: np.array(r["ids"], "<i4").tobytes() for r in rows}))

    def start():
        known = UnitIds(*shared.value)
        newline = np.array(known.model.encode_unit("\n"), "<i4").tobytes()

        def encoded(texts: pa.Array) -> pa.Array:
            parts = []
            split = [lines_of_units((text or b"").decode("utf-8", "replace"), prefix) for text in as_bytes(texts)]
            known.forget()
            known.learn(split)
            for lines in split:
                parts.append(newline.join([b"".join(map(known.__getitem__, units)) for units in lines]))
            ends = np.cumsum([0, *[len(p) // 4 for p in parts]]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), "<i4")))

        return encoded

    return start


def _decoder(spark: SparkSession, model: Model):
    """For tasks: starts a function from arrays of ids to texts."""
    codes = {i: b for b, i in model.byte_ids.items()}
    plain = [bytes([codes[i]]) if i in codes else b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN else p.replace(BLANK, " ").encode() for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True))]
    shared = spark.sparkContext.broadcast((plain, model.dummy_prefix))

    def start():
        plain, prefix = shared.value
        pieces = pa.array(plain, pa.large_binary())

        def decoded(lists: pa.Array) -> pa.Array:
            flat = lists.flatten()
            if flat.null_count:
                raise IndexError("a piece id that is missing")
            # The pieces of all texts of the slice stand one after the other.
            joined = pieces.take(flat)
            _, bounds, data = joined.buffers()
            bounds = np.frombuffer(bounds, np.int64, len(joined) + 1) if len(joined) else np.zeros(1, np.int64)
            lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = bounds[np.cumsum(np.concatenate(([0], lengths)).astype(np.int64))].tolist()
            raw, texts = memoryview(data or b""), []
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                if prefix and a < b and raw[a] == ord(" "):
                    a += 1
                texts.append(str(raw[a:b], "utf-8", "replace"))
            return pa.array(texts, pa.string())

        return decoded

    return start


def encode(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``piece_ids`` (array<int>; replaces a column of that name): the ids of the whole text.

    Missing and empty texts have no ids. Repeated rows get equal ids. Other
    columns stay; an empty table gives an empty table.
    """
    encoder = _encoder(docs, Model.load(model_path), text_col)

    def start():
        encoded = encoder()
        return lambda texts: [encoded(texts)]

    return _with_columns(docs, text_col, {"piece_ids": "array<int>"}, start)


def decode(rows: DataFrame, model_path: str) -> DataFrame:
    """``rows`` with ``decoded`` (replaces a column of that name): the text of ``piece_ids``.

    Blank marks become blanks and the one put before the text is taken away,
    so texts that hold no blank mark themselves come back as they were. Byte
    pieces are put together; bytes that are no UTF-8 become the replacement
    character, ids that are not in the vocabulary raise an error, and a
    missing array has the empty text.
    """
    decoder = _decoder(rows.sparkSession, Model.load(model_path))

    def start():
        decoded = decoder()
        return lambda lists: [decoded(lists)]

    typed = rows.withColumn("piece_ids", F.col("piece_ids").cast("array<int>"))
    return _with_columns(typed, "piece_ids", {"decoded": "string"}, start)


def encode_and_decode(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``piece_ids`` and ``decoded`` as ``decode(encode(docs))`` has them, in one pass over the texts."""
    model = Model.load(model_path)
    encoder, decoder = _encoder(docs, model, text_col), _decoder(docs.sparkSession, model)

    def start():
        encoded, decoded = encoder(), decoder()

        def both(texts: pa.Array) -> list[pa.Array]:
            ids = encoded(texts)
            return [ids, decoded(ids)]

        return both

    return _with_columns(docs, text_col, {"piece_ids": "array<int>", "decoded": "string"}, start)
