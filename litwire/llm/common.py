"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tab, line feed, vertical tab, form feed, carriage return and space.
WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stands for a missing id where rows are put in order: such rows come last.
LAST = (1 << 63) - 1


def fold_ascii(column: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(column, UPPER, LOWER)


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` as one, so that no name of theirs meets an inner one."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def with_results(row: str, columns: list[str], results: dict[str, Column]) -> list[Column]:
    """The packed ``columns`` in ``row``, then the results; these replace columns of the same name."""
    kept = [F.col(row).getField(c).alias(c) for c in columns if c not in results]
    return kept + [column.alias(name) for name, column in results.items()]


def free_name(df: DataFrame) -> str:
    """A column name that ``df`` does not have."""
    return "_" + max([*df.columns, "in"], key=len)


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a text column, without decoding."""
    return column.cast(pa.large_binary()).to_pylist()


KINDS = {"long": pa.int64(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32()}


def per_row(df: DataFrame, column: str, function: Callable[[list], tuple], names: list[tuple[str, str]], keep: list[str]) -> DataFrame:
    """``keep`` columns as they are, and what ``function`` makes of a text column's rows (as bytes).

    ``function`` gets a batch of them and returns one list per entry of
    ``names`` (name, type).
    """
    taken = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{column}`").alias(free_name(df)))
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + [f"`{n}` {t}" for n, t in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = function(as_bytes(batch.column(len(keep))))
            arrays = [batch.column(i) for i in range(len(keep))]
            arrays += [pa.array(values, type=KINDS[kind]) for values, (_, kind) in zip(made, names, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *[n for n, _ in names]])

    return taken.mapInArrow(run, schema)


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser over unsigned integers."""
    x = values + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
