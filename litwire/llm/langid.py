"""Language identification by rank-order profiles of letter n-grams."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litwire.llm.common import as_bytes, per_row

PROFILE = 400
UNKNOWN = "und"
#: ISO 639-3 has fewer than 8,000 codes; more labels than this are not language codes.
MOST_LANGUAGES = 20_000
FLUSH = 2_000_000


@functools.cache
def letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of one to three letters (a blank for all between words) and their counts."""
    codes = np.frombuffer((text or b"").decode("utf-8", "replace").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letters()[codes]
    if not letter.any():
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    c = np.where(letter, codes, 32)[keep].astype(np.uint64)
    blank = np.array([32], np.uint64)
    c = np.concatenate((blank, c, blank[: int(c[-1] != 32)]))
    pairs = (c[:-1] << np.uint64(21)) | c[1:]
    triples = (pairs[:-1] << np.uint64(21)) | c[2:]
    return np.unique(np.concatenate((c[c != 32], pairs, triples[c[1:-1] != 32])), return_counts=True)


def ranked(keys: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """The most frequent n-grams in order; ties by code."""
    return keys[np.lexsort((keys, -counts))[:most]]


def learn_profiles(docs: DataFrame, text_col: str, lang_col: str, size: int = PROFILE) -> dict[str, np.ndarray]:
    """The n-grams of each language in order of frequency, from all rows with a language."""

    def count(batches):
        held: dict[str, list] = {}

        def rows():
            for lang, parts in held.items():
                keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                n = np.bincount(where, weights=np.concatenate([c for _, c in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])
            held.clear()

        waiting = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
                keys, n = grams(text)
                if len(keys):
                    held.setdefault(lang, []).append((keys, n))
                    waiting += len(keys)
                if waiting > FLUSH:
                    yield from rows()
                    waiting = 0
        yield from rows()

    known = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), text_col)
    counts = known.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)
    profiles: dict[str, list] = {}
    for row in best.select("lang", "place", "gram").toLocalIterator():
        profiles.setdefault(row["lang"], []).append((row["place"], row["gram"]))
        if len(profiles) > MOST_LANGUAGES:
            raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return {lang: np.array([g for _, g in sorted(p)], np.int64).view(np.uint64) for lang, p in sorted(profiles.items())}


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; these replace columns of the same name.

    The n-grams of a text, by frequency, are compared with those of each
    language: every one adds the distance of its two ranks, or ``size`` if the
    language lacks it. The least sum wins, ties by name; the score is 1 less
    the share of the largest sum possible. Missing texts, texts without
    letters, and all texts if nothing was learned, are ``und`` with score 0.
    """
    names = list(profiles)
    known = np.unique(np.concatenate(list(profiles.values()))) if names else np.empty(0, np.uint64)
    ranks = np.full((len(names), len(known) + 1), -1, np.int32)
    for i, name in enumerate(names):
        ranks[i, np.searchsorted(known, profiles[name])] = np.arange(len(profiles[name]))
    shared = docs.sparkSession.sparkContext.broadcast((names, known, ranks))

    def judge(texts: list) -> tuple:
        names, known, ranks = shared.value
        langs, scores = [], []
        for text in texts:
            own = ranked(*grams(text), size)
            if not len(own) or not len(known):
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            at = np.searchsorted(known, own)
            at[known[np.minimum(at, len(known) - 1)] != own] = len(known)
            theirs = ranks[:, at]
            apart = np.where(theirs < 0, size, np.minimum(np.abs(theirs - np.arange(len(own))), size)).sum(1)
            langs.append(names[int(apart.argmin())])
            scores.append(float(1 - apart.min() / (size * len(own))))
        return langs, scores

    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return per_row(docs, text_col, judge, [("lang_pred", "string"), ("score", "double")], keep)


def held_out(id_col: str = "doc_id") -> Column:
    """A fixed quarter of the ids that is never learned from; rows without id are not in it."""
    rest = F.crc32(F.col(id_col).cast("string").cast("binary")) % 4
    return F.coalesce(rest == 2, F.lit(False))


def train_and_identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``identify`` with profiles from the rows of ``docs`` that have a language and an id outside the held-out quarter."""
    learn = docs.where(F.col(id_col).isNotNull() & ~held_out(id_col))
    return identify(docs, learn_profiles(learn, text_col, lang_col), text_col)
