"""Quality rules with thresholds that are controlled for risk.

Each document gets simple signals between 0 and 1. Labelled documents are
halved by a hash of their id. The first half proposes, for every stratum, the
rules that tell good from bad best; the second, the holdout, certifies their
cutoffs: going from lax to strict, a cutoff stands as long as the exact
binomial test rejects "this rule turns away more than its share of good
documents". Testing in a fixed order needs no correction along the cutoffs;
over rules and strata the level is divided (Bonferroni). So with probability
1 - DELTA no stratum loses more than ALPHA of its good documents to all rules.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litwire.llm.common import per_row
from litwire.session import cut

ALPHA, DELTA = 0.02, 0.10
RULES = 3
BINS = 64
SYMBOLS = b"#*$%&|<>"
WHITE_BYTES = b" \t\n\x0b\x0c\r"
UPPER_BYTES = bytes(range(65, 91))
MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
#: Words that divide documents into strata by length.
STRATA = (100, 500)
SIGNALS = ("symbols", "capitals", "marks", "repeats", "sameness", "lines")


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words inside windows of ``width`` words that the text has at least twice."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    one = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    window, kinds = one, len(known)
    for i in range(1, width):
        # Two numbers in one: below 2**63 as both are below the number of words.
        pairs = window[: len(words) - i] * len(known) + one[i:]
        if kinds * len(known) < 1 << 40 and i < width - 1:
            window, kinds = pairs, kinds * len(known)
            continue
        distinct, window = np.unique(pairs, return_inverse=True)
        kinds = len(distinct)
    often = np.bincount(window) >= 2
    starts = often[window]
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += starts
    edges[width : width + n] -= starts
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def text_signals(text: bytes | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, then SIGNALS between 0 and 1."""
    text = text or b""
    words = text.split()
    if not words:
        return (0, 0, len(text) - len(text.translate(None, SYMBOLS)), 0, 0, *(0.0,) * len(SIGNALS))
    n_bytes = len(text.translate(None, WHITE_BYTES))
    chars = n_bytes - len(text.translate(None, bytes(b for b in range(256) if not 128 <= b < 192))) if not text.isascii() else n_bytes
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeats = repeated_words(words)
    duplicate = len(lines) - len(set(lines))
    capitals = len(text) - len(text.translate(None, UPPER_BYTES))
    marks = len(text) - len(text.translate(None, MARKS))
    sameness = 1 - len(set(words)) / len(words)
    return (len(words), chars, symbols, duplicate, repeats, symbols / chars, capitals / chars, marks / chars, repeats / len(words), sameness, duplicate / len(lines))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the five counts and a small bin number for each signal."""

    def run(texts: list) -> tuple:
        rows = [text_signals(t) for t in texts]
        columns = list(zip(*rows, strict=True)) or [()] * (len(COUNTS) + len(SIGNALS))
        bins = [[min(BINS, int(v * BINS)) for v in column] for column in columns[len(COUNTS) :]]
        return (*columns[: len(COUNTS)], *bins)

    taken = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text"))
    return per_row(taken, "_text", run, [(c, "long") for c in COUNTS] + [(f"s_{s}", "int") for s in SIGNALS], ["doc_id"])


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.lit(100) * F.col("n_repeat_words") > F.lit(20) * F.col("n_words"))


def length_stratum() -> Column:
    """A small whole number below len(STRATA) + 1."""
    return sum(((F.col("n_words") >= n).cast("int") for n in STRATA), F.lit(0))


def binomial_tail(k: int, n: int, rate: float) -> float:
    """P(at most k of n) at this rate, exactly; the rate's upper bound at level d is where this is d."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(rate) + (n - i) * math.log1p(-rate) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(v - top) for v in logs))


def choose_cutoffs(counts: dict[tuple, int], strata: int, alpha: float = ALPHA, delta: float = DELTA, rules: int = RULES) -> dict[tuple[int, str], int]:
    """(stratum, signal) -> smallest bin that is turned away. ``counts``: (stratum, holdout, quality, signal, bin) -> documents."""

    def tail(stratum: int, holdout: bool, quality: int, signal: str) -> np.ndarray:
        n = np.array([counts.get((stratum, holdout, quality, signal, b), 0) for b in range(BINS + 1)], np.int64)
        return n[::-1].cumsum()[::-1]  # at each bin: documents in it or above

    chosen = {}
    for stratum in range(strata):
        gains = {}
        for signal in SIGNALS:
            good, bad = tail(stratum, False, 1, signal), tail(stratum, False, 0, signal)
            if good[0] and bad[0]:
                useful = np.where(good / good[0] <= alpha / rules, bad / bad[0], 0)
                useful[0] = 0
                if useful.max() > alpha:
                    gains[signal] = useful
        for signal in sorted(gains, key=lambda s: (-gains[s].max(), s))[:rules]:
            good = tail(stratum, True, 1, signal)
            stands = BINS + 1
            while stands > 1 and binomial_tail(int(good[stands - 1]), int(good[0]), alpha / rules) <= delta / (strata * rules):
                stands -= 1
            if stands <= BINS:
                # The laxest certified cutoff that turns away nearly as much as the strictest.
                worth = gains[signal][stands:]
                lax = np.flatnonzero(worth >= 0.95 * worth.max())
                if worth.max() > 0:
                    chosen[stratum, signal] = stands + int(lax[-1])
    return chosen


def apply_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, counts, base_failed, kept, rule (the first that turns it away).

    ``labels`` has doc_id and quality (1 good, 0 bad); other values, and rows
    without either, are left aside, and an id labelled both ways is bad. A
    stratum with too few labelled documents to certify anything has no rule.
    Missing, empty and blank texts have no words and fail the base. Repeated
    rows get equal results; other columns are left aside; an empty table gives
    an empty table.
    """
    table = cut(measure(docs, id_col, text_col).withColumns({"base_failed": base_failed(), "stratum": length_stratum()}))
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    second = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1
    rated = table.where(~F.col("base_failed")).join(known, "doc_id").withColumn("holdout", second)
    signals = F.explode(F.array(*[F.struct(F.lit(s).alias("signal"), F.col(f"s_{s}").alias("bin")) for s in SIGNALS]))
    cells = rated.select("stratum", "holdout", "quality", signals.alias("_s")).groupBy("stratum", "holdout", "quality", "_s.signal", "_s.bin").count()
    # Bounded by strata, signals and bins, whatever the corpus.
    counts = {(r["stratum"], r["holdout"], r["quality"], r["signal"], r["bin"]): r["count"] for r in cells.collect()}
    cutoffs = choose_cutoffs(counts, len(STRATA) + 1)
    rule = F.when(F.col("base_failed"), F.lit("base"))
    for (stratum, signal), bin_ in sorted(cutoffs.items()):
        rule = rule.when((F.col("stratum") == stratum) & (F.col(f"s_{signal}") >= bin_), F.lit(signal))
    return table.select("doc_id", *COUNTS, "base_failed", rule.isNull().alias("kept"), rule.alias("rule"))
