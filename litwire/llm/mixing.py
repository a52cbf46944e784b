"""Soft-membership mixing: document rates whose expected domain totals match targets.

A classifier learned from a labelled table gives every document a posterior
over domains. Rates r >= 0 then minimise

    sum over domains k of (S_k - T_k)^2 / (N T_k)  +  RIDGE / N * sum over documents of n_d (r_d - 1)^2,

S_k the sum of r_d n_d p_dk, n_d a document's tokens, N all tokens. They are
found by projected gradient: each step moves all rates down the gradient and
back to 0 where they fell below. Gradients of rates differ by what documents
have in common, their posteriors, so the step is scaled by the curvature of
the domain totals over the rates that are free to move; rates at 0 that the
gradient holds there keep to a diagonal scale (two-metric projection). Steps
are halved until the objective falls, and end when the projected gradient
vanishes. Documents of one feature pattern share a rate, so sums go over
patterns, of which there is a fixed number.
DataFrame functions throughout; the driver solves for one number per domain.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litwire.llm.common import LAST, WHITE, fold_ascii, packed
from litwire.session import cut

#: Labelled rows that the classifier is fitted on, at most (chosen by a hash of the id).
LABELLED = 5_000
LEXICON = 40
BANDS, HITS = 8, 4
MOST_DOMAINS = 16
RIDGE, CLOSE = 1e-3, 0.002
#: Projected gradient, relative to the largest gap, at which rates are taken as found. Steps end far below MOST_STEPS; beyond it they fail.
FOUND, MOST_STEPS = 1e-9, 200
#: Rates up to this, at most, count as held at 0 if the gradient pushes them there.
HELD = 0.01
#: Word characters that seldom occur in running text.
MARKS = r"[#*$%&|<>!]"


@dataclass(frozen=True)
class Classifier:
    """Domains, their lexicons, and log-probabilities: of each domain, and of each value of each feature."""

    domains: list[str]
    lexicons: list[list[str]]
    prior: list[float]
    tables: dict[str, list[list[float]]]


def words_of(text: Column) -> Column:
    """Words of a text without capitals A-Z; a text without words has one empty word."""
    return F.split(F.trim(fold_ascii(text), F.lit(WHITE)), r"[\x20\x09-\x0D]+", -1)


def fitted_labels(labelled: DataFrame, most: int = LABELLED) -> DataFrame:
    """doc_id, domain: one row for each of at most ``most`` ids."""
    known = labelled.where("doc_id is not null and domain is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("domain").alias("domain"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def learn_lexicons(docs: DataFrame, labels: DataFrame, domains: list[str], id_col: str, text_col: str, size: int = LEXICON) -> list[list[str]]:
    """Words that speak most for each domain, by log-odds of being in its labelled documents."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text")).join(F.broadcast(labels), "doc_id")
    words = rows.select("domain", F.explode(F.array_distinct(words_of(F.col("_text")))).alias("word")).where("word <> ''")
    counts = words.groupBy("word", "domain").count()
    totals = {r["domain"]: r["n"] for r in rows.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    all_docs = sum(totals.values()) or 1
    per_word = Window.partitionBy("word")
    size_of = F.create_map(*[F.lit(v) for d in domains for v in (d, float(totals.get(d, 0)))])[F.col("domain")]
    other = F.sum("count").over(per_word) - F.col("count")
    inside = (F.col("count") + 0.5) / (size_of + 1)
    outside = (other + 0.5) / (F.lit(float(all_docs)) - size_of + 1)
    rated = counts.withColumn("weight", F.col("count") * F.log(inside / outside)).where("weight > 0")
    best = rated.withColumn("place", F.row_number().over(Window.partitionBy("domain").orderBy(F.desc("weight"), "word"))).where(F.col("place") <= size)
    found: dict[str, list[str]] = {}
    for r in best.select("domain", "word").collect():  # size times domains
        found.setdefault(r["domain"], []).append(r["word"])
    return [sorted(found.get(d, [])) for d in domains]


def features(docs: DataFrame, lexicons: list[list[str]], text_col: str) -> DataFrame:
    """``docs`` with _tokens and small whole numbers: _same, _marks, _caps, and _hit0.. for each domain."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    listed = F.lit(sorted({w for words in lexicons for w in words})).cast("array<string>")
    words = docs.withColumn("_words", words_of(text))
    tokens = F.when(F.element_at("_words", 1) == "", 0).otherwise(F.size("_words"))
    distinct = F.array_distinct("_words")

    def band(share: Column) -> Column:
        return F.least(F.floor(F.sqrt(F.coalesce(share, F.lit(0.0))) * BANDS), F.lit(BANDS - 1)).cast("int")

    n = F.greatest(F.char_length(text), F.lit(1))
    rows = words.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        tokens.cast("long").alias("_tokens"),
        band(1 - F.size(distinct) / F.greatest(F.size("_words"), F.lit(1))).alias("_same"),
        band(F.regexp_count(text, F.lit(MARKS)) / n).alias("_marks"),
        band(F.regexp_count(text, F.lit("[A-Z]")) / n).alias("_caps"),
        F.array_intersect(distinct, listed).alias("_found"),
    )
    hits = {f"_hit{i}": F.least(F.size(F.array_intersect("_found", F.lit(list(words)).cast("array<string>"))), F.lit(HITS - 1)).cast("int") for i, words in enumerate(lexicons)}
    return rows.withColumns(hits).drop("_found")


def feature_names(domains: int) -> list[str]:
    return ["_same", "_marks", "_caps", *[f"_hit{i}" for i in range(domains)]]


def learn(table: DataFrame, labels: DataFrame, domains: list[str], lexicons: list[list[str]]) -> Classifier:
    """Naive Bayes over the features of labelled rows; each value starts with one count."""
    names = feature_names(len(domains))
    rows = table.join(F.broadcast(labels), "doc_id")
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in names]))
    cells = rows.select("domain", pairs.alias("_f")).groupBy("domain", "_f.name", "_f.value").count().collect()
    counts = {(r["domain"], r["name"], r["value"]): r["count"] for r in cells}
    sizes = [sum(counts.get((d, "_same", v), 0) for v in range(BANDS)) for d in domains]
    total = sum(sizes) + len(domains)
    tables = {}
    for name in names:
        width = BANDS if not name.startswith("_hit") else HITS
        tables[name] = [[math.log((counts.get((d, name, v), 0) + 1) / (size + width)) for v in range(width)] for d, size in zip(domains, sizes, strict=True)]
    return Classifier(domains, lexicons, [math.log((s + 1) / total) for s in sizes], tables)


def posteriors(table: DataFrame, model: Classifier) -> DataFrame:
    """``table`` with _p: the probability of each domain, in the order of the model."""
    scores = []
    for i in range(len(model.domains)):
        score = F.lit(model.prior[i])
        for name, rows in model.tables.items():
            score = score + F.get(F.array(*[F.lit(v) for v in rows[i]]), F.col(name))
        scores.append(score)
    raw = table.withColumn("_s", F.array(*scores)).withColumn("_top", F.array_max("_s"))
    weights = raw.withColumn("_w", F.transform("_s", lambda s: F.exp(s - F.col("_top"))))
    total = F.aggregate("_w", F.lit(0.0), lambda a, w: a + w)
    return weights.withColumn("_n", total).withColumn("_p", F.transform("_w", lambda w: w / F.col("_n"))).drop("_s", "_top", "_w", "_n")


@dataclass(frozen=True)
class Step:
    """One step: its length, the gaps of the domain totals before it, their scaled direction, and up to where rates count as held."""

    length: float
    gaps: list[float]
    scaled: list[float]
    held: float


def gradient_of(rate: Column, gaps: Column) -> Column:
    """Derivative of the objective by a rate, a share of its document's tokens; ``gaps`` is the pull p . gap."""
    return gaps + RIDGE * (rate - 1)


def rate_of(steps: list[Step], wide: int) -> Column:
    """The rate after projected gradient steps from a rate of 1."""
    if not steps:
        return F.lit(1.0)
    flat = F.lit([v for s in steps for v in (s.length, s.held, *s.gaps, *s.scaled)])
    size = 2 + 2 * wide

    def pull(at: Column) -> Column:
        return sum((F.get("_p", F.lit(k)) * F.get(flat, at + k) for k in range(wide)), F.lit(0.0))

    def descend(rate: Column, step: Column) -> Column:
        at = step * size
        plain = pull(at + 2)
        held = (rate <= F.get(flat, at + 1)) & (gradient_of(rate, plain) > 0)
        move = rate - 1 + F.when(held, plain).otherwise(pull(at + 2 + wide)) / RIDGE
        return F.greatest(F.lit(0.0), rate - F.get(flat, at) * move)

    return F.aggregate(F.sequence(F.lit(0), F.lit(len(steps) - 1)), F.lit(1.0), descend)


def fit_rates(patterns: DataFrame, targets: list[float]) -> tuple[list[Step], list[float]]:
    """Projected gradient steps to the minimum over ``patterns`` (_p, _tokens summed), and the gaps left there.

    The distributed part of each step is two aggregations, and one more for each halving. Raises when the minimum is not reached.
    """
    k = len(targets)
    total = float(patterns.agg(F.sum("_tokens").alias("n")).first()["n"] or 0)
    if not total:
        return [], [0.0] * k
    goal = np.array([max(t, 1e-9) for t in targets])
    root = np.sqrt(goal)
    weighed = patterns.select("_p", (F.col("_tokens") / total).alias("_w"))

    def part(i: int) -> Column:
        return F.col("_w") * F.get("_p", F.lit(i))

    def objective(steps: list[Step]) -> tuple[float, np.ndarray]:
        """The objective and the gaps of the domain totals after ``steps``."""
        rated = weighed.withColumn("_r", rate_of(steps, k))
        sums = [F.sum(F.col("_r") * part(i)).alias(f"s{i}") for i in range(k)]
        row = rated.agg(F.sum(F.col("_w") * (F.col("_r") - 1) * (F.col("_r") - 1)).alias("q"), *sums).first()
        gaps = (np.array([row[f"s{i}"] for i in range(k)]) - goal) / goal
        return float((goal * gaps * gaps).sum() / 2 + RIDGE / 2 * row["q"]), gaps

    steps: list[Step] = []
    value, gaps = objective(steps)
    held = HELD
    for _ in range(MOST_STEPS):
        plain = sum((F.get("_p", F.lit(i)) * float(g) for i, g in enumerate(gaps)), F.lit(0.0))
        rated = weighed.withColumn("_r", rate_of(steps, k)).withColumn("_g", gradient_of(F.col("_r"), plain))
        left = F.when(F.col("_r") > 0, F.abs("_g")).otherwise(F.greatest(F.lit(0.0), -F.col("_g")))
        free = ~((F.col("_r") <= held) & (F.col("_g") > 0))
        cells = [F.sum(F.when(free, part(i) * F.get("_p", F.lit(j))).otherwise(0.0)).alias(f"m{i}_{j}") for i in range(k) for j in range(i, k)]
        slopes = [F.sum(F.when(free, part(i) * F.col("_g")).otherwise(0.0)).alias(f"b{i}") for i in range(k)]
        along = F.sum(F.when(free, F.col("_w") * F.col("_g") * (F.col("_r") - 1)).otherwise(0.0)).alias("t")
        row = rated.agg(F.max(left).alias("left"), along, *cells, *slopes).first()
        if row["left"] <= FOUND * (1 + np.abs(gaps).max()):
            return steps, gaps.tolist()
        slope = np.array([row[f"b{i}"] for i in range(k)])
        bend = np.array([[row[f"m{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
        # Scaled by the targets, as those of small domains differ by orders of magnitude.
        scaled = gaps - np.linalg.solve(bend / np.outer(root, root) + RIDGE * np.eye(k), slope / root) / root
        fall = row["t"] + float(slope @ scaled) / RIDGE
        length = 1.0
        while True:
            tried = [*steps, Step(length, gaps.tolist(), scaled.tolist(), held)]
            ahead = objective(tried)
            if ahead[0] <= value - 1e-4 * length * fall + 1e-14 * (1 + abs(value)):
                break
            length /= 2
            if length < 1e-9:
                raise RuntimeError(f"rates not found: projected gradient {row['left']}")
        steps, held = tried, min(HELD, row["left"])
        value, gaps = ahead
    raise RuntimeError(f"rates not found in {MOST_STEPS} steps: projected gradient {row['left']}")


@dataclass(frozen=True)
class Mixture:
    """What ``fit`` found; ``apply`` needs a text and an id only."""

    model: Classifier
    steps: list[Step]
    #: How far each domain's expected total is from its target, as a share of the target.
    gaps: dict[str, float]

    def rated(self, table: DataFrame) -> DataFrame:
        """A table with features, with _p, _rate and _copies."""
        rows = posteriors(table, self.model).withColumn("_rate", rate_of(self.steps, len(self.model.domains)))
        chance = F.pmod(F.xxhash64("_id", "_t"), F.lit(1 << 30)) / float(1 << 30)
        whole = F.floor("_rate")
        return rows.withColumn("_copies", (whole + (chance < F.col("_rate") - whole).cast("long")).cast("int"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.withColumns({"_id": F.col(f"`{id_col}`").cast("long"), "_t": F.xxhash64(f"`{text_col}`")})


def fit(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> tuple[Mixture, DataFrame]:
    """The mixture for ``docs``, and the table of features (doc_id, _id, _t, _tokens, ...) that it was fitted on."""
    if not 0 < len(targets) <= MOST_DOMAINS:
        raise ValueError(f"between 1 and {MOST_DOMAINS} domains")
    domains = sorted(targets)
    weight = sum(targets.values())
    labels = cut(fitted_labels(labelled.where(F.col("domain").isin(domains))))
    lexicons = learn_lexicons(docs, labels, domains, id_col, text_col)
    keyed = _keyed(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("_text")), "doc_id", "_text")
    table = cut(features(keyed, lexicons, "_text").drop("_text"))
    model = learn(table, labels, domains, lexicons)
    names = feature_names(len(domains))
    patterns = cut(posteriors(table.groupBy(*names).agg(F.sum("_tokens").alias("_tokens")), model))
    steps, gaps = fit_rates(patterns, [targets[d] / weight for d in domains])
    mixture = Mixture(model, steps, dict(zip(domains, gaps, strict=True)))
    missed = {d: round(gap, 4) for d, gap in mixture.gaps.items() if abs(gap) > CLOSE}
    if missed:
        warnings.warn(f"targets that no rates meet; totals are off by these shares of them: {missed}", stacklevel=2)
    return mixture, table


def document_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, p_<domain> for each, rate, copies, gap_<domain> for each.

    ``labelled`` has doc_id and domain; ``targets`` gives each domain's share
    of tokens. ``copies`` is the rate rounded down or up by a hash of id and
    text, so that its expectation is the rate. Missing and empty texts have no
    tokens and get a rate as others do. ``gap_<domain>``, alike in all rows, says
    how far that domain's expected total stays from its target, as a share of
    the target; only targets that no rates meet leave more than traces. Repeated rows get equal rates and
    copies. Without labelled rows all posteriors are equal. Other columns are
    left aside; an empty table gives an empty table.
    """
    mixture, table = fit(docs, labelled, targets, id_col, text_col)
    rows = mixture.rated(table)
    shares = [F.get("_p", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(mixture.model.domains)]
    gaps = [F.lit(gap).alias(f"gap_{d}") for d, gap in mixture.gaps.items()]
    return rows.select("doc_id", F.col("_tokens").alias("n_tokens"), *shares, F.col("_rate").alias("rate"), F.col("_copies").alias("copies"), *gaps)


def mixed_documents(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, each row as often as ``copies`` of ``document_rates`` says."""
    mixture, table = fit(docs, labelled, targets, id_col, text_col)
    # Written first: a filter on copies would else be pushed down to the texts, features and all.
    copies = cut(mixture.rated(table).select(F.coalesce("_id", F.lit(LAST)).alias("_id"), "_t", "_copies"))
    copies = copies.where("_copies > 0").dropDuplicates(["_id", "_t"])
    order = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST))
    held = docs.select(packed(docs).alias("_row"), order.alias("_id"), F.xxhash64(f"`{text_col}`").alias("_t"))
    rows = held.join(copies, ["_id", "_t"])
    return rows.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_time")).select("_row.*")
