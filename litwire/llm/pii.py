"""Personal data: exact base spans, and more from weak supervision, in DataFrame functions only.

Looser candidates (long hexadecimal secrets, telephone numbers without a
plus, titled names) are voted on by three labelers: a strict form (regex), a
word list (gazetteer) and what stands before (context). Counts of vote
patterns over all documents go through expectation-maximisation (Dawid and
Skene), which estimates each labeler's reliability per kind; its posteriors
train a logistic span classifier over votes and length, which decides. The
pattern table has a fixed number of rows, so both run on the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litwire.session import cut

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "name")
# The patterns of the contract; possessive, and started once per run of
# characters, so that no text takes more than linear time.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTET = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|)"
LOOSE_SECRET = r"[0-9A-Fa-f]{32,64}+"
LOOSE_PHONE = r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}"
LOOSE_NAME = r"(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Madame|Monsieur|Señor|Señora)\.?\x20\p{Lu}\p{Ll}++"
LOOSE = rf"(?<![\p{{L}}0-9+(.-])(?:{LOOSE_SECRET}|{LOOSE_PHONE}|{LOOSE_NAME})(?![\p{{L}}0-9-])"
BEFORE = 32
# Gazetteers: words that go with a kind.
NEAR_WORDS = {
    "phone": "phone|tel|call|fax|mobile|telefon|appel|llam",
    "secret": "token|key|secret|password|passwd|api|auth|credential",
    "name": "dear|contact|signed|regards|sincerely|author|from|by|von|par|por",
}
LABELERS = ("regex", "gazetteer", "context")
LENGTHS = 4
ROUNDS, STEPS = 60, 400
BLOCK = 256


def found_spans(text: Column, pattern: str) -> tuple[Column, Column]:
    """(matches, pieces between them): arrays, the pieces one longer than the matches."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)


def spans(matches: Column, pieces: Column, keep: Callable[[Column], Column] | None = None) -> Column:
    """array<struct<start, end, value, before>> in code points, end exclusive, of the matches whose value is to ``keep``.

    One pass adds up the places, over matches and pieces side by side: a
    function of all pieces inside a lambda would run again for every match.
    Spans are gathered in blocks, so that a text full of them stays cheap.
    """
    row_type = "array<struct<start:int,end:int,value:string,before:string>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(row_type).alias("block"), F.array().cast(f"array<{row_type}>").alias("blocks"))

    def add(acc: Column, z: Column) -> Column:
        begin = acc["at"] + F.char_length(z["p"])
        end = begin + F.coalesce(F.char_length(z["m"]), F.lit(0))
        row = F.struct(begin.alias("start"), end.alias("end"), z["m"].alias("value"), F.right(z["p"], F.lit(BEFORE)).alias("before"))
        wanted = z["m"].isNotNull() & (F.lit(True) if keep is None else keep(z["m"]))
        full = F.size(acc["block"]) == BLOCK
        block = F.when(full, F.array(row)).otherwise(F.concat(acc["block"], F.array(row)))
        blocks = F.when(full, F.concat(acc["blocks"], F.array(acc["block"]))).otherwise(acc["blocks"])
        grown = F.struct(end.alias("at"), block.alias("block"), blocks.alias("blocks"))
        return F.when(wanted, grown).otherwise(F.struct(end.alias("at"), acc["block"].alias("block"), acc["blocks"].alias("blocks")))

    pairs = F.arrays_zip(matches.alias("m"), pieces.alias("p"))
    return F.aggregate(pairs, start, add, lambda acc: F.flatten(F.concat(acc["blocks"], F.array(acc["block"]))))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes(kind: str, value: Column) -> Column:
    """The test that a match of a base kind must pass."""
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        n = F.char_length(digits(value))
        return n.between(12, 19) & F.call_function("luhn_check", digits(value))
    if kind == "phone":
        return F.char_length(digits(value)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """array<struct<start, kind, end>>, by start and then kind."""
    hint = {"email": "@", "phone": "+"}
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def of_kind(number: int, kind: str, pattern: str) -> Column:
        kept = spans(*found_spans(text, pattern), keep=lambda value: passes(kind, value))
        rows = F.transform(kept, lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end")))
        may = F.contains(text, F.lit(hint[kind])) if kind in hint else text.rlike("[0-9]")
        return F.when(may, rows).otherwise(empty)

    parts = [of_kind(i, kind, pattern) for i, (kind, pattern) in enumerate(zip(BASE, (EMAIL, IP, CARD, PHONE), strict=True))]
    return F.array_sort(F.concat(*parts))


def candidates(text: Column) -> Column:
    """array<struct<start, kind, end, votes, size>>: what the labelers say of each loose match."""

    def row(s: Column) -> Column:
        value, before = s["value"], F.lower(s["before"])
        secret, phone = value.rlike(rf"^{LOOSE_SECRET}$"), value.rlike(rf"^{LOOSE_PHONE}$")

        def by_kind(of_phone: Column, of_secret: Column, of_name: Column) -> Column:
            return F.when(secret, of_secret).when(phone, of_phone).otherwise(of_name).cast("int")

        strict = by_kind(value.rlike(r"^(?:\([0-9]{3}\)\x20|[0-9]{3}-)[0-9]{3}-"), F.char_length(value).isin(32, 40, 64) & value.rlike("[0-9]") & value.rlike("[A-Fa-f]"), F.contains(value, F.lit(".")))
        listed = by_kind(*[before.rlike(rf"(?:{NEAR_WORDS[k]})") for k in ("phone", "secret", "name")])
        context = by_kind(before.rlike(r"[:=(]\s*$"), before.rlike(r"[:=]\s*[\"']?$"), before.rlike(r"[,:]\s*$"))
        kind = F.when(secret, KINDS.index("secret")).when(phone, KINDS.index("phone")).otherwise(KINDS.index("name"))
        size = F.least(F.floor(F.char_length(value) / 12), F.lit(LENGTHS - 1)).cast("int")
        return F.struct(s["start"].alias("start"), kind.alias("kind"), s["end"].alias("end"), (strict + 2 * listed + 4 * context).alias("votes"), size.alias("size"))

    return F.transform(spans(*found_spans(text, LOOSE)), row)


def estimate(counts: dict[int, int]) -> tuple[float, list[tuple[float, float]], dict[int, float]]:
    """Dawid-Skene for one kind: prior, (true, false positive rate) per labeler, posterior per vote pattern."""
    prior, rates = 0.5, [(0.8, 0.2)] * len(LABELERS)
    posterior: dict[int, float] = {}
    for _ in range(ROUNDS):
        for votes in counts:
            odds = math.log(prior / (1 - prior))
            for i, (hit, false) in enumerate(rates):
                odds += math.log(hit / false) if votes >> i & 1 else math.log((1 - hit) / (1 - false))
            posterior[votes] = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
        yes = sum(n * posterior[v] for v, n in counts.items())
        no = sum(counts.values()) - yes
        prior = (yes + 1) / (yes + no + 2)
        # Counts of 4 and 1 hold the labelers to being better than chance where data say little.
        rates = [
            ((sum(n * posterior[v] for v, n in counts.items() if v >> i & 1) + 4) / (yes + 5), (sum(n * (1 - posterior[v]) for v, n in counts.items() if v >> i & 1) + 1) / (no + 5))
            for i in range(len(LABELERS))
        ]
    return prior, rates, posterior


def span_classifier(patterns: dict[tuple[int, int, int], int]) -> list[tuple[int, int, int]]:
    """(kind, votes, size) patterns that a logistic regression on EM posteriors accepts."""
    soft: dict[tuple[int, int, int], float] = {}
    for kind in {k for k, _, _ in patterns}:
        votes: dict[int, int] = {}
        for (k, v, _), n in patterns.items():
            if k == kind:
                votes[v] = votes.get(v, 0) + n
        posterior = estimate(votes)[2]
        soft |= {p: posterior[p[1]] for p in patterns if p[0] == kind}

    def features(pattern: tuple[int, int, int]) -> list[int]:
        kind, votes, size = pattern
        return [1, *[votes >> i & 1 for i in range(len(LABELERS))], *[int(size == s) for s in range(LENGTHS)], *[int(kind == k) for k in range(len(KINDS))]]

    rows = [(features(p), n, soft[p]) for p, n in sorted(patterns.items())]
    total = sum(n for _, n, _ in rows) or 1
    weights = [0.0] * (1 + len(LABELERS) + LENGTHS + len(KINDS))

    def chance(x: list[int]) -> float:
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, sum(w * v for w, v in zip(weights, x, strict=True))))))

    for _ in range(STEPS):
        pull = [0.001 * w for w in weights]
        for x, n, y in rows:
            error = (chance(x) - y) * n / total
            pull = [g + error * v for g, v in zip(pull, x, strict=True)]
        weights = [w - 2.0 * g for w, g in zip(weights, pull, strict=True)]
    return [p for p in sorted(patterns) if chance(features(p)) >= 0.5]


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, base and added (arrays of struct<start, kind, end>; kind counts KINDS).

    Places are in code points, end exclusive. Added spans never overlap a base
    span. Missing and empty texts have none. Repeated rows get equal spans
    (and count as often in training); other columns are left aside; an empty
    table gives an empty table.
    """
    text = F.coalesce(F.col("_text"), F.lit(""))
    taken = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text"))
    table = cut(taken.select("doc_id", base_spans(text).alias("base"), candidates(text).alias("loose")))
    voted = table.select(F.explode("loose").alias("c")).groupBy("c.kind", "c.votes", "c.size").count()
    # Kinds times vote patterns times lengths: a fixed number of rows.
    accepted = span_classifier({(r["kind"], r["votes"], r["size"]): r["count"] for r in voted.collect()})
    codes = [(k * 8 + v) * LENGTHS + s for k, v, s in accepted]

    def good(c: Column) -> Column:
        code = (c["kind"] * 8 + c["votes"]) * LENGTHS + c["size"]
        apart = ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
        return code.isin(codes) & apart if codes else F.lit(False)

    added = F.transform(F.filter("loose", good), lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    return table.select("doc_id", "base", added.alias("added"))


def span_text(found: Column) -> Column:
    """kind:start:end, comma-joined, by start and then kind."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(found), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
