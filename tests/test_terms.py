"""Dictionaries and plans of any size against texts, compared with looking for every term in every text."""

from __future__ import annotations

import random

import pytest

from litwire.operators import terms as term_index
from litwire.operators.relevance import relevance
from litwire.plans.query_plan import match_plan

WORDS = ["alpha", "beta", "gamma", "Δέλτα", "汉坦病毒", "ab", "x", "naïve", "virus", "viruses", "the", "of", "😀😀"]


def random_records(seed: int, count: int) -> list[tuple]:
    rng = random.Random(seed)

    def line(most):
        return " ".join(rng.choice(WORDS) for _ in range(rng.randrange(most)))

    rows = [(rng.choice([None, 1, i, i]), line(5), line(60)) for i in range(count)]
    rows += [(7, None, None), (7, "", ""), (None, "virus", None), (9, "same", "virus " * 20_000)]
    return rows + [(8, "the virus", "copy of beta")] * 300


def plain_hits(rows, terms):
    out = []
    for rid, title, body in rows:
        title, body = (" ".join((t or "").lower().split()) for t in (title, body))
        for profile, names in terms.items():
            found = [sum(t.lower() in text for t in {n.lower() for n in names}) for text in (title, body)]
            if sum(found):
                out.append((rid, profile, *found))
    return sorted(out, key=repr)


@pytest.mark.parametrize("more", [0, 3000])
def test_hits_equal_plain_search_at_every_size(spark, more):
    rng = random.Random(4)
    rows = random_records(1, 150)
    terms = {"p": ["alpha", "Beta", "virus", "viru", "病毒汉坦病", "汉坦病毒"], "q": ["gamma the", "naïve", "of beta", "😀😀 v"]}
    for i in range(more):  # terms that share grams with those that occur
        terms.setdefault(f"r{i % 3}", []).append("virus" + str(rng.randrange(10**6)))
    records = spark.createDataFrame(rows, "record_id long, title string, abstract string")
    dictionary = spark.createDataFrame([(p, t) for p, names in terms.items() for t in names + [None, "", "abc"]], "profile_id string, term string")
    got = relevance(records, dictionary).collect()
    assert sorted(((r["record_id"], r["profile_id"], r["title_hits"], r["body_hits"]) for r in got), key=repr) == plain_hits(rows, terms)


def test_empty_dictionary_and_no_records(spark):
    records = spark.createDataFrame([(1, "alpha", "beta")], "record_id long, title string, abstract string")
    terms = spark.createDataFrame([("p", "alpha")], "profile_id string, term string")
    assert relevance(records, terms.limit(0)).collect() == []
    assert relevance(records.limit(0), terms).collect() == []


def test_a_full_bit_field_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(term_index, "FIELD_BITS", 64)
    records = spark.createDataFrame([(1, "alpha", "beta"), (2, "a", "be")], "record_id long, title string, abstract string")
    terms = spark.createDataFrame([("p", "alpha"), ("p", "beta")] + [("q", f"word{i}") for i in range(200)], "profile_id string, term string")
    assert [(r["record_id"], r["title_hits"], r["body_hits"]) for r in relevance(records, terms).collect()] == [(1, 1, 1)]


@pytest.mark.parametrize("negatives", [True, False])
def test_plans_equal_plain_search(spark, negatives):
    rng = random.Random(5)
    schema = "profile_id string, group_id string, terms array<string>, topics array<string>, negatives array<string>"
    plan = [("p", f"g{i}", rng.sample(WORDS, 2), rng.sample(WORDS, i % 3), rng.sample(WORDS, i % 2)) for i in range(60)]
    plan += [("p", "g0", ["x"], [], []), ("p", "none", ["zzz"], [], []), (None, "null", ["Alpha"], [], None), ("p", "empty", [], ["the"], [])]
    texts = [(r[0], r[2]) for r in random_records(2, 80)]

    def holds(text, terms):
        return any(t.lower() in (text or "").lower() for t in terms or [])

    expected = sorted(
        ((rid, p, g) for rid, text in texts for p, g, terms, topics, minus in plan if holds(text, terms) and (not topics or holds(text, topics)) and not (negatives and holds(text, minus))),
        key=repr,
    )
    records = spark.createDataFrame(texts, "record_id long, text string")
    got = match_plan(records, spark.createDataFrame(plan, schema), records["text"], negatives)
    assert sorted(map(tuple, got.select("record_id", "profile_id", "group_id").collect()), key=repr) == expected
    assert match_plan(records, spark.createDataFrame([], schema), records["text"], negatives).collect() == []


def test_terms_that_share_short_runs_are_no_candidates(spark):
    terms = spark.createDataFrame([("interdisciplinary",), ("disciplinary",)], "term string")
    texts = spark.createDataFrame([("interdiscip and disciplinary",)], "text string")  # holds every run of four characters of both
    found = term_index.candidate_terms(texts.select(*term_index.text_key(texts["text"]), "text"), terms).collect()
    assert [r["term"] for r in found] == ["disciplinary"]
