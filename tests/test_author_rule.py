"""The author rule of the title pass, against the loop over records in order."""

import random

import pytest

from litwire import fixed
from litwire.functions.fuzzy import _ratios
from litwire.operators.cluster import leader_clusters
from litwire.operators.merge import dedup_papers


def in_order(rows):
    """ord to leader: leaders keep an author, their own or the first that a follower brings."""
    leaders, out = [], {}
    for ord_, norm, author in rows:
        out[ord_] = ord_
        for leader in leaders:
            if _ratios([norm], [leader["norm"]])[0] < fixed.PAPER_TITLE_RATIO:
                continue
            if not author or not leader["author"] or _ratios([author], [leader["author"]])[0] >= fixed.AUTHOR_RATIO:
                leader["author"] = leader["author"] or author
                out[ord_] = leader["ord"]
                break
        if out[ord_] == ord_:
            leaders.append({"ord": ord_, "norm": norm, "author": author})
    return out


@pytest.mark.parametrize("seed", range(2))
def test_adopted_authors_equal_the_sequential_loop(spark, seed):
    rng = random.Random(seed)
    authors, rows, seen = ["", "", "smith ann", "smyth ann", "lee bo", "garcia"], [], set()
    bases = ["".join(rng.choice("abcdefgh ") for _ in range(60)) for _ in range(3)]
    while len(rows) < 60:
        title = list(rng.choice(bases))
        for _ in range(rng.randrange(3)):
            title[rng.randrange(60)] = rng.choice("xyz")
        row = ("".join(title), rng.choice(authors))
        if row not in seen:
            seen.add(row)
            rows.append((len(rows), *row))
    table = spark.createDataFrame([(0, *r) for r in rows], "block int, ord long, norm string, author string")
    for small in (2_000, 15):  # at once, and by prefixes of the order
        got = leader_clusters(table, fixed.PAPER_TITLE_RATIO, budget=2_000 if small == 15 else None, small=small)
        assert {r["ord"]: r["leader"] for r in got.collect()} == in_order(rows)


def test_a_group_is_known_by_the_first_author_that_it_names(spark):
    title = "a long title about one thing and nothing else in the world"
    rows = [
        ("1", 1, "A", "10.1/x", title, []),
        ("2", 2, "A", "10.1/x", title, ["", "Ann Smith"]),
        ("3", 3, "B", "10.1/y", title + "s", ["Bo Lee"]),
        ("4", 4, "C", None, title, ["Ann Smith"]),
    ]
    schema = "record_id string, ord long, source string, doi string, title string, authors array<string>"
    papers = spark.createDataFrame(rows, schema).selectExpr("*", "cast(map() as map<string,string>) as source_ids", "'x' as abstract", "'j' as journal", "cast(array() as array<string>) as publication_types")
    merged = dedup_papers(papers)
    assert {(r["ord"], r["n_records"]) for r in merged.records.collect()} == {(1, 3), (3, 1)}
