"""Shingles that one group alone has are dropped by one shuffle of the prefixes."""

import random

from pyspark.sql import functions as F

from litwire.llm import jaccard


def test_only_shingles_that_meet_are_kept(spark):
    draw = random.Random(4)
    own = [" ".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=40)) for _ in range(30)]
    texts = own + [own[i] + " z y x" for i in range(5)] + [own[0], "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    whole = jaccard.prefixes(docs, "doc_id", "text")
    met = jaccard.met_shingles(whole)
    rows = whole.where("n > 0").select("grp", "n", F.posexplode("prefix").alias("place", "t")).collect()
    groups, early = {}, set()
    for r in rows:
        groups.setdefault(r.t, set()).add(r.grp)
        if r.place * 180 <= r.n * 20:
            early.add(r.t)
    want = sorted((r.grp, r.n, r.place, r.t) for r in rows if len(groups[r.t]) > 1 and r.t in early)
    assert want and len(want) < len(rows)
    assert sorted(tuple(r) for r in met.select("grp", "n", "place", "t").collect()) == want


def test_prefixes_are_deleted_before_classes_are_compared(spark, monkeypatch):
    seen, real = [], jaccard.linked_classes

    def watched(docs, described, met, *more):
        seen.append(described.columns)
        return real(docs, described, met, *more)

    monkeypatch.setattr(jaccard, "linked_classes", watched)
    text = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(1, text), (2, text), (3, "other words")], "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in jaccard.jaccard_components(docs).collect()}
    assert got == {(1, 1), (2, 1), (3, 3)}
    assert seen == [["doc_id", "n", "kind", "grp"]]
