"""Results that must not depend on layout, size or skew."""

from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from litwire.functions.fuzzy import indel_ratio
from litwire.operators.joins import lookup_join
from litwire.operators.similarity import similar_pairs
from litwire.sources.landing import read_json


def test_json_per_line_and_per_file(spark, tmp_path):
    rows = [{"id": i, "title": f"t{i}"} for i in range(3)]
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text("\n".join(map(json.dumps, rows)))
    (tmp_path / "files").mkdir()
    for row in rows:
        (tmp_path / "files" / f"{row['id']}.json").write_text(json.dumps(row, indent=2))
    for layout, per_file in (("lines", False), ("files", True)):
        got = read_json(spark, str(tmp_path / layout), "id long, title string", per_file)
        assert sorted((r["id"], r["title"]) for r in got.collect()) == [(i, f"t{i}") for i in range(3)]


def test_titles_of_few_letters_lose_no_pair(spark):
    rng = random.Random(1)
    titles = ["a" * n for n in (400, 398, 410, 300)]
    for _ in range(6):
        title = [rng.choice("ab") for _ in range(rng.randrange(300, 700))]
        titles.append("".join(title))
        for _ in range(8):
            title[rng.randrange(len(title))] = rng.choice("abc")
        titles.append("".join(title))
    table = spark.createDataFrame([(0, i, t) for i, t in enumerate(sorted(set(titles)))], "block int, ord long, norm string")
    every = table.alias("a").join(table.alias("b"), F.col("a.ord") < F.col("b.ord"))
    scored = every.select(F.col("a.ord").alias("a"), F.col("b.ord").alias("b"), indel_ratio(F.col("a.norm"), F.col("b.norm")).alias("s")).collect()
    for threshold in (84, 94, 97):
        expected = {(r["a"], r["b"]) for r in scored if r["s"] >= threshold}
        assert {(r["a"], r["b"]) for r in similar_pairs(table, threshold).collect()} == expected
        assert expected


def test_hot_key_that_the_lookup_lacks_is_dealt_out(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") < 900, "missing").when(F.col("id") < 950, F.concat(F.lit("k"), F.col("id"))).alias("key"))
    lookup = spark.createDataFrame([("k901", 1), ("k902", 2)], "key string, v int")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(rows, lookup, "key", hot_rows=100)
        assert sorted(r["v"] for r in joined.where("v is not null").collect()) == [1, 2]
        loads = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(loads) == 1000 and max(loads) < 300
