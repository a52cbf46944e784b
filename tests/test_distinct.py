"""The sorted list of words is named once in the plan of ``unique_strings``."""

from pyspark.sql import functions as F

from litwire.functions import text


def test_words_are_sorted_once(spark):
    rows = [(1, ["b", "A", " a ", None, "", "B", "c\n d", "c d", "ß", "SS"]), (2, []), (3, None), (4, [None, " "])]
    frame = spark.createDataFrame(rows, "id long, v array<string>").select("id", text.unique_strings(F.col("v")).alias("u"))
    assert {r.id: r.u for r in frame.collect()} == {1: ["b", "A", "c d", "ß"], 2: [], 3: None, 4: []}
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1
