"""What executors hold beside their heap: batches for Python, and Python workers."""

import pyarrow as pa
from pyspark.sql import functions as F

from litwire.llm import components, lines
from litwire.session import ship_package


def test_batches_of_long_texts_are_small(spark):
    ship_package(spark)

    def measure(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["rows", "bytes"])

    docs = spark.range(2000, numPartitions=1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    got = docs.mapInArrow(measure, "rows long, bytes long").collect()
    assert sum(r.rows for r in got) == 2000
    assert max(r.bytes for r in got) < 8 << 20


def test_components_and_lines_need_no_table_of_python_rows(spark, monkeypatch):
    edges = spark.range(1, 5).select(F.col("id").alias("a"), (F.col("id") + F.when(F.col("id") == 2, 0).otherwise(1)).alias("b"))
    docs = spark.range(3).select(F.col("id").alias("doc_id"), F.lit("a line of many texts").alias("text"))
    real = type(spark).createDataFrame

    def made(self, data, *more, **named):
        assert isinstance(data, pa.Table), "a table of Python rows starts further workers"
        return real(self, data, *more, **named)

    monkeypatch.setattr(type(spark), "createDataFrame", made)
    comps = {(r.node, r.comp) for r in components.connect(edges).collect()}
    assert comps == {(1, 1), (2, 1), (3, 3), (4, 3), (5, 3)}
    assert {(r.doc_id, r.n_dropped) for r in lines.dedup_lines(docs).collect()} == {(0, 0), (1, 1), (2, 1)}
