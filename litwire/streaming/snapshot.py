"""A published table kept up to date by micro-batches, with its versions and what changed in each.

``publish`` gives a function for ``upsert_batches``. Batch N is written as
version N from the versions before it, so a batch that runs again after a
failure writes the same rows. Keys are hashed to buckets; a version holds only
the buckets that its batch touches, and every FULL-th version holds all, so a
reader opens at most FULL versions. A version counts once its write has ended.

Of the rows of a key that with the greatest order stays, ties by content, so
the table depends on the rows that arrived, not on their batches: a late row
counts for its order, a repeated one changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS, FULL = 64, 16
OWN = ("version", "bucket", "content_hash", "changed_in")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions whose write has ended."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/_SUCCESS")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or ())


def _needed(have: list[int], at: int | None) -> list[int]:
    """Versions that hold the state at ``at``: the last full one and those after it."""
    past = [v for v in have if at is None or v <= at]
    start = max((v for v in past if v % FULL == 0), default=0)
    return [v for v in past if v >= start]


def read_snapshot(spark: SparkSession, path: str, at: int | None = None, schema: T.StructType | None = None) -> DataFrame:
    """The rows after version ``at`` (the newest, if not given), with content_hash and changed_in, the version that last changed the content.

    ``schema`` (of these rows) is needed only where no version may hold a row.
    """
    reader = spark.read.option("basePath", path)
    placed = [T.StructField(c, T.IntegerType()) for c in ("version", "bucket")]
    reader = reader if schema is None else reader.schema(T.StructType([*schema.fields, *placed]))
    needed = _needed(versions(spark, path), at)
    if not needed:
        if schema is None:
            raise FileNotFoundError(f"no version in {path}")
        return spark.createDataFrame([], schema)
    rows = reader.parquet(*[f"{path}/version={v}" for v in needed])
    newest = rows.groupBy("bucket").agg(F.max("version").alias("version"))
    # At most one row a bucket, whose number is fixed.
    return rows.join(F.broadcast(newest), ["bucket", "version"]).drop("bucket", "version")


def changed_rows(spark: SparkSession, path: str, version: int) -> DataFrame:
    """Rows that are new in ``version`` or got other content there."""
    return read_snapshot(spark, path, version).where(F.col("changed_in") == version)


def publish(path: str, key: Sequence[str], order: Sequence[str], buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """A sink that keeps one row per ``key``: that with the greatest ``order`` columns (missing ones are smallest).

    Content is all columns but key and order; rows with equal content keep
    ``changed_in``. Missing key values are a value like others. An empty batch
    writes a version without rows. Columns named as OWN are refused.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        clash = set(OWN) & set(batch.columns)
        if clash:
            raise ValueError(f"reserved columns: {sorted(clash)}")
        spark = batch.sparkSession
        names = [f"`{c}`" for c in batch.columns]
        content = [f"`{c}`" for c in batch.columns if c not in (*key, *order)]
        bucket = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in key]), F.lit(buckets)).cast("int")
        hashed = F.sha2(F.to_json(F.struct(*content)) if content else F.lit(""), 256)
        batch = batch.persist()
        try:
            new = batch.select(*names, hashed.alias("content_hash"), F.lit(None).cast("int").alias("changed_in"), bucket.alias("bucket"))
            stored = T.StructType([*batch.schema.fields, T.StructField("content_hash", T.StringType()), T.StructField("changed_in", T.IntegerType())])
            old = read_snapshot(spark, path, batch_id - 1, stored).withColumn("bucket", bucket)
            if batch_id % FULL:
                # At most ``buckets`` rows.
                old = old.join(F.broadcast(new.select("bucket").distinct()), "bucket", "left_semi")
            rows = old.unionByName(new)
            known = F.col("changed_in").isNotNull()
            best = rows.groupBy("bucket", *[f"`{c}`" for c in key]).agg(
                F.max_by(F.struct(*[c for c in names if c.strip("`") not in key], "content_hash"), F.struct(*[f"`{c}`" for c in order], "content_hash")).alias("_best"),
                F.max(F.when(known, F.col("content_hash"))).alias("_before"),
                F.max("changed_in").alias("_since"),
            )
            same = F.col("_best.content_hash").eqNullSafe(F.col("_before"))
            fields = [F.col(f"`{c}`") if c in key else F.col(f"_best.`{c}`") for c in batch.columns]
            out = best.select(*fields, "_best.content_hash", F.when(same, F.col("_since")).otherwise(batch_id).cast("int").alias("changed_in"), "bucket")
            out.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/version={batch_id}")
        finally:
            batch.unpersist()

    return apply
