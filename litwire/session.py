"""Session settings and the shared folder for cutting lineage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Shuffle files go when the query that wrote them has ended, not when the driver happens to collect garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: What goes to Python at once: batches hold as many rows as fit, so whole texts and sets do not fill executors beside their heap.
ARROW_BYTES, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("litwire")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, or a local one where none is set (tests)."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        named = tempfile.mkdtemp(prefix="spark-litwire-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers on every executor, and batches for them small, if the session sets no size."""
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, BATCH_BYTES)
    context = spark.sparkContext
    if getattr(context, "_litwire_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="spark-litwire-")) / "litwire.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for file in sorted(root.rglob("*.py")):
            bundle.write(file, Path("litwire") / file.relative_to(root))
    context.addPyFile(str(archive))
    context._litwire_shipped = True


def cut(df: DataFrame, buckets: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written copy.

    Parquet rather than an RDD checkpoint: later reads prune columns, keep
    statistics for join choice, and survive the loss of any executor. With
    ``buckets``, the copy is a table in as many buckets by that column as
    there are shuffle partitions, and joins on it leave it where it is.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "step")
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    # What the write shuffled is of no use once the copy is there.
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        if buckets:
            table = Path(path).name.replace("-", "_")
            count = int(spark.conf.get("spark.sql.shuffle.partitions"))
            df.write.bucketBy(count, buckets).option("path", path).format("parquet").saveAsTable(table)
        else:
            df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    copy = spark.table(table) if buckets else spark.read.schema(df.schema).parquet(path)
    copy._written_to, copy._table = path, table if buckets else None
    return copy


def discard(*copies: DataFrame) -> None:
    """Delete tables that ``cut`` wrote and that no later step reads."""
    for copy in copies:
        context = copy.sparkSession.sparkContext
        if copy._table:
            copy.sparkSession.sql(f"DROP TABLE IF EXISTS {copy._table}")
        path = context._jvm.org.apache.hadoop.fs.Path(copy._written_to)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
