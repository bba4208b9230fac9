"""Session settings, and shared scratch tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes shuffle partitions and joins at run time. Postings take several times their
# file size in memory, which the compression factor tells the planner before it picks a side to
# broadcast. The higher IN threshold lets the terms of a long query reach the parquet reader as values
# instead of one min..max range.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.fileCompressionFactor": "8.0",
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    "spark.sql.session.timeZone": "UTC",
}

_local_folders: dict[str, tempfile.TemporaryDirectory] = {}


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the recommended settings to a session builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary folder only for a local master."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not (spark.conf.get("spark.master", None) or "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        app = spark.conf.get("spark.app.id")
        if app not in _local_folders:
            _local_folders[app] = tempfile.TemporaryDirectory(prefix="gleanrank-")
        shared = _local_folders[app].name
    return shared.rstrip("/") + "/gleanrank"


def new_scratch(spark: SparkSession, label: str) -> str:
    """A path under the scratch root that nothing else uses."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write `df` once as parquet and return it read back.

    Later steps read the stored columns, so a lost executor costs a re-read and never a recomputation
    with a different row order.
    """
    spark = df.sparkSession
    path = path or new_scratch(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """Deal the rows of a file scan over all task slots if the scan alone would leave slots idle.

    That is the case for a few unsplittable or small files. A scan that can keep more than half of the
    slots busy is returned as it is, so large inputs are not shuffled.
    """
    slots = scan.sparkSession.sparkContext.defaultParallelism
    splits = scan.rdd.getNumPartitions()
    return scan.repartition(slots) if 2 * splits <= slots else scan


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder made by `new_scratch`."""
    if not path.startswith(scratch_root(spark) + "/"):
        raise ValueError(f"not a scratch folder: {path}")
    drop_folder(spark, path)


def _folder(spark: SparkSession, path: str):
    """Hadoop's handles of a folder and of its file system."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(context._jsc.hadoopConfiguration())


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that our own writers made, if it is there."""
    folder, system = _folder(spark, path)
    system.delete(folder, True)


def rename_folder(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder its final name, which must be free; one step in file systems that rename folders so."""
    folder, system = _folder(spark, path)
    target, _ = _folder(spark, to)
    if system.exists(target) or not system.rename(folder, target):
        raise FileExistsError(f"cannot be renamed to {to}: {path}")


class Scratch:
    """A folder of scratch tables that is deleted when its scope ends.

    `keep` writes a table into the folder and returns it read back. What outlives the scope must not read from it: results
    are written elsewhere, with `materialize`, before the scope ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.path, self._tables = spark, new_scratch(spark, label), 0

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        self._tables += 1
        return materialize(df, label, f"{self.path}/{self._tables}-{label}")

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *problem) -> None:
        drop_scratch(self.spark, self.path)
