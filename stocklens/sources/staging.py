"""Cutting a plan by writing it to the shared folder the cluster names."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A broadcast table in memory takes several times its Parquet size.
GROWTH = 4
#: Compressed; rows take some six times as much in memory, once to be sorted and once more to be shuffled on.
SHUFFLED_BYTES = 32 << 20


def shared_folder(spark: SparkSession) -> str:
    """Folder of ``spark.checkpoint.dir``, which all executors share; the warehouse where that is unset."""
    folder = (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
              or spark.conf.get("spark.sql.warehouse.dir"))
    return folder.rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """Where this application stages its tables."""
    return f"{shared_folder(spark)}/stocklens/{spark.sparkContext.applicationId}"


def _hadoop_path(spark: SparkSession, path):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    hadoop, store = _hadoop_path(spark, path)
    store.delete(hadoop, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Paths of the folders within a folder, in order of their names; none where it doesn't exist."""
    hadoop, store = _hadoop_path(spark, path)
    if not store.exists(hadoop):
        return []
    return sorted(s.getPath().toString() for s in store.listStatus(hadoop) if s.isDirectory())


def _table_prefix(spark: SparkSession) -> str:
    """How this application's bucketed tables begin in the session's catalog."""
    return f"stocklens_{re.sub(r'[^0-9a-z]', '_', spark.sparkContext.applicationId.lower())}_"


def remove_staged(spark: SparkSession) -> None:
    """Delete what this application has staged; call it when its outputs are written."""
    for table in spark.catalog.listTables(pattern=f"{_table_prefix(spark)}*"):
        spark.sql(f"DROP TABLE IF EXISTS `{table.name}`")
    delete(spark, run_folder(spark))


def stage(df: DataFrame, name: str, row_group_bytes: int | None = None, by: Sequence[str] = (), buckets: int = 0) -> DataFrame:
    """Write ``df`` as Parquet and read it back.

    Later steps then read only the columns they need, and a lost executor re-reads a file instead
    of recomputing the whole lineage. ``row_group_bytes`` lets readers split the files that finely.
    With ``by``, rows are stored in ``buckets`` buckets by these columns; what groups, joins or stacks tables by them then moves no rows.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if by:
        return _in_buckets(df, path, by, buckets)
    writer = df.write.option("parquet.block.size", row_group_bytes) if row_group_bytes else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _in_buckets(df: DataFrame, path: str, by: Sequence[str], buckets: int) -> DataFrame:
    """``df`` as a bucketed table of the session, its files in ``path``.

    The key columns are stored under other names. Renamed on reading they are new columns, in which a union of two such tables
    recognises that both are spread alike; under their own names it doesn't, and its rows would be shuffled again.
    """
    spark, stored = df.sparkSession, {c: f"by_{c}" for c in by}
    table = f"{_table_prefix(spark)}{uuid.uuid4().hex}"
    rows = df.withColumnsRenamed(stored).repartition(buckets, *stored.values())
    rows.write.format("parquet").option("path", path).bucketBy(buckets, *stored.values()).sortBy(*stored.values()).saveAsTable(table)
    return spark.table(table).select(*[F.col(f"`{stored.get(c, c)}`").alias(c) for c in df.columns])


def bucket_count(df: DataFrame, bytes_each: int) -> int:
    """Buckets for rows made from the files that ``df`` reads, of ``bytes_each`` of these each; one per core at least."""
    spark = df.sparkSession
    uri = spark.sparkContext._jvm.java.net.URI  # files are listed with their paths encoded
    size = sum(store.getFileStatus(path).getLen() for path, store in (_hadoop_path(spark, uri(f)) for f in df.inputFiles()))
    return max(-(-size // bytes_each), spark.sparkContext.defaultParallelism)


@contextmanager
def _setting(spark: SparkSession, key: str, value: int) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def small_splits(spark: SparkSession, most: int) -> AbstractContextManager[None]:
    """Jobs run within read files in splits of at most ``most`` bytes; the session's own bound holds where it is lower.

    A split of compact rows whose groups are nearly all distinct fills a map-side combine's table with
    as many rows, which spills once that is beyond the task's memory, however many tasks there are.
    """
    own = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return _setting(spark, "spark.sql.files.maxPartitionBytes", min(own, most))


@contextmanager
def shuffled_into(spark: SparkSession, partitions: int) -> Iterator[None]:
    """Jobs run within shuffle into as many partitions as stored buckets, so that what moves joins them without moving those.

    Where a task reads several of them, it reads ``SHUFFLED_BYTES`` at most, so that its sort and what it shuffles on stay in
    memory; the session's own bound holds where it is lower.
    """
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    own = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(size))
    with _setting(spark, "spark.sql.shuffle.partitions", partitions), _setting(spark, size, min(own, SHUFFLED_BYTES)):
        yield


def small_side(df: DataFrame, name: str, max_bytes: int | None = None) -> DataFrame:
    """Store a per-deal or per-deal-and-month table, and broadcast it if its size allows.

    Left alone, the planner shuffles the large side of such a join before it learns that this one
    is small. The size is that of the written files, so it costs no further job; the bound is
    ``spark.sql.autoBroadcastJoinThreshold``. Above it the join shuffles both sides, and adaptive
    skew handling splits a large deal.
    """
    spark = df.sparkSession
    stored = stage(df, name)
    if max_bytes is None:
        max_bytes = int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    files = stored.inputFiles()
    size = 0
    if files:
        hadoop, store = _hadoop_path(spark, files[0])
        size = store.getContentSummary(hadoop.getParent()).getLength()
    return F.broadcast(stored) if size * GROWTH <= max_bytes else stored
