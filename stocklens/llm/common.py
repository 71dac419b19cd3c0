"""What several operators share: word rules, staged tables, numbering, connected components."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words between blanks, as regular expression for Spark and DuckDB.
WORD = r"[^\x20\x09-\x0D]+"
#: Words of letters, digits and anything beyond ASCII (after lower-casing A-Z).
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_kept = set(range(128, 256)) | set(range(48, 58)) | set(range(97, 123))
FOLD_ALNUM = bytes(c if c in _kept else 32 for c in FOLD)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased words between the ASCII blanks; none for a null text."""
    return text.translate(FOLD).split() if text else []


def alnum_words(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD_ALNUM).split() if text else []


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def utf8(text: Column) -> Column:
    return text.cast("binary")


def shared_folder(spark: SparkSession) -> str:
    """Folder of ``spark.checkpoint.dir``, which all executors share; the warehouse where that is unset."""
    folder = (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
              or spark.conf.get("spark.sql.warehouse.dir"))
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the folder of a staged table that no later plan reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for file in df.inputFiles()[:1]:
        path = jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True for rows that no model learns from: crc32 of the id's text has this remainder."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))


def numbered(df: DataFrame, order: list[Column], name: str, group: list[str] | None = None,
             weight: str | None = None) -> DataFrame:
    """Add ``_rank`` (from 1) over all rows or per group, and ``_before`` (weight of earlier rows).

    Rows are dealt by range, so a group is spread over tasks however large it is; each task numbers
    its own rows, and one row per task and group gives the offsets. The two passes read the same
    staged rows, so the result doesn't hang on the partitioning.
    """
    from pyspark.sql import Window
    group = group or []
    weight_col = F.col(weight) if weight else F.lit(0)
    dealt = staged(df.repartitionByRange(*[F.col(g) for g in group], *order)
                   .withColumn("_part", F.spark_partition_id()), name)
    inside = Window.partitionBy("_part", *group).orderBy(*order)
    totals = dealt.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_rows"), F.sum(weight_col).alias("_weight"))
    earlier = (Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = totals.select("_part", *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
                            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows0"),
                            F.coalesce(F.sum("_weight").over(earlier), F.lit(0)).alias("_weight0"))
    ranked = dealt.withColumns({
        "_rank": F.row_number().over(inside).cast("long"),
        "_before": F.coalesce(F.sum(weight_col).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    on = [ranked["_part"] == offsets["_part"]] + [ranked[g].eqNullSafe(offsets[f"_g{i}"]) for i, g in enumerate(group)]
    return ranked.join(offsets, on).select(
        *df.columns, (F.col("_rank") + F.col("_rows0")).alias("_rank"),
        (F.col("_before") + F.col("_weight0")).alias("_before"))


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b): the smallest node each can reach.

    Large-star and small-star steps in turn (Kiveris et al. 2014) until every node has one target that has none
    itself. Each edge becomes one edge, so their number never grows, and the rounds are logarithmic in
    practice. A star step needs the smallest neighbour of a node, which is combined map-side, and a join back
    to it, which can be split. Repeated edges do no harm, so no step makes them distinct.
    """
    now, mine = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), None
    while True:
        targets = now.select(F.col("a").alias("node"), F.col("b").alias("to")).unionAll(
            now.select(F.col("b"), F.lit(None).cast("long"))).groupBy("node").agg(
            F.min("to").alias("to"), F.max("to").alias("_hi"), F.count_if(F.col("to").isNull()).alias("_met"))
        if targets.where("to is not null and (to < _hi or _met > 0)").isEmpty():
            return targets.select("node", F.coalesce("to", "node").alias("component"))
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") != F.col("m"), F.col("b")).otherwise(F.col("a")).alias("a"),
                                            F.col("m").alias("b"))
        last, now = mine, staged(small, f"{name}-edges")
        if last is not None:
            drop_staged(last)
        mine = now


def pieces(batch, size: int = 1 << 20):
    """(first column, texts of the second) of an Arrow batch, in runs of about ``size`` bytes of text."""
    ids, texts, held = [], [], 0
    for i, text in zip(batch.column(0), batch.column(1)):
        ids.append(i.as_py())
        texts.append(text.as_py())
        held += len(texts[-1] or b"") + 64
        if held > size:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit keys (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
