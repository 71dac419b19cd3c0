"""One run as one publication: readers see all tables of a run or none of them.

Data files are never changed. A run writes each of its tables below ``<root>/<table>/RUN=<run>/DEAL_ID=<deal>/``, where no
reader looks yet, and then adds one small manifest, ``<root>/_published/<version>.json``, which says per
table which run holds each deal. Readers take the manifest with the highest version, so the one file's appearance
publishes the run as a whole; a run that fails before changes nothing but leaves folders that
``remove_unpublished`` deletes. A re-run of a deal names its new folders in place of the old.

A manifest is written aside and renamed to its version, which fails if another run has taken that version
meanwhile; the later run then reads that manifest and tries the next, so no run's deals get lost. Manifests hold
one entry per table and deal, never rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocklens.functions.semantics import DEAL
from stocklens.sources.staging import _hadoop_path, delete, folders

RUN, MANIFESTS, DIGITS = "RUN", "_published", 12


def _manifest_files(spark: SparkSession, root: str) -> list[str]:
    hadoop, store = _hadoop_path(spark, f"{root.rstrip('/')}/{MANIFESTS}")
    if not store.exists(hadoop):
        return []
    names = [s.getPath().getName() for s in store.listStatus(hadoop)]
    return sorted(n for n in names if n.endswith(".json") and not n.startswith((".", "_")))


def manifest(spark: SparkSession, root: str) -> dict:
    """The newest manifest: ``version`` and, per table, its ``schema`` and the run of each deal in ``deals``."""
    found = _manifest_files(spark, root)
    if not found:
        return {"version": 0, "tables": {}}
    hadoop, store = _hadoop_path(spark, f"{root.rstrip('/')}/{MANIFESTS}/{found[-1]}")
    stream = store.open(hadoop)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def _swap(spark: SparkSession, root: str, content: dict) -> bool:
    """Publish ``content`` as its version; False if that version is taken."""
    folder = f"{root.rstrip('/')}/{MANIFESTS}"
    aside, store = _hadoop_path(spark, f"{folder}/.{uuid.uuid4().hex}")
    final, _ = _hadoop_path(spark, f"{folder}/{content['version']:0{DIGITS}d}.json")
    if store.exists(final):
        return False
    stream = store.create(aside, False)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    if store.rename(aside, final):
        return True
    store.delete(aside, False)
    return False


def write_run(tables: Mapping[str, DataFrame], root: str, deals: Iterable[int] | None = None) -> str:
    """Write and publish ``tables`` as one run; its name.

    ``deals`` are those of the run: one without rows in a table is empty there from now on. Without it only deals
    that have rows in a table are replaced in it. Each table is computed once: which deals it holds is read off its folders. The
    rebalance gathers a deal into few files and lets the adaptive planner split a deal too large for one task.
    """
    root, run = root.rstrip("/"), uuid.uuid4().hex
    held: dict[str, list[int]] = {}
    for name, df in tables.items():
        path = f"{root}/{name}/{RUN}={run}"
        df.hint("rebalance", DEAL).write.partitionBy(DEAL).parquet(path)
        parts = [p.rsplit("/", 1)[-1] for p in folders(df.sparkSession, path)]
        held[name] = [int(p.split("=")[1]) for p in parts if p.startswith(f"{DEAL}=") and not p.endswith("__HIVE_DEFAULT_PARTITION__")]
    publish(tables, root, run, held, deals)
    return run


def publish(tables: Mapping[str, DataFrame], root: str, run: str, held: Mapping[str, Iterable[int]],
            deals: Iterable[int] | None = None) -> None:
    """Make the written folders of ``run`` what readers see."""
    spark = next(iter(tables.values())).sparkSession
    gone = {str(d) for d in deals or ()}
    while True:
        now = manifest(spark, root)
        for name, df in tables.items():
            rest = T.StructType([f for f in df.schema.fields if f.name != DEAL])
            before = now["tables"].get(name, {"schema": None, "deals": {}})
            kept = {d: r for d, r in before["deals"].items() if d not in gone}
            now["tables"][name] = {"schema": _merged(before["schema"], rest), "deals": kept | {str(d): run for d in held[name]}}
        now["version"] += 1
        if _swap(spark, root, now):
            return


def _merged(before: dict | None, schema: T.StructType) -> dict:
    """A table's columns over its runs: those of this run, then those that only earlier ones had."""
    fields = list(schema.fields)
    if before is not None:
        have = set(schema.names)
        fields += [f for f in T.StructType.fromJson(before).fields if f.name not in have]
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields]).jsonValue()


def read_published(spark: SparkSession, root: str, name: str, now: dict | None = None) -> DataFrame:
    """A table as the newest manifest (or ``now``) has it; DEAL_ID prunes folders.

    To read several tables of one state, pass the same manifest to each call.
    """
    root = root.rstrip("/")
    entry = (now or manifest(spark, root))["tables"][name]
    schema = T.StructType.fromJson(entry["schema"]).add(DEAL, "long")
    paths = [f"{root}/{name}/{RUN}={run}/{DEAL}={deal}" for deal, run in sorted(entry["deals"].items())]
    if not paths:
        return spark.createDataFrame([], schema)
    df = spark.read.option("basePath", f"{root}/{name}").schema(T.StructType([*schema.fields, T.StructField(RUN, T.StringType())])).parquet(*paths)
    return df.select(*schema.names)


def is_published(spark: SparkSession, root: str, name: str) -> bool:
    return name in manifest(spark, root)["tables"]


def remove_unpublished(spark: SparkSession, root: str) -> list[str]:
    """Delete the folders of runs and deals that the newest manifest doesn't name; call it while no run writes and no old state is read."""
    root, now, gone = root.rstrip("/"), manifest(spark, root), []
    for name, entry in now["tables"].items():
        live = {f"{RUN}={run}/{DEAL}={deal}" for deal, run in entry["deals"].items()}
        for run in folders(spark, f"{root}/{name}"):
            for part in folders(spark, run):
                place = "/".join(part.rsplit("/", 2)[1:])
                if place not in live:
                    delete(spark, part)
                    gone.append(f"{name}/{place}")
            if not folders(spark, run):
                delete(spark, run)
    return gone
