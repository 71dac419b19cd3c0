"""A run is seen as a whole or not at all."""

import uuid

import pytest
from pyspark.sql import functions as F

from stocklens.sources import published
from stocklens.sources.readers import read_output
from stocklens.sources.staging import folders, shared_folder


@pytest.fixture
def root(spark):
    return f"{shared_folder(spark)}/published-{uuid.uuid4().hex}"


def table(spark, rows):
    return spark.createDataFrame(rows, "DEAL_ID long, A string, B double")


def state(spark, root, *names):
    return {n: sorted(tuple(r) for r in read_output(spark, root, n).select("DEAL_ID", "A", "B").collect()) for n in names}


def test_run_that_fails_half_way_changes_nothing(spark, root):
    first = {"X": table(spark, [(1, "a", 1.0), (2, "b", 2.0)]), "Y": table(spark, [(1, "y", 0.5)])}
    published.write_run(first, root, [1, 2])
    before = state(spark, root, "X", "Y")
    bad = table(spark, [(1, "late", 9.0)]).withColumn("B", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        published.write_run({"X": table(spark, [(1, "new", 3.0)]), "Y": bad}, root, [1])
    assert state(spark, root, "X", "Y") == before
    assert len(folders(spark, f"{root}/X")) == 2  # X's new folder is there, unseen
    removed = published.remove_unpublished(spark, root)
    assert any(x.startswith("X/") for x in removed) and state(spark, root, "X", "Y") == before


def test_rerun_replaces_deals_and_empties_those_without_rows(spark, root):
    published.write_run({"X": table(spark, [(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)])}, root)
    published.write_run({"X": table(spark, [(1, "A", 1.5), (1, "AA", 1.6)])}, root, [1, 2])
    assert state(spark, root, "X")["X"] == [(1, "A", 1.5), (1, "AA", 1.6), (3, "c", 3.0)]
    published.write_run({"X": table(spark, []), "Z": table(spark, [])}, root, [1, 3])
    assert state(spark, root, "X", "Z") == {"X": [], "Z": []}
    assert published.remove_unpublished(spark, root) and state(spark, root, "X") == {"X": []}


def test_reader_keeps_one_state_over_a_later_run(spark, root):
    published.write_run({"X": table(spark, [(1, "a", 1.0)]), "Y": table(spark, [(1, "y", 1.0)])}, root, [1])
    now = published.manifest(spark, root)
    published.write_run({"X": table(spark, [(1, "b", 2.0)]), "Y": table(spark, [(1, "z", 2.0)])}, root, [1])
    old = [published.read_published(spark, root, n, now).first()["A"] for n in ("X", "Y")]
    assert old == ["a", "y"] and [read_output(spark, root, n).first()["A"] for n in ("X", "Y")] == ["b", "z"]


def test_version_taken_meanwhile(spark, root, monkeypatch):
    published.write_run({"X": table(spark, [(1, "a", 1.0)])}, root, [1])
    swap, stolen = published._swap, []

    def taken(spark, root, content):
        if not stolen:  # another run publishes deal 2 just before
            stolen.append(1)
            published.write_run({"X": table(spark, [(2, "b", 2.0)])}, root, [2])
        return swap(spark, root, content)

    monkeypatch.setattr(published, "_swap", taken)
    published.write_run({"X": table(spark, [(3, "c", 3.0)])}, root, [3])
    assert [r[1] for r in state(spark, root, "X")["X"]] == ["a", "b", "c"]
    assert published.manifest(spark, root)["version"] == 3


def test_columns_that_a_later_run_adds(spark, root):
    published.write_run({"X": table(spark, [(1, "a", 1.0)])}, root, [1])
    published.write_run({"X": table(spark, [(2, "b", 2.0)]).withColumn("C", F.lit(7)).drop("B")}, root, [2])
    got = {r["DEAL_ID"]: r.asDict() for r in read_output(spark, root, "X").collect()}
    assert got[1] == {"A": "a", "C": None, "B": 1.0, "DEAL_ID": 1} and got[2] == {"A": "b", "C": 7, "B": None, "DEAL_ID": 2}
