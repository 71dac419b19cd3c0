"""A month that came or changed: stored results brought up to date equal a full run."""

import random
import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from sample_tables import KEYS, inventory, key, month, sales
from stocklens.operators import demand, movement, sellthru
from stocklens.plans import append
from stocklens.sources.staging import run_folder

CASES = {"trailing": (lambda i, s: demand.trailing_sales(i, s, KEYS, 3), append.trailing_reach(3)),
         "leads": (lambda i, s: sellthru.lead_sales(i, s, KEYS), append.LEAD_REACH),
         "movement": (lambda i, s: movement.movement_matrix(i, series=KEYS), append.MOVEMENT_REACH)}


def sides(spark, seed, changed):
    """Monthly tables before and after a delivery of the changed months."""
    rnd = random.Random(seed)
    keys = [key(s) for s in "ABCDE"] + [key("A", deal=2)]
    inv = [(k, m, float(rnd.randrange(5)), 10.0 + m) for k in keys for m in range(20) if rnd.random() < 0.8]
    sale = [(k, m, float(rnd.randrange(4)), 5.0, 2.0) for k in keys for m in range(20) if rnd.random() < 0.6]
    fresh = ([(k, m, q + 1, c) for k, m, q, c in inv if m in changed], [(k, m, q + 2, n, c) for k, m, q, n, c in sale if m in changed])
    rest = ([r for r in inv if r[1] not in changed], [r for r in sale if r[1] not in changed])
    old = inventory(spark, [r for r in inv if r[1] not in changed or 19 not in changed]), sales(spark, [r for r in sale if r[1] not in changed or 19 not in changed])
    return old, (inventory(spark, rest[0] + fresh[0]), sales(spark, rest[1] + fresh[1]))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("changed", [[19], [7, 12]])
def test_update_equals_full_run(spark, name, changed):
    compute, reach = CASES[name]
    old, new = sides(spark, 3, changed)
    root = f"{run_folder(spark)}/append-{uuid.uuid4().hex}"
    before = compute(*old)
    append.write_months(before, f"{root}/out", "BOM_INV_DATE")
    stored = []
    for side, m, was, now in zip(("inv", "sale"), ("BOM_INV_DATE", "BEG_MO"), old, new):
        append.write_months(was, f"{root}/{side}", m)
        append.write_months(now, f"{root}/{side}", m, [month(c) for c in changed])
        stored.append((append.read_months(spark, f"{root}/{side}", m, was), m))
    assert rows(stored[0][0]) == rows(new[0].select(*stored[0][0].columns))
    redone, touched = append.recomputed(compute, stored, [month(c) for c in changed], reach)
    append.write_months(redone, f"{root}/out", "BOM_INV_DATE", touched)
    life = append.lifetimes(stored[0][0], stored[1][0], KEYS)
    got = append.with_lifetimes(append.read_months(spark, f"{root}/out", "BOM_INV_DATE", before), life, KEYS)
    assert rows(got) == rows(compute(*new).select(*got.columns))


def test_only_months_in_reach_are_read(spark):
    _, (inv, sale) = sides(spark, 4, [19])
    path = f"{run_folder(spark)}/append-{uuid.uuid4().hex}"
    append.write_months(inv, path, "BOM_INV_DATE")
    stored = append.read_months(spark, path, "BOM_INV_DATE", inv)
    touched = append.touched_months([month(19)], append.trailing_reach(3))
    needed = append.needed_months(touched, append.trailing_reach(3))
    assert (len(touched), len(needed)) == (3, 5)
    part = append.of_months(stored, "BOM_INV_DATE", needed)
    assert "PartitionFilters: [BOM_INV_DATE" in part._jdf.queryExecution().executedPlan().toString()
    assert {r[0] for r in part.select(F.regexp_extract("_metadata.file_path", "BOM_INV_DATE=([0-9-]+)", 1)).distinct().collect()} <= {str(m) for m in needed}


def test_months_of_reach():
    assert append.touched_months([date(2020, 1, 1)], append.LEAD_REACH) == [date(2019, 10, 1), date(2019, 11, 1), date(2019, 12, 1), date(2020, 1, 1)]
    assert append.needed_months([date(2020, 1, 1)], append.trailing_reach(2)) == [date(2019, 12, 1), date(2020, 1, 1)]


def test_merged_lifetimes(spark):
    (inv, sale), _ = sides(spark, 5, [19])
    last = month(15)
    parts = [append.lifetimes(inv.where(w.format("BOM_INV_DATE")), sale.where(w.format("BEG_MO")), KEYS)
             for w in (f"{{}} < date'{last}'", f"{{}} >= date'{last}'")]
    assert rows(append.merged_lifetimes(*parts)) == rows(append.lifetimes(inv, sale, KEYS))
