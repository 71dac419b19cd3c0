import random

import numpy as np
import pyarrow as pa
import pytest

from sample_tables import KEYS, inventory, key, month, sales
from stocklens.operators import dims, fifo

LAST = 30


def _inputs(spark, months=range(LAST + 1), seed=5, skip=()):
    """Three series over the months; series B misses some months that others have."""
    rnd = random.Random(seed)
    inv, sale = {}, {}
    for sku in "ABC":
        for m in months:
            if m in skip or (sku == "B" and m % 7 == 3):
                continue
            inv[sku, m] = (float(rnd.choice([0, 5, 10, 20, 40])), float(rnd.randrange(1, 90)))
            if rnd.random() < 0.8:
                sale[sku, m] = (float(rnd.randrange(-6, 25)), float(rnd.randrange(0, 99)), float(rnd.randrange(0, 50)))
    return (inv, sale, inventory(spark, [(key(s), m, *v) for (s, m), v in inv.items()]),
            sales(spark, [(key(s), m, *v) for (s, m), v in sale.items()]))


def _skus(sale, inv):
    return dims.dim_sku(dims.dim_category(sale, inv), sale, inv)


def _by_hand(inv, sale, sku, last=LAST):
    """Plain step-by-step ledger of one series: step -> layers, newest first (None when absent)."""
    layers, out = [0.0] * 25, {}
    stocked = {m for _, m in inv}
    for step in range(24):
        m = last - 23 + step
        if m not in stocked:
            continue
        if (sku, m) not in inv:
            layers, out[step] = [0.0] * 25, None
            continue
        units, before = inv[sku, m][0], inv.get((sku, m - 1), (0.0,))[0]
        sold, change = sale.get((sku, m), (0.0,))[0], inv[sku, m][0] - before
        adjusted = sold if sold >= 0 else max(change, 0.0)
        received = adjusted + change
        use = -change if units == 0 or received < 0 else adjusted
        receipts = 0.0 if received < 0 or units == 0 else received
        taken, older = [0.0] * 25, 0.0
        for j in range(24, -1, -1):
            if abs(use) > older + layers[j]:
                taken[j] = layers[j]
            else:
                taken[j] = use if j == 24 else max(use - older, 0.0)
            older += layers[j]
        layers = [receipts - (use - sum(taken))] + [layers[j] - taken[j] for j in range(24)]
        out[step] = layers
    return out


@pytest.mark.parametrize("skip", [(), (9, 10, 15)])
def test_ledger_matches_a_plain_loop(spark, skip):
    inv, sale, inv_df, sale_df = _inputs(spark, skip=skip)
    table = fifo.fifo(inv_df, sale_df, _skus(sale_df, inv_df), KEYS)
    got = {(r["TRIM_SKU"], r["STEP"]): [r[f"UNITS_{b}"] for b in fifo.LAYERS] for r in table.collect()}
    for sku in "ABC":
        want = _by_hand(inv, sale, sku)
        assert {s for k, s in got if k == sku} == set(want)
        for step, layers in want.items():
            assert got[sku, step] == (layers if layers is not None else [None] * 25), (sku, step)


def test_units_are_conserved():
    rng = np.random.default_rng(1)
    units = rng.integers(0, 9, (50, 25)).astype(float)
    use, receipts = rng.integers(0, 150, 50).astype(float), rng.integers(0, 40, 50).astype(float)
    sold, aged = fifo.consume(units, use, receipts)
    dropped = units[:, 24] - sold[:, 24]
    assert np.allclose(aged.sum(1) + dropped, units.sum(1) + receipts - use)
    assert (sold <= units).all() and (sold >= 0).all()


def test_result_does_not_depend_on_partitions(spark):
    _, _, inv, sale = _inputs(spark, seed=8)
    skus = _skus(sale, inv)
    pick = [*KEYS, "STEP", "UNITS_0_30", "COST_90_180", "A_0_30_ASQ", "A_30_60GM$A"]
    one = fifo.fifo(inv.coalesce(1), sale.coalesce(1), skus, KEYS).select(*pick).collect()
    many = fifo.fifo(inv.repartition(7), sale.repartition(5), skus, KEYS).select(*pick).collect()
    assert sorted(map(str, one)) == sorted(map(str, many))


def test_many_series_cross_blocks(spark):
    rows = [(key(f"S{i:05d}"), m, float(i % 5 + m % 3), 1.0) for i in range(2 * fifo.BLOCK + 7) for m in range(12)]
    inv = inventory(spark, rows).coalesce(1)
    sale = sales(spark, [(key("S00000"), 3, 1.0, 1.0, 1.0)])
    table = fifo.fifo(inv, sale, _skus(sale, inv), KEYS)
    got = table.groupBy("STEP").count().collect()
    assert {r["STEP"]: r["count"] for r in got} == {s: 2 * fifo.BLOCK + 7 for s in range(12, 24)}


def test_rollup_and_steps(spark):
    _, _, inv, sale = _inputs(spark)
    table = fifo.fifo(inv, sale, _skus(sale, inv), KEYS)
    last = fifo.fifo_step(table, 23)
    assert {r["DATE_KEY"] for r in last.select("DATE_KEY").collect()} == {month(LAST).strftime("%Y%m%d")}
    for r in last.collect():
        if r["UNITS_0_30"] is not None:
            assert r["UNITS_361_540"] == sum(r[f"UNITS_{d}_{d + 30}"] for d in range(360, 540, 30))
            assert r["UNITS_OVER_720"] == r["UNITS_720_750"]


def test_eligibility_needs_twelve_months_without_a_gap(spark):
    def deals(per_deal):
        rows = [(key(deal=d), m, 1.0, 1.0) for d, ms in per_deal.items() for m in ms]
        return {r["DEAL_ID"] for r in fifo.fifo_eligible(inventory(spark, rows)).collect()}

    assert deals({1: range(11), 2: range(12), 3: [m for m in range(14) if m != 6], 4: [0, *range(5, 17)]}) == {2, 4}


def test_a_block_gives_rows_for_flows_only():
    """A thin series of a long calendar costs Python a row per flow, not one per calendar step."""
    flow = pa.struct([("STEP", pa.int32()), *[(c, pa.float64()) for c in fifo.FLOW_COLUMNS]])
    rows = pa.RecordBatch.from_arrays(
        [pa.array([7]), pa.array([list(range(24))], pa.list_(pa.int32())),
         pa.array([[{"STEP": 20, **dict.fromkeys(fifo.FLOW_COLUMNS, 0.0), "USE_RECEIPTS": 5.0}]], pa.list_(flow))],
        names=["SKU_SEQ_ID", "_CALENDAR", "_FLOWS"])
    out = fifo._ledger_block(rows, fifo.FLOW_COLUMNS, ["SKU_SEQ_ID", "STEP", *fifo.FLOW_COLUMNS, "_ASQ", "_UNITS"])
    assert out.num_rows == 1
    assert out.column("STEP").to_pylist() == [20] and out.column("_UNITS").to_pylist()[0][:2] == [5.0, 0.0]
