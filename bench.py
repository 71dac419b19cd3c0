"""Time the headline queries: prints one JSON line.

Condensed and monthly inputs and base facts are derived from the order lines once (timed as
``inputs`` and ``base_facts``); every query then starts from them, as outputs do in a full run. Each query is executed completely, without a sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.compare import session  # noqa: E402
from checks.queries import QUERIES, base, condensed, monthly  # noqa: E402

HEADLINE = ["temp_invbucket", "fact_inventory", "trailing_sales_24_months", "fact_two_month_inventory",
            "fact_twelve_month_annualized", "fact_two_month_quintile", "fact_inv_mvmt", "fifo",
            "fact_sales_cycle", "fact_sell_thru", "fact_six_month_inventory_by_part", "fact_inv_mvmt_by_part",
            "fact_six_month_quintile_by_part", "fact_sell_thru_by_part"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}

    def timed(name, run):
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("inputs", lambda: [condensed(spark, sf_dir), *(monthly(spark, sf_dir, by_part) for by_part in (False, True))])
    timed("base_facts", lambda: [base(spark, sf_dir, by_part) for by_part in (False, True)])
    for name in HEADLINE:
        timed(name, lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
