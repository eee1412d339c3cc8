"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR picks the tables (default sf0.1), BENCH_CPUS the local cores (default 8).
Every query is run to its end with all columns, without collecting the rows.
"""

from __future__ import annotations

import contextlib
import json
import os
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from sparkmart.plans.queries import QUERIES  # noqa: E402
from sparkmart.session import local_session  # noqa: E402

HEADLINE = (
    "conform_types",
    "conform_rejects",
    "csv_landing",
    "hwm_window",
    "bronze_accumulate",
    "silver_enriched",
    "silver_null_policy",
    "units_by_year_branch",
    "path_sql_scan",
    "dim_members",
    "surrogate_keys_initial",
    "surrogate_keys_incremental",
    "scd1_upsert_branch",
    "dim_branch",
    "dim_dealer",
    "dim_model",
    "dim_date",
    "fact_sales",
    "fact_upsert",
    "merge_conflicts",
    "two_load_star",
    "two_load_grain",
    "layer_counts",
    "dq_date_id",
    "dq_key_integrity",
    "dealer_performance",
    "branch_performance",
    "model_trend",
    "revenue_growth",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    names = sys.argv[1:] or HEADLINE
    with contextlib.redirect_stdout(sys.stderr):
        spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
        spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.format("noop").mode("overwrite").save()
        seconds = {}
        for name in names:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
            print(name, seconds[name], flush=True)
        spark.stop()
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
