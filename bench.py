"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import contextlib
import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerloom.plans import load_all  # noqa: E402
from ledgerloom.plans.registry import QUERIES  # noqa: E402
from ledgerloom.session import build_session, drop_scratch  # noqa: E402

#: Runs of each query; their median counts.
RUNS = 3

HEADLINE = [
    "agg_group_sum_count",
    "agg_count_distinct",
    "agg_multi_level",
    "join_inner",
    "join_time_proximity",
    "join_asof_last",
    "join_recursive_chain",
    "reshape_rank_to_wide",
    "win_row_number_latest",
    "win_last_value_ffill",
    "win_rolling_rows",
    "win_sequence_offset",
    "dml_merge_conditional",
    "dml_cdc_latest_state",
    "dml_rebuild_partitioned",
    "cmp_row_diff",
    "cmp_counts",
    "recon_two_sided",
    "src_fixed_width_copybook",
    "sink_header_trailer",
    "app_points_by_period",
    "app_feature_timeseries",
    "app_cumulative_flow",
    "app_aml_transaction_feed",
    "app_statement_sequence",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    with contextlib.redirect_stdout(sys.stderr):
        spark = build_session(
            "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g"
        )
        spark.sparkContext.setLogLevel("ERROR")
        load_all()
        # start the executor threads and the Parquet reader once, outside the measured time
        QUERIES["agg_global"](spark, folder).write.format("noop").mode("overwrite").save()
        seconds = {}
        for name in names:
            runs = []
            for _ in range(RUNS):
                start = time.perf_counter()
                QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - start)
            seconds[name] = round(statistics.median(runs), 3)
            drop_scratch(spark)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
