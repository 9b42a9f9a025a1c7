"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from keyscout.checks.queries import QUERIES  # noqa: E402
from keyscout.session import local_session  # noqa: E402

HEADLINE = [
    "value_histogram", "profile_table", "length_moments", "distinct_count", "key_cooccurrence",
    "latest_per_key", "trimmed_key_join", "inclusion_unary", "inclusion_nary", "check_fd", "pair_fd",
    "discover_fds_l1", "candidate_keys", "discover_pk", "discover_fk", "discover_joint_fk",
    "same_fields_fd", "dim_division",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("keyscout-bench", cpus=os.environ.get("BENCH_CPUS", "8"))
    wanted = sys.argv[1:] or HEADLINE
    spark.range(1000).selectExpr("id % 7 AS k", "id").groupBy("k").count().collect()
    seconds = {}
    for name in wanted:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(f"{name}: {seconds[name]}s", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": Path(folder).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
