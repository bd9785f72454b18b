"""Seconds per query at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``, as one JSON line.

Every query is planned, run and written to the no-op sink, so that all rows and
columns are computed and none reach the driver. ``$BENCH_QUERIES`` (comma-separated)
narrows the list.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from regforge.session import local_session  # noqa: E402
from workloads.queries import QUERIES  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
    wanted = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name] or list(QUERIES)
    spark = local_session(cpus)
    # Start-up of the JVM and of the Python workers is not a property of a query.
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    QUERIES["batch_score"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    scale = os.path.basename(folder).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
