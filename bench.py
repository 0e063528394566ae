"""Time the queries: one JSON line with the seconds of each.

``BENCH_SF_DIR`` (default sf0.1), ``BENCH_CPUS`` (default 8) and ``BENCH_QUERIES``
(comma-separated names, default: all) choose what runs. Results are computed in full
and thrown away by Spark's noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.catalogue import QUERIES
from tidemark.session import build_session


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = build_session(
        "tidemark-bench",
        master=f"local[{cpus}]",
        settings={
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["fact_sales"](spark, folder).limit(1).collect()  # warm the JVM up
    seconds = {}
    for name in names:
        begun = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begun, 3)
        print(f"{name}: {seconds[name]}s", file=sys.stderr, flush=True)
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total seconds of all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
