"""Benchmark: headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion with the ``noop`` sink (the full plan
runs, nothing is collected to the driver). ``full_pipeline`` runs the whole
daily refresh the way a scheduled job would: staging and journeys are
materialised once and every mart, report and model reads them.

Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tributary.plans.session import build_session  # noqa: E402

HEADLINE = (
    "sessions", "conversions", "journeys", "attribution_mart", "cross_channel", "data_driven",
    "purchase_funnel", "path_analysis", "daily_traffic_overview", "roas", "linear_channel",
    "journey_features",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def full_pipeline(spark, sf_dir: str) -> None:
    from tributary.operators import reports
    from tributary.plans.pipeline import Pipeline
    p = Pipeline.from_fixture(spark, sf_dir)
    # the layers that every output reads are written to the shared folder once
    for layer in ("sessions", "conversions", "journeys"):
        p.materialize(layer)
    outs = [p.mart, p.cross_channel, p.funnel, p.abandonment, p.path_analysis, p.traffic,
            reports.paths_dashboard(p.journeys).drop("path"), p.data_driven, p.roas]
    for o in outs:
        run(o)
    p.cleanup()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    folder = tempfile.mkdtemp(prefix="tributary-bench-")  # one machine; a cluster names its own
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app="tributary-bench", shuffle_partitions=max(cpus, 8),
                          extra={"spark.driver.memory": "16g", "spark.checkpoint.dir": folder})
    from tributary.plans.catalog import registry
    q = registry()
    # warm-up on the smallest data set (JIT, codegen caches), not timed
    full_pipeline(spark, os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001"))
    times = {}
    from tributary.plans import catalog
    for name in HEADLINE:
        # every query starts from the raw tables: no stored layer is shared
        # between timed queries
        catalog.release()
        t = time.perf_counter()  # a query's stored layers are part of its time
        run(q[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t, 3)
    catalog.release()
    t = time.perf_counter()
    full_pipeline(spark, sf_dir)
    times["full_pipeline"] = round(time.perf_counter() - t, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    try:
        sf = float(sf)
    except ValueError:
        pass
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()
    shutil.rmtree(folder, ignore_errors=True)


if __name__ == "__main__":
    main()
