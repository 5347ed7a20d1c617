"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query is written
to the ``noop`` sink, so all of its result is computed and none of it is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cubeloom import build_session  # noqa: E402
from cubeloom.registry import REGISTRY  # noqa: E402

HEADLINE = (
    "load_collection", "ndvi", "compute_indices", "aggregate_temporal_period_month", "mean_time", "median_time", "reduce_spatial",
    "mask", "mask_polygon", "merge_cubes", "cube_cube_operators", "resample_cube_temporal", "aggregate_spatial",
    "aggregate_spatial_window", "apply_kernel", "slope", "cumsum", "interpolate_time_by_position", "savitzky_golay",
    "climatological_normal", "fit_curve", "apply_datacube", "raster_to_vector", "array_interpolate_linear",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("OFF")
    names = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_suppkey").count().write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
