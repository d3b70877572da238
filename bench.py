"""Prints one JSON line with the seconds of the headline plans at $BENCH_SF_DIR on local[$BENCH_CPUS]."""

from __future__ import annotations

import json
import os
import time

from citymill.plans import catalog
from citymill.session import local_session

HEADLINE = (
    "obj_bbox_per_file",
    "obj_parse_strict",
    "obj_parse_lenient",
    "tile_mesh_stats",
    "tile_selected",
    "tile_powerset",
    "pairs_buildings",
    "change_new_names",
    "cloud_rotate_y",
    "cloud_normalize_crop",
    "footprint_worst_coord",
    "voxel_footprint",
    "mesh_watertight",
    "connected_components",
    "bottom_contour",
    "fps_sample",
    "surface_sample",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, cores)
    seconds = {}
    for name in HEADLINE:
        best = None
        for _ in range(2):  # the first run compiles code
            began = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - began
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    print(json.dumps({"metric": "headline_plans_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
