"""Time the headline queries: one JSON line on stdout.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query
runs to a sink that reads all rows; the derived feature tables and the stored raster are
written before the clock starts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from gridloom.session import local_session

HEADLINE = [
    "convert_layers",
    "convert_layers_tiled",
    "convert_raster",
    "rasterize_polygons",
    "burn_replace",
    "merge_variables",
    "rasterize_points",
    "rasterize_lines",
    "tile_join",
    "codes_first_seen",
    "codes_by_tile",
    "valid_geometries",
    "features_in_circle",
    "majority_features",
    "cells_in_zone",
    "zonal_majority",
    "merge_outer",
    "densify",
    "pack_chunks",
    "write_chunks",
    "compare_stores",
    "index_matches",
    "check_conversion",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    from catalog import fixtures
    from catalog.queries import CHUNK, QUERIES

    names = sys.argv[1:] or HEADLINE
    fixtures.polygons(spark, sf_dir).count()
    fixtures.points(spark, sf_dir).count()
    fixtures.raster_store(spark, sf_dir, CHUNK)
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
