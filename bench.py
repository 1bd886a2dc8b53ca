"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

A query's time covers building it (with any size checks and intermediate tables) and reading its rows
into a no-op sink. $BENCH_QUERIES may name other queries, or ``all``.
"""

from __future__ import annotations

import json
import os
import time

from yardline.queries import QUERIES
from yardline.session import clean_up, local_session

HEADLINE = (
    "game_stats qb_pass rushing receiving def_stats drive_stats game_results rolling_mean_full ewm_mean expanding_mean "
    "global_expanding_mean rolling_slope adjusted_epa quantiles qcut_decile simulation_summary calibration_curve "
    "conformal_interval home_away_unpivot odds_table qb_rolling shrunk_ewm srs_rating"
).split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else wanted.split() or HEADLINE
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, "16g")
    spark.sparkContext.setLogLevel("OFF")
    QUERIES["agg_sum"](spark, folder).write.format("noop").mode("overwrite").save()  # warm the JVM
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    clean_up()
    spark.stop()
    result = {"metric": "headline query time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
              "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}
    print(json.dumps(result))


if __name__ == "__main__":
    main()
