"""Time the headline queries; prints one JSON line.

Every query runs once cold and ``BENCH_RUNS`` times warm; its value is the
median of the warm runs. All rows and columns are computed into a sink that
discards them.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from streamgauge.catalog import all_queries
from streamgauge.session import build_session

HEADLINE = [
    "m1_hub",
    "m2_sat_details",
    "m3_sat_minute_viewers",
    "m4_channel_daily",
    "m5_transcript_minutes",
    "m7_transcript_coverage",
    "m8_semantic_shift",
    "m9_viewer_shift_label",
    "m11_current_minute_viewers",
    "m15_retention_streak",
    "m16_retention_segments",
    "m20_weekly_deviation",
    "m21_kpi_summary",
    "m23_long_forecast",
    "m26_video_engagement",
    "m28_percent_resample",
    "m31_curve_normalised",
    "m33_cluster_median_curve",
    "m37_minute_content_report",
    "l5_delete_insert",
    "m10_shift_bands",
    "m32_curve_clusters",
    "g1_embed_text",
    "g2_series_forecast",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = all_queries()
    names = list(known) if chosen == "all" else (chosen.split(",") if chosen else HEADLINE)

    def once(name: str) -> float:
        start = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    cold, warm = {}, {}
    for name in names:
        cold[name] = round(once(name), 3)
        warm[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median warm seconds",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
