"""Time the headline queries and print one JSON line.

Each query is run to completion without collecting its rows. Settings come
from the environment: BENCH_SF_DIR, BENCH_CPUS.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import CHECKS  # noqa: E402
from stopwise.session import build_session  # noqa: E402

HEADLINE = (
    "trip_stop_schedule",
    "vehicle_positions_enriched",
    "trip_stop_updates_enriched",
    "trip_monitoring_samples",
    "route_health",
    "vehicle_latest_state",
    "service_alerts_snapshot",
    "service_alert_periods",
    "dim_dates",
    "broken_references",
    "routes_needing_attention",
    "health_trend",
    "period_summary",
    "vehicle_rows_flattened",
    "stop_rows_flattened",
    "alert_rows_flattened",
    "vehicle_contract",
    "normalised_trips",
    "stream_health",
    "streamed_vehicle_rows",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        extra={
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    # One untimed query starts the engine.
    CHECKS["dim_routes"].query(spark, folder).write.format("noop").mode("overwrite").save()
    for name in HEADLINE:
        started = time.perf_counter()
        CHECKS[name].query(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{seconds[name]:8.3f}s {name}", file=sys.stderr)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
