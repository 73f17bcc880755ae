"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query runs
once untimed, so that class loading and code generation do not count, and is then
timed; every row is produced (``noop`` sink), none is brought to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from medallion.session import build_session  # noqa: E402
from workloads import batch, rides, streams  # noqa: E402

HEADLINE = [
    "parse_json",
    "append_flows",
    "enrich_left",
    "dedup_first",
    "scd1_latest",
    "scd1_composite",
    "scd2_history",
    "fare_components",
    "to_json_event",
    "star_readback",
    "quality_report",
    "ride_obt",
    "ride_dim_passenger",
    "ride_dim_payment",
    "ride_dim_location",
    "ride_fact",
    "ride_star",
    "stream_append",
    "stream_scd1",
    "stream_scd2",
    "stream_star",
]


def scale(sf_dir: str) -> float | str:
    """The scale factor a folder is named after, or its name."""
    name = Path(sf_dir).name
    try:
        return float(name.removeprefix("sf"))
    except ValueError:
        return name


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = {**batch.QUERIES, **rides.QUERIES, **streams.QUERIES}

    def run(name: str) -> float:
        start = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        run(name)
        seconds[name] = round(run(name), 3)
        print(f"{name:20} {seconds[name]:8.3f}s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": scale(sf_dir),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
