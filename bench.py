"""Time every registered query on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Each query is planned and run once into a no-op sink after a short warm-up of the session. Sizes of the two
generated profiles are timed as well ("build_<profile>": all nine tables into the sink).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cartloom.generate import Generator, profile_named  # noqa: E402
from cartloom.plans.registry import all_queries  # noqa: E402
from cartloom.session import local_session  # noqa: E402


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus))
    registered = all_queries()
    chosen = sys.argv[1:] or list(registered)
    for name in ("status_counts", "order_totals"):
        drain(registered[name].run(spark, folder))

    seconds = {}
    for name in chosen:
        if name in registered:
            seconds[name] = timed(lambda: drain(registered[name].run(spark, folder)))
    if len(sys.argv) == 1:
        for profile in ("small", "full"):
            tables = Generator(profile_named(profile)).build(spark)
            seconds[f"build_{profile}"] = timed(lambda: [drain(df) for df in tables.values()])
    print(json.dumps({
        "metric": "total_seconds_of_all_registered_queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
        "cpus": int(cpus),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
