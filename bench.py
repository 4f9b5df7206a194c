"""Times the headline stages over the bound tables and prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores. Queries read the stored
outputs of earlier stages, so building those is timed too: ``bind_raw`` (raw-shaped tables),
``seq_master`` (keyed lines and serials), ``store_stages`` (every stage output once) and ``store_checked``
(costs, eras and numbered periods, which only the integrity checks read).
Every query then plans and runs its own stage, the result going to the no-op sink;
``run_etl_counts`` is the whole conversion from raw tables to cleansed CDM tables.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from claimloom.binding import queries, raw
from claimloom.binding.stages import BUILD, BUILD_LAST, Stages

HEADLINE = (
    "build_source_map",
    "care_site",
    "person",
    "death",
    "observation_period",
    "visit_occurrence",
    "condition_occurrence_mapped",
    "condition_occurrence",
    "observation",
    "measurement",
    "drug_exposure",
    "procedure_occurrence",
    "device_exposure",
    "payer_plan_period",
    "cost",
    "drug_era",
    "condition_era",
    "dose_era",
    "cleanse_condition",
    "dq_report",
    "check_not_null",
    "run_etl_counts",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("claimloom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1).count()
    times: dict[str, float] = {}

    def timed(name: str, action) -> None:
        started = time.perf_counter()
        action()
        times[name] = round(time.perf_counter() - started, 3)

    stages = Stages(spark, folder)
    timed("bind_raw", lambda: [getattr(stages, name) for name in raw.STORED])
    timed("seq_master", lambda: stages.seq.write.format("noop").mode("overwrite").save())
    timed("store_stages", lambda: [getattr(stages, name) for name in BUILD])
    timed("store_checked", lambda: [getattr(stages, name) for name in BUILD_LAST])
    for name in HEADLINE:
        query = queries.QUERIES[name]
        timed(
            name,
            lambda q=query: q.run(spark, folder).write.format("noop").mode("overwrite").save(),
        )
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_seconds",
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
