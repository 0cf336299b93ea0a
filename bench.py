"""Benchmark: the load job and every headline query at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints ONE JSON line.  ``load`` builds the star schema from the raw tables
and writes the six tables (what the reference's job does); the questions and
statistics then run on the written tables, as a user of the schema would.
``e2e_*`` keys run the registered query from the raw tables in one plan.
The timed pass follows one untimed pass of the same suite at sf0.001.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="cadenza-bench-")

    from pyspark.sql import Observation, SparkSession
    from pyspark.sql import functions as F

    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("cadenza-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", os.environ.get("CADENZA_DRIVER_MEMORY", "16g"))
             .config("spark.sql.shuffle.partitions", str(max(8, cpus * 2)))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             # small local data: let AQE keep more, smaller partitions so the
             # CPU-bound stages use all cores (cluster runs use advisory sizes)
             .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", f"file://{scratch}")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from cadenza.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)   # the configured spark.checkpoint.dir; a scratch one only if unset

    from cadenza.operators import profile as P
    from cadenza.operators import stats as ST
    from cadenza.plans import questions as Q
    from cadenza.plans.catalog import queries
    from cadenza.plans.load import load_star
    from cadenza.schema import AUDIO_FEATURES
    from cadenza.sources.fixture import raw_tracks

    def run(df) -> int:
        # counted while written nowhere: no result reaches the driver
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
        return int(seen.get["n"])

    def suite(sf: str, label: str) -> tuple[dict[str, float], dict[str, int]]:
        times: dict[str, float] = {}
        rows: dict[str, int] = {}
        t0 = time.perf_counter()
        star, audit, _ = load_star(spark, raw_tracks(spark, sf), f"{scratch}/{label}-star")
        times["load"] = time.perf_counter() - t0
        rows["load"] = sum(audit.values())
        fact = star.fact_track_popularity
        timed = {
            "q1": lambda: Q.q1_top_tracks(star),
            "q2": lambda: Q.q2_duration_popularity(star),
            "q2_named": lambda: Q.q2_duration_popularity_named(star),
            "q3": lambda: Q.q3_top_artists(star),
            "q4": lambda: Q.q4_album_categories(star),
            "q5": lambda: Q.q5_key_popularity(star),
            "q5_raw": lambda: Q.q5_key_avg_raw(star),
            "q5_counts": lambda: Q.q5_key_counts(star),
            "q6": lambda: Q.q6_top_albums(star),
            "describe": lambda: P.describe(fact, "popularity"),
            "histogram": lambda: ST.histogram(fact, "popularity", 30),
            "kde": lambda: ST.kde(fact, "popularity", 200),
            "boxplot": lambda: ST.boxplot_stats(fact, "popularity"),
            "correlation": lambda: ST.correlation_matrix(star.dim_tracks, AUDIO_FEATURES),
        }
        for name, build in timed.items():
            t0 = time.perf_counter()
            rows[name] = run(build())
            times[name] = time.perf_counter() - t0
        reg = queries()
        for name in ("q6_top_albums", "q1_top_tracks", "primary_genre"):
            t0 = time.perf_counter()
            rows[f"e2e_{name}"] = run(reg[name](spark, sf))
            times[f"e2e_{name}"] = time.perf_counter() - t0
        return times, rows

    # warm-up: one untimed pass of the same suite on the smallest tables, so
    # the timed pass measures steady state rather than JIT and codegen
    warm = os.environ.get("BENCH_WARMUP_SF_DIR", "/root/testdata/sf0.001")
    if warm and os.path.isdir(warm):
        suite(warm, "warmup")
    times, rows = suite(sf_dir, "timed")

    total = sum(times.values())
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "rows": rows,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "warmup": "one untimed pass of the same suite at sf0.001",
        "spark": spark.version,
        "event_log_dir": scratch,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
