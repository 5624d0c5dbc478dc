"""Benchmark: research build + headline queries on one scale factor.

Usage: BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints ONE JSON line:
  {"metric": "pipeline_wall_median", "value": <median of build + queries sec>, "unit": "sec",
   "queries": {name: median sec, ...}, "sf": ..., "build_sec": ..., "cold_run_sec": ..., "oracle_sec": {...}}

(default 3) full runs, each from the driver tables with a fresh store; the
reported value is the median run.  The first, cold run is reported as
``cold_run_sec``.

* ``build`` derives the provider layer from the driver tables and stores the
  reused research tables (bar spine, ledgers, tradeability, normalized bars,
  flags) as Parquet in a fresh scratch folder, exactly as ``queries()`` does.
* every headline query is then executed in full with the ``noop`` sink (no
  row limit, no sampling).
* ``oracle_sec`` is DuckDB running the same keys' oracle SQL end-to-end from
  the driver tables (BENCH_ORACLE=0 skips it).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "daily_bar_pit",
    "normalized_bars",
    "tradeability_state",
    "fundamental_available_date",
    "corporate_action_ledger",
    "exception_ledger",
    "usability_flags",
    "quality_gates",
    "jump_examples",
    "dividend_proximity",
    "membership_intervals",
    "industry_unpivot",
    "upsert_replace",
    "raw_audit",
]
BUILD = ["daily_bar_pit", "corporate_action_ledger", "corporate_action_exception_ledger", "tradeability_state_daily",
         "normalized_bars", "usability_flags", "classified_jumps"]
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _median(xs: list[float]) -> float:
    xs = sorted(xs)
    n = len(xs)
    return xs[n // 2] if n % 2 else (xs[n // 2 - 1] + xs[n // 2]) / 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    warmups = int(os.environ.get("BENCH_WARMUP", "1"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from pitspark import catalog
    from pitspark.plans.research import Research
    from pitspark.session import checkpoint_dir, local_session

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")), app="pitspark-bench", checkpoints=tempfile.mkdtemp(prefix="pitspark-bench-"))
    base = checkpoint_dir(spark)
    key = (spark.sparkContext.applicationId, os.path.realpath(sf_dir))

    def one_run(tag: str) -> tuple[float, dict[str, float]]:
        """A full run from the driver tables: fresh store, build, every headline query."""
        t0 = time.time()
        research = Research.from_driver(spark, sf_dir, store=f"{base.rstrip('/')}/bench-{tag}-{int(time.time() * 1000)}")
        for name in BUILD:
            getattr(research, name)
        build = time.time() - t0
        catalog._BUILDS[key] = research
        times = {}
        for name in HEADLINE:
            t = time.time()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = time.time() - t
        return build, times

    cold_build, cold_times = one_run("cold")
    cold_total = cold_build + sum(cold_times.values())
    for i in range(max(warmups - 1, 0)):
        one_run(f"warm{i}")
    runs = [one_run(f"run{i}") for i in range(repeats)] if repeats > 0 else [(cold_build, cold_times)]
    builds = [b for b, _ in runs]
    totals = [b + sum(t.values()) for b, t in runs]
    per_query = {name: round(_median([t[name] for _, t in runs]), 3) for name in HEADLINE}
    spark.stop()

    oracle: dict[str, float] = {}
    if os.environ.get("BENCH_ORACLE", "1") != "0":
        import duckdb

        from oracle import oracle_sql

        sql = oracle_sql()
        con = duckdb.connect()
        con.execute(f"SET threads TO {int(cpus)}")
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        for name in HEADLINE:
            if name in sql:
                q = f"SELECT count(*) FROM ({sql[name]})"
                con.execute(q).fetchall()  # warm-up
                samples = []
                for _ in range(max(repeats, 1)):
                    t = time.time()
                    con.execute(q).fetchall()
                    samples.append(time.time() - t)
                oracle[name] = round(_median(samples), 3)

    print(json.dumps({
        "metric": "pipeline_wall_median",
        "value": round(_median(totals), 3),
        "unit": "sec",
        "queries": per_query,
        "sf": sf,
        "build_sec": round(_median(builds), 3),
        "cold_run_sec": round(cold_total, 3),
        "runs": len(runs),
        "oracle_sec": oracle,
        "oracle_total_sec": round(sum(oracle.values()), 3),
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
