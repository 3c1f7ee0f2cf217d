"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``: one warm-up, then ``$BENCH_REPS`` timed runs (median).
A run executes the whole plan through the ``noop`` sink (no collect).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from letrado.queries import QUERIES  # noqa: E402
from letrado.session import build_session  # noqa: E402

HEADLINE = ["painel_nacional", "evolucao_uf", "indicador_municipio", "ml_features", "silver_alunos",
            "quality_report", "stream_upsert", "alert_windows"]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", int(cpus), app_name="letrado-bench",
                          extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    out, errors = {}, {}
    for n in names:
        try:
            run_once(spark, n, sf_dir)  # warm-up: JIT, file listing, metadata caches
            out[n] = round(statistics.median(run_once(spark, n, sf_dir) for _ in range(reps)), 3)
        except Exception as e:  # noqa: BLE001 - one failing query must not hide the others
            out[n] = None
            errors[n] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    line = {"metric": "median_query_seconds_total",
            "value": round(sum(v for v in out.values() if v is not None), 3),
            "unit": "sec", "queries": out, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}
    if errors:
        line["errors"] = errors
    print(json.dumps(line))


if __name__ == "__main__":
    main()
