"""Wall times of the headline queries and of the layer jobs.

Prints one JSON line and, if ``BENCH_OUT`` names a file, writes it there.
``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the number of local threads.
All of it runs once over the smallest data to warm the session up. Then the
jobs run once and the queries ``BENCH_RUNS`` times (3), of which the median
counts. Queries run into a sink that discards rows; layer jobs write their
tables to a new scratch folder. The prediction job trains both models and
scores every client; its time stands beside the total.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from storeloom.checks import queries as checks  # noqa: E402
from storeloom.layout import Layout  # noqa: E402
from storeloom.plans.gold import gold_flow  # noqa: E402
from storeloom.plans.prediction import prediction_flow  # noqa: E402
from storeloom.plans.refresh import refresh_serving  # noqa: E402
from storeloom.plans.silver import silver_flow  # noqa: E402
from storeloom.session import build_session, scratch_path  # noqa: E402
from storeloom.sources import starschema  # noqa: E402
from storeloom.sources.files import bronze_ingest  # noqa: E402

WARM_UP = "/root/testdata/sf0.001"
HEADLINE = ["fact_sales", "clean_clients", "clean_purchases", "quality_report", "client_kpis",
            "product_analytics", "country_analytics", "daily_sales", "weekly_sales",
            "monthly_sales", "statistical_distributions", "gold_summary", "global_kpis",
            "client_features"]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def discard(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def layer_times(spark, sf_dir: str, prediction: bool) -> tuple[dict[str, float], float | None]:
    """Bronze, silver and gold over the faulty source files, then the refresh."""
    layout = Layout(scratch_path(spark, "bench"))
    source = checks._source_csv(spark, starschema.dirty_clients(spark, sf_dir),
                                starschema.dirty_purchases(spark, sf_dir))
    return {
        "bronze": timed(lambda: bronze_ingest(spark, source, layout)),
        "silver": timed(lambda: silver_flow(spark, layout, checks.AS_OF)),
        "gold": timed(lambda: gold_flow(spark, layout, checks.AS_OF)),
        "refresh": timed(lambda: refresh_serving(spark, layout)),
    }, timed(lambda: prediction_flow(spark, layout, checks.AS_OF)) if prediction else None


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    registered = checks.queries()

    def query_times(folder: str) -> dict[str, float]:
        return {n: timed(lambda n=n: discard(registered[n](spark, folder))) for n in HEADLINE}

    layer_times(spark, WARM_UP, prediction=False)
    query_times(WARM_UP)
    layers, prediction = layer_times(spark, sf_dir, prediction=True)
    rounds = [query_times(sf_dir) for _ in range(int(os.environ.get("BENCH_RUNS", "3")))]
    times = {f"job_{k}": v for k, v in layers.items()}
    times |= {n: round(median(r[n] for r in rounds), 3) for n in HEADLINE}

    scale = re.search(r"sf([0-9.]+)/?$", sf_dir)
    line = json.dumps({"metric": "total_wall_time", "value": round(sum(times.values()), 3),
                       "unit": "sec", "queries": times, "prediction": prediction,
                      "stages_total": round(times["job_bronze"] + times["job_silver"] + times["job_gold"], 3),
                       "refresh_cycle": round(times["job_gold"] + times["job_refresh"], 3),
                       "sf": float(scale.group(1)) if scale else sf_dir, "cpus": int(cpus)})
    print(line)
    if os.environ.get("BENCH_OUT"):
        with open(os.environ["BENCH_OUT"], "w") as out:
            out.write(line + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
