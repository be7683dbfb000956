"""Time every catalog query at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line on stdout."""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F

from fundlens.plans.batch_load import run_batch_load
from fundlens.plans.catalog import QUERIES
from fundlens.plans.star_schema import Market
from fundlens.session import local_session


def run(query, spark, folder) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def etl(spark, folder) -> dict:
    """First load of all bars from CSV files into the tables, as an ETL job runs it."""
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    m = Market(spark, folder)
    names = m.constituents.select(F.col("id").alias("constituent_id"), "ticker")
    bars = m.prices.join(names, "constituent_id").select("date", "ticker", *[
        F.col(f"{c}_price").alias(c) for c in ("open", "high", "low", "close")], "volume")
    bars.write.option("header", True).csv(f"{work}/source/prices.csv")
    m.constituents.drop("id").write.option("header", True).csv(f"{work}/source/constituents.csv")
    start = time.perf_counter()
    loaded = run_batch_load(spark, f"{work}/source", f"{work}/tables", "b0001").first()
    seconds = time.perf_counter() - start
    rows = loaded.total_price_records
    return {"rows": rows, "seconds": round(seconds, 2), "rows_per_second": round(rows / seconds)}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = [a for a in sys.argv[1:] if a != "etl"] or list(QUERIES)
    spark = local_session(cores, "fundlens-bench")
    if "etl" in sys.argv:
        print(json.dumps({"metric": "batch_load", **etl(spark, folder)}))
        return
    run(QUERIES["etf_series"], spark, folder)  # start the JVM's compilers before the clock
    times = {name: round(run(QUERIES[name], spark, folder), 3) for name in chosen}
    spark.stop()
    sf = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf.group(1)) if sf else folder, "cpus": int(cores),
    }))


if __name__ == "__main__":
    main()
