"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from gleanrank.plans.index import build_index
from gleanrank.plans.search import search
from gleanrank.session import new_scratch, tuned
from gleanrank.workload.queries import QUERIES, documents

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ONE_TERM = "the"
FIVE_TERMS = "the que und de la"


def run(df: DataFrame | None) -> None:
    if df is not None:
        df.write.format("noop").mode("overwrite").save()


def main() -> None:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("gleanrank-bench")
    spark = (
        tuned(builder)
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}

    def timed(name, action) -> None:
        started = time.perf_counter()
        run(action())
        timings[name] = round(time.perf_counter() - started, 3)

    # One untimed pass over the texts, so that JVM start-up is not charged to the first query.
    run(QUERIES["token_counts"](spark, SF_DIR))
    for name, query in QUERIES.items():
        timed(name, lambda query=query: query(spark, SF_DIR))

    for model in ("tfdf", "bm25"):
        index = new_scratch(spark, f"bench-{model}")
        timed(f"build_index_{model}", lambda: build_index(documents(spark, SF_DIR), index, model))
        for label, text in (("one_term", ONE_TERM), ("five_terms", FIVE_TERMS)):
            for zeros in (True, False):
                timed(
                    f"search_{model}_{label}" + ("_zeros" if zeros else ""),
                    lambda: search(spark, index, text, 10, model, include_zero=zeros),
                )
    spark.stop()
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
