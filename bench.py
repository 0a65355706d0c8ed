"""Time the composite queries; prints one JSON line.

Inputs are staged as Parquet first (not timed), as the exports they stand for lie in storage.
Each query is built and forced with a noop write: one warm-up run, then the median of three.
The product-level sums are also timed as the plain SQL of their definition (row-level join on
months_between), in the same session; with BENCH_PLAIN=1 every feature is (cross join with the
top-k labels, count distinct), and both product-level sums once more on a target of which a third
of the customers is one.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from refillcast.operators.trailing import trailing_count, trailing_sum  # noqa: E402
from refillcast.plans.dimensions import IDENTITY_ATTRIBUTES  # noqa: E402
from refillcast.session import build_session, configure  # noqa: E402
from registry import inputs, oracle  # noqa: E402
from registry.catalog import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
MEMORY = os.environ.get("BENCH_MEMORY", "16g")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = [
    "replenishment_target",
    "trailing_quantity",
    "trailing_views",
    "utm_source_flags",
    "utm_medium_flags",
    "utm_campaign_flags",
    "banner_click_counts",
    "banner_impression_counts",
    "identity_source_matrix",
    "product_dimension",
    "identity_dimension",
    "modelling_data",
    "daily_volume",
    "daily_customers",
]
STAGED = [
    "transactional_quantity",
    "replenishment_target",
    "product_views",
    *oracle.TOPK,
    "identity_identifiers",
    "identity_attributes_known",
    "identity_sources",
    "products",
    "shop_orders",
]


def median_time(build) -> float:
    times = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


def plain_queries(spark) -> dict[str, str]:
    """The definition of each feature set as Spark SQL over views of the staged inputs."""
    for name in STAGED:
        view = name
        inputs.staged(spark, SF_DIR, name).createOrReplaceTempView(view)
    oracle.months_between = lambda a, b: f"months_between({a}, {b})"
    wide = oracle.modelling_data(IDENTITY_ATTRIBUTES)
    # The staged views replace the inputs the check SQL derives for itself.
    wide = "with " + wide[wide.index("ppur as ("):]
    names = {"utm_source_flags": "utm_source", "utm_medium_flags": "utm_medium",
             "utm_campaign_flags": "utm_campaign", "banner_click_counts": "banner_clicked",
             "banner_impression_counts": "banner_impression"}
    return {
        "trailing_quantity": oracle.trailing_quantity(),
        "trailing_views": oracle.trailing_views(),
        **{query: oracle.topk_sql(events) for query, events in names.items()},
        "modelling_data": wide,
    }


def skewed_queries(spark) -> dict:
    """The product-level sums where a third of the customers is merged into one."""
    def merged(name: str):
        hot = "case when cast(customer_entity_id as long) % 3 = 0 then '0' else customer_entity_id end"
        return inputs.staged(spark, SF_DIR, name).withColumn("customer_entity_id", F.expr(hot))

    target = merged("replenishment_target")
    keys = ["customer_entity_id", "product_id"]
    return {
        "trailing_quantity": lambda: trailing_sum(
            target, merged("transactional_quantity"), keys, "quantity", "purchased_quantity"),
        "trailing_views": lambda: trailing_count(target, merged("product_views"), keys, "product_view", "viewed_dt"),
    }


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": MEMORY,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    for name in STAGED:
        inputs.staged_path(spark, SF_DIR, name)
    times = {name: median_time(lambda q=QUERIES[name]: q(spark, SF_DIR)) for name in HEADLINE}
    result = {
        "metric": "composite_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    every = os.environ.get("BENCH_PLAIN") == "1"
    plain = {n: t for n, t in plain_queries(spark).items() if every or n in ("trailing_quantity", "trailing_views")}
    result["plain_sql"] = {name: median_time(lambda t=text: spark.sql(t)) for name, text in plain.items()}
    if every:
        result["skewed"] = {name: median_time(build) for name, build in skewed_queries(spark).items()}
    result["cpus"], result["memory"] = int(CPUS), MEMORY
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
