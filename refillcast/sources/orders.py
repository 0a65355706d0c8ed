"""The order table and the product configuration."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refillcast.sources.delimited import read_delimited


def scan_orders(
    spark: SparkSession,
    path: str,
    until: dt.date | str | None = None,
    columns: tuple[str, ...] = ("customer_email", "product_id__item", "created_at__item"),
    ts: str = "created_at__item",
) -> DataFrame:
    """Order lines, up to and including midnight of ``until`` if given; columns and filter reach the scan."""
    orders = spark.read.parquet(path)
    if until is not None:
        orders = orders.where(F.col(ts) <= F.lit(str(until)).cast("timestamp"))
    return orders.select(*columns)


def load_product_config(spark: SparkSession, path: str) -> DataFrame:
    """Product configuration: trimmed id, days as an integer (``NA`` gives NULL), yes/no as boolean."""
    return read_delimited(spark, path).select(
        F.trim("PRODUCT_ID").alias("PRODUCT_ID"),
        "NAME",
        F.col("REPLENISHMENT_DAYS").try_cast("int").alias("REPLENISHMENT_DAYS"),
        (F.col("IS_DEFINED") == "yes").alias("IS_DEFINED"),
    )
