"""Daily volume series and their monthly means."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

METRICS = ("rows", "customers")


def daily_counts(orders: DataFrame, ts: str) -> DataFrame:
    """Rows per calendar day."""
    return orders.groupBy(F.to_date(ts).alias("created_at")).agg(F.count(F.lit(1)).alias("tmp_value"))


def daily_uniques(orders: DataFrame, ts: str, customer: str) -> DataFrame:
    """Distinct customers per calendar day."""
    return orders.groupBy(F.to_date(ts).alias("created_at")).agg(F.count_distinct(customer).alias("tmp_value"))


def monthly_mean(daily: DataFrame) -> DataFrame:
    """Each day with the mean of its calendar month's daily values (at most 31 rows a window)."""
    month = Window.partitionBy(F.year("created_at"), F.month("created_at"))
    return daily.withColumn("month_mean", F.avg("tmp_value").over(month))


def daily_vs_monthly(orders: DataFrame, metric: str, ts: str = "created_at__item",
                     customer: str = "customer_email") -> DataFrame:
    """Daily series and monthly mean as two labelled series, from one scan of the orders."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; use one of {METRICS}")
    daily = daily_counts(orders, ts) if metric == "rows" else daily_uniques(orders, ts, customer)
    # The labels of the two series, whatever the metric counts.
    return (
        monthly_mean(daily)
        .withColumn("n_emails", F.col("tmp_value").cast("double"))
        .withColumnRenamed("month_mean", "avg_daily_emails")
        .unpivot("created_at", ["avg_daily_emails", "n_emails"], "val_type", "value")
    )
