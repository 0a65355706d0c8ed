"""Target rows: one per repeat purchase of a product by a customer, with the gap in days."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refillcast.functions import days_between
from refillcast.operators.trailing import CUSTOMER, TARGET_KEY

LAST = "last_purchase_dt"
GAP = "days_since_last_purchase"


def with_gap(target: DataFrame) -> DataFrame:
    """Add the days between the previous purchase and this one."""
    return target.withColumn(GAP, days_between("purchase_dt", LAST))


def previous_purchase(purchases: DataFrame) -> DataFrame:
    """Distinct purchase times per (customer, product) with the time before; NULL for the first.

    One exchange and one sort: equal times lie side by side, and only the first of them is kept, whose
    predecessor is the distinct time before. NULL times come before all others and have no time to hand on. The
    sort spills; no task holds a table of groups, which on the side of the scan would have nearly one per purchase.
    """
    in_time = Window.partitionBy(CUSTOMER, "product_id").orderBy(F.asc_nulls_first("purchase_dt"))
    before = F.lag(F.struct("purchase_dt")).over(in_time)
    again = F.col("before").isNotNull() & F.col("before.purchase_dt").eqNullSafe(F.col("purchase_dt"))
    return (
        purchases.select(*TARGET_KEY).withColumn("before", before).where(~again)
        .select(*TARGET_KEY, F.col("before.purchase_dt").alias(LAST)))


def replenishment_target(purchases: DataFrame) -> DataFrame:
    """Target table from raw purchases: every purchase that has an earlier one."""
    return with_gap(previous_purchase(purchases).where(F.col(LAST).isNotNull()))


def last_purchases(purchases: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """The state of an incremental build: the last purchase time of each (customer, product), brought up to date."""
    product = [CUSTOMER, "product_id"]
    times = purchases.select(*product, F.col("purchase_dt").alias(LAST))
    rows = times if state is None else times.unionByName(state.select(*product, LAST))
    return rows.groupBy(*product).agg(F.max(LAST).alias(LAST)).where(F.col(LAST).isNotNull())


def target_increment(state: DataFrame, purchases: DataFrame) -> DataFrame:
    """Target rows of purchases that are later than the state of their customer and product.

    Only the new purchases are sorted; the first of each pair takes its predecessor from the state. Purchases at the
    state's time or before are not looked at: the former is in the target already, the latter came too late for it
    (``late_purchases``).
    """
    known = state.select(F.col(CUSTOMER).alias("known_customer"), F.col("product_id").alias("known_product"), F.col(LAST).alias("known"))
    same = F.col(CUSTOMER).eqNullSafe(F.col("known_customer")) & F.col("product_id").eqNullSafe(F.col("known_product"))
    fresh = previous_purchase(purchases.where(F.col("purchase_dt").isNotNull())).join(known, same, "left")
    later = fresh.where(F.col("known").isNull() | (F.col("purchase_dt") > F.col("known")))
    before = F.greatest(F.col(LAST), F.col("known")).alias(LAST)
    return with_gap(later.select(*TARGET_KEY, before).where(F.col(LAST).isNotNull()))


def late_purchases(state: DataFrame, purchases: DataFrame) -> DataFrame:
    """Purchases before the state's time: an incremental build leaves them out, a whole one would not."""
    known = state.select(F.col(CUSTOMER).alias("known_customer"), F.col("product_id").alias("known_product"), F.col(LAST).alias("known"))
    same = F.col(CUSTOMER).eqNullSafe(F.col("known_customer")) & F.col("product_id").eqNullSafe(F.col("known_product"))
    return purchases.join(known, same & (F.col("purchase_dt") < F.col("known")), "left_semi")
