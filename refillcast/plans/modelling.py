"""The modelling table: target rows with every trailing feature and dimension attribute."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refillcast.functions import fill_defaults
from refillcast.operators.joins import join_hot
from refillcast.operators.reshape import long_union
from refillcast.operators.trailing import (
    CUSTOMER,
    TARGET_KEY,
    WINDOWS,
    Channel,
    channel_outputs,
    channel_totals,
    daily_events,
    running_windows,
    target_copies,
)
from refillcast.plans.dimensions import IDENTITY_ATTRIBUTES, IDENTITY_SOURCES
from refillcast.plans.target import GAP, LAST
from refillcast.session import settle

# Slots, labels and naming of the five top-k channels.
UTM_SOURCE = Channel("source", "utm_source", "source_dt", ("utm_source",), "utm_source", 5, "flag", keep_null=True)
UTM_MEDIUM = Channel("medium", "utm_medium", "medium_dt", ("utm_medium",), "utm_medium", 10, "flag", keep_null=True)
UTM_CAMPAIGN = Channel("campaign", "utm_campaign", "campaign_dt", ("utm_campaign",), "utm_campaign", 10, "flag")
BANNER_CLICKED = Channel(
    "banner", "clicked_banner", "clicked_dt", ("banner_name", "banner_id"), "banner_name", 10, "count"
)
BANNER_IMPRESSION = Channel(
    "banner", "impression_banner", "impression_dt", ("banner_name", "banner_id"), "banner_name", 10, "count"
)

PRODUCT_TEXT = ("first_category", "second_category", "third_category", "brand")


@dataclass(frozen=True)
class ModellingSpec:
    min_gap_days: float = 20
    windows: tuple[int, ...] = WINDOWS
    utm_source: Channel = UTM_SOURCE
    utm_medium: Channel = UTM_MEDIUM
    utm_campaign: Channel = UTM_CAMPAIGN
    banner_clicked: Channel = BANNER_CLICKED
    banner_impression: Channel = BANNER_IMPRESSION
    sources: tuple[str, ...] = IDENTITY_SOURCES
    # Folder for the filtered target, which four branches of the plan read, and beginning of the folders for what the
    # last join meets. Without it each branch derives the target again, and all exchanges of the plan lie on disk
    # at once; with it each table is written once, and what was shuffled for it is dropped before the next begins.
    staging: str | None = field(default=None)

    @property
    def channels(self) -> tuple[str, ...]:
        return ("banner_clicked", "banner_impression", "utm_campaign", "utm_medium", "utm_source")


@dataclass(frozen=True)
class ModellingInputs:
    target: DataFrame  # customer, product, purchase_dt, last_purchase_dt, days_since_last_purchase
    purchases: DataFrame  # customer, product, purchase_dt, quantity
    views: DataFrame  # customer, viewed_dt, product
    utm_source: DataFrame
    utm_medium: DataFrame
    utm_campaign: DataFrame
    banner_clicked: DataFrame
    banner_impression: DataFrame
    identifiers: DataFrame  # customer, n_identifiers
    attributes: DataFrame  # identity_dimension
    sources: DataFrame  # identity_source_matrix
    products: DataFrame  # product_dimension


def product_mean_gap(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Mean gap per product. ``weight`` says how many output rows a row stands for.

    An aggregate instead of a window: partial sums leave one row per product and task, so a
    product with a large share of the rows does not load one task.
    """
    w = F.col(weight) if weight else F.lit(1)
    known = F.when(F.col(GAP).isNotNull(), w)
    return df.groupBy("product_id").agg(
        (F.sum(F.col(GAP) * w) / F.sum(known)).alias("longterm_average_since_last_purchase")
    )


def product_totals(
    target: DataFrame, purchases: DataFrame, views: DataFrame, windows: Sequence[int] = WINDOWS
) -> DataFrame:
    """The rows of a target (with ``day``), and quantity bought (days before) and views (day included) in their windows.

    The rows go through the windows themselves, repeated ones too, so nothing is joined back.
    """
    keys = [CUSTOMER, "product_id"]
    events = long_union(
        purchases.select(
            *keys, F.col("purchase_dt").alias("event_ts"), F.col("quantity").cast("double").alias("quantity"),
            F.lit(None).cast("int").alias("view"),
        ),
        views.select(
            *keys, F.col("viewed_dt").alias("event_ts"), F.lit(None).cast("double").alias("quantity"),
            F.lit(1).alias("view"),
        ),
    )
    sums = {"bought": F.sum("quantity"), "viewed": F.sum("view")}
    days = daily_events(events, keys, "event_ts", sums)
    return running_windows(target, days, keys, list(sums), windows, strict=("bought",))


def customer_frame(inputs: ModellingInputs) -> DataFrame:
    """Attributes, sources and identifier count per covered customer.

    Customers without attributes or sources are left out; duplicate rows fan out.
    """
    return inputs.sources.join(inputs.attributes, CUSTOMER).join(inputs.identifiers, CUSTOMER, "left")


def covered_target(inputs: ModellingInputs, min_gap_days: float) -> DataFrame:
    """Target rows that reach the output: ``weight`` output rows each, ``copies`` rows of their key.

    Copies count all rows of the target key, also those whose gap is too short.
    """
    weights = customer_frame(inputs).groupBy(CUSTOMER).agg(F.count(F.lit(1)).alias("weight"))
    keyed = inputs.target.dropna(subset=list(TARGET_KEY))
    live = keyed.where(F.col(GAP) > min_gap_days).join(target_copies(keyed), list(TARGET_KEY))
    return join_hot(live, weights, CUSTOMER, "inner").withColumn("day", F.to_date("purchase_dt"))


def modelling_data(inputs: ModellingInputs, spec: ModellingSpec | None = None) -> DataFrame:
    """The wide modelling table, one row per covered target row with a long enough gap.

    Filters run on the narrow target before any feature work. The customer side (all channel
    slots and attributes) is built per (customer, day) and joined once, so target rows are
    wide only after the last exchange.
    """
    spec = spec or ModellingSpec()
    def settled(df: DataFrame, name: str = "") -> DataFrame:
        return settle(df, f"{spec.staging}{name}") if spec.staging else df

    covered = settled(covered_target(inputs, spec.min_gap_days))
    dimension = inputs.products.withColumnRenamed("item_id", "product_id")
    products = settled(product_mean_gap(covered, "weight").join(dimension, "product_id", "left"), "-products")
    of_product = settled(product_totals(covered, inputs.purchases, inputs.views, spec.windows), "-windows")
    channels = [(getattr(spec, name), getattr(inputs, name)) for name in spec.channels]
    of_customer = channel_totals(covered, channels, spec.windows)
    customers = settled(of_customer.join(customer_frame(inputs), CUSTOMER), "-customers")

    joined = join_hot(of_product, products, "product_id", "inner").join(customers, [CUSTOMER, "day"])
    copies = F.col("copies")
    attributes = [name for name, _ in IDENTITY_ATTRIBUTES]
    filled = fill_defaults(joined, cols=[*PRODUCT_TEXT, "price", *attributes, *spec.sources])
    bought = {
        f"purchased_quantity_last{m}m": F.col(f"bought__{m}") * copies for m in spec.windows
    }
    viewed = {f"last{m}m_product_view": F.col(f"viewed__{m}") * copies for m in spec.windows}
    slots = channel_outputs([channel for channel, _ in channels], spec.windows)
    banners = {n: v for n, v in slots.items() if n.endswith("_banner")}
    return filled.select(
        *TARGET_KEY,
        LAST,
        GAP,
        F.log(GAP).alias(f"log_{GAP}"),
        "longterm_average_since_last_purchase",
        "n_identifiers",
        *PRODUCT_TEXT,
        "price",
        *attributes,
        *spec.sources,
        *[value.alias(name) for name, value in {**bought, **banners, **viewed, **slots}.items()],
    )
