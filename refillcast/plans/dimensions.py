"""Customer and product dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refillcast.functions import path_level, to_double
from refillcast.operators.reshape import pivot_membership
from refillcast.operators.trailing import CUSTOMER

# The customer attributes of the export, in its order, and which are numbers.
IDENTITY_ATTRIBUTES = (
    ("hours_since__first_event", "double"),
    ("hours_since__modified", "double"),
    ("hours_since__calculated", "double"),
    ("customer_events_count", "double"),
    ("se_click_rate", "double"),
    ("se_email_clicked_count", "double"),
    ("hours_since__se_email_clicked_date_last", "double"),
    ("se_email_read_count", "double"),
    ("hours_since__se_email_read_date_last", "double"),
    ("se_email_sent_count", "double"),
    ("hours_since__se_email_sent_date_last", "double"),
    ("se_engagement", "double"),
    ("se_events_count", "double"),
    ("se_open_rate", "double"),
    ("me_events_count", "double"),
    ("me_visits_count", "double"),
    ("me_os_most_freq", "string"),
    ("me_page_views_avg", "double"),
    ("me_amount_spent_all", "double"),
    ("me_browser_most_freq", "string"),
    ("me_device_type_most_freq", "string"),
    ("me_device_model_most_freq", "string"),
    ("me_device_brand_most_freq", "string"),
    ("me_country", "string"),
    ("me_city", "string"),
    ("me_city_last", "string"),
    ("me_payment_most_freq", "string"),
    ("me_delivery_most_freq", "string"),
    ("me_device_model_most_freq_second", "string"),
    ("me_device_brand_most_freq_second", "string"),
    ("me_device_type_most_freq_second", "string"),
    ("me_amount_spent_avg", "double"),
    ("hours_since__me_transaction_datetime_first", "double"),
    ("hours_since__me_transaction_datetime_last", "double"),
    ("me_brand_purchase_most_freq", "string"),
    ("me_product_purchase_most_freq", "string"),
    ("me_product_viewed_most_freq", "string"),
    ("me_transaction_count", "double"),
    ("me_engagement", "double"),
    ("me_spend_percentile_quintile", "double"),
    ("mx_gender_est_last", "string"),
    ("mx_email_count_unique", "double"),
    ("web_time_spent_sum", "double"),
    ("hours_since__me_registration_date", "double"),
)

# The identity sources the modelling table keeps.
IDENTITY_SOURCES = ("magento", "me_web", "se")


def identity_source_matrix(sources: DataFrame, values: Sequence[str] = IDENTITY_SOURCES) -> DataFrame:
    """Customer x source row counts."""
    return pivot_membership(sources, CUSTOMER, "sources", values)


def product_dimension(feed: DataFrame) -> DataFrame:
    """Product attributes with the category path split in three levels."""
    return feed.select(
        "item_id",
        path_level("product_category", 0).alias("first_category"),
        path_level("product_category", 1).alias("second_category"),
        path_level("product_category", 2).alias("third_category"),
        "brand",
        to_double("price").alias("price"),
    )


def identity_dimension(raw: DataFrame) -> DataFrame:
    """Typed customer attributes; texts and the transaction count get their default here."""
    typed = []
    for name, kind in IDENTITY_ATTRIBUTES:
        if kind == "string":
            value = F.coalesce(F.col(name), F.lit("Unknown"))
        elif name == "me_transaction_count":
            value = F.coalesce(to_double(name), F.lit(0.0))
        else:
            value = to_double(name)
        typed.append(value.alias(name))
    return raw.select(CUSTOMER, *typed)
