"""Which modelling-table columns feed the model."""

from __future__ import annotations

from collections.abc import Iterable

from refillcast.functions import feature_name
from refillcast.operators.trailing import WINDOWS
from refillcast.plans.modelling import (
    BANNER_CLICKED,
    BANNER_IMPRESSION,
    UTM_CAMPAIGN,
    UTM_MEDIUM,
    UTM_SOURCE,
)

# The categorical features in use.
CAT_FEATURES = (
    "me_brand_purchase_most_freq",
    "me_browser_most_freq",
    "me_city",
    "me_delivery_most_freq",
    "me_device_brand_most_freq",
    "me_device_brand_most_freq_second",
    "me_device_model_most_freq",
    "me_device_model_most_freq_second",
    "me_device_type_most_freq",
    "me_device_type_most_freq_second",
    "mx_gender_est_last",
    "me_os_most_freq",
    "me_payment_most_freq",
)

# The numeric customer attributes among the candidates.
_ATTRIBUTES = (
    "se_click_rate",
    "se_email_clicked_count",
    "hours_since__se_email_clicked_date_last",
    "se_email_read_count",
    "hours_since__se_email_read_date_last",
    "se_email_sent_count",
    "hours_since__se_email_sent_date_last",
    "se_engagement",
    "se_events_count",
    "se_open_rate",
    "me_events_count",
    "me_visits_count",
    "me_page_views_avg",
    "me_amount_spent_all",
    "me_amount_spent_avg",
    "hours_since__me_transaction_datetime_last",
    "me_transaction_count",
    "me_engagement",
    "me_spend_percentile_quintile",
    "mx_email_count_unique",
    "web_time_spent_sum",
    "hours_since__me_registration_date",
    "magento",
    "me_web",
    "se",
)

# Names with any of these parts are left out of the model.
EXCLUDED_PARTS = (
    "last1m",
    "last6m",
    "last12m",
    "utm_source",
    "utm_medium",
    "utm_campaign",
    "impression_banner",
    "clicked_banner",
)


def candidate_num_features() -> list[str]:
    """Every numeric feature the modelling table offers the model."""
    channels = (BANNER_CLICKED, BANNER_IMPRESSION, UTM_CAMPAIGN, UTM_MEDIUM, UTM_SOURCE)
    return [
        *_ATTRIBUTES,
        *[f"purchased_quantity_last{m}m" for m in WINDOWS],
        *[f"last{m}m_product_view" for m in WINDOWS],
        *[feature_name(c.entity, r, m, c.kind) for c in channels for r in range(1, c.k + 1) for m in WINDOWS],
    ]


def select_features(names: Iterable[str], exclude: Iterable[str] = EXCLUDED_PARTS) -> list[str]:
    """Names that contain none of the excluded parts, in order."""
    parts = tuple(exclude)
    return [name for name in names if not any(part in name for part in parts)]


NUM_FEATURES = tuple(select_features(candidate_num_features()))
