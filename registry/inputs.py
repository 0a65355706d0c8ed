"""Inputs in the shape of the exports, derived from the star-schema test tables.

Each input is one SQL text that both engines read; only time arithmetic differs by dialect.
The texts shape inputs only: what the operators compute from them is written separately for
Spark (the package) and for the check (``registry.oracle``).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from refillcast.plans.dimensions import (
    IDENTITY_ATTRIBUTES,
    identity_dimension,
    identity_source_matrix,
    product_dimension,
)
from refillcast.plans.modelling import ModellingInputs, ModellingSpec, modelling_data
from refillcast.plans.target import replenishment_target
from refillcast.session import configure, fresh_path, settle

SOURCE_VALUES = ("magento", "me_web", "se", "store", "phone")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Order and ship dates are midnights; seconds of the day are added from the keys.
SPARK_WORDS = {
    "[order_ts]": "timestamp_seconds(unix_timestamp(cast(o.o_orderdate as timestamp)) + (o.o_orderkey * 7919) % 86400)",
    "[ship_ts]": "timestamp_seconds(unix_timestamp(cast(l.l_shipdate as timestamp))"
                 " + (l.l_orderkey * 104729 + l.l_linenumber) % 86400)",
    "[event_ts]": "cast(e.ts as timestamp)",
}
DUCK_WORDS = {
    "[order_ts]": "(o.o_orderdate + to_seconds((o.o_orderkey * 7919) % 86400))",
    "[ship_ts]": "(l.l_shipdate + to_seconds((l.l_orderkey * 104729 + l.l_linenumber) % 86400))",
    "[event_ts]": "e.ts",
}

# Customer attributes as expressions over the per-customer aggregates below.
_ATTRIBUTE_VALUES = {
    "hours_since__first_event": "a.n_orders * 24e0",
    "hours_since__modified": "a.c_acctbal",
    "hours_since__calculated": "a.c_acctbal / 4e0",
    "customer_events_count": "a.n_orders * 3e0",
    "se_click_rate": "a.n_urgent / (a.n_orders * 1e0)",
    "se_email_clicked_count": "a.n_urgent * 1e0",
    "hours_since__se_email_clicked_date_last": "case when a.n_urgent > 2 then a.n_urgent * 12e0 end",
    "se_email_read_count": "a.n_high * 1e0",
    "hours_since__se_email_read_date_last": "case when a.n_high > 1 then a.n_high * 36e0 end",
    "se_email_sent_count": "a.n_orders * 2e0",
    "hours_since__se_email_sent_date_last": "a.n_orders * 6e0",
    "se_engagement": "a.n_high / (a.n_orders * 1e0)",
    "se_events_count": "(a.n_urgent + a.n_high) * 1e0",
    "se_open_rate": "(a.n_urgent + a.n_high) / (a.n_orders * 1e0)",
    "me_events_count": "a.n_open * 5e0",
    "me_visits_count": "a.n_open * 1e0",
    "me_os_most_freq": "case when a.n_open > a.n_done then 'Android' when a.n_open < a.n_done then 'iOS' end",
    "me_page_views_avg": "a.n_open / (a.n_orders * 1e0)",
    "me_amount_spent_all": "a.max_price",
    "me_browser_most_freq": "a.c_mktsegment",
    "me_device_type_most_freq": "case when a.n_urgent > a.n_high then 'phone' else 'desktop' end",
    "me_device_model_most_freq": "a.first_priority",
    "me_device_brand_most_freq": "a.last_priority",
    "me_country": "a.r_name",
    "me_city": "a.n_name",
    "me_city_last": "case when a.n_orders > 9 then a.n_name end",
    "me_payment_most_freq": "a.first_status",
    "me_delivery_most_freq": "a.last_status",
    "me_device_model_most_freq_second": "case when a.n_orders > 8 then a.last_priority end",
    "me_device_brand_most_freq_second": "case when a.n_orders > 12 then a.first_priority end",
    "me_device_type_most_freq_second": "case when a.n_urgent > a.n_high then 'desktop' end",
    "me_amount_spent_avg": "a.min_price",
    "hours_since__me_transaction_datetime_first": "a.max_price / 8e0",
    "hours_since__me_transaction_datetime_last": "a.min_price / 8e0",
    "me_brand_purchase_most_freq": "a.c_mktsegment",
    "me_product_purchase_most_freq": "a.last_status",
    "me_product_viewed_most_freq": "a.first_status",
    "me_transaction_count": "case when a.n_orders > 3 then a.n_orders * 1e0 end",
    "me_engagement": "a.n_done / (a.n_orders * 1e0)",
    "me_spend_percentile_quintile": "case when a.max_price > 400000e0 then 5e0 else 3e0 end",
    "mx_gender_est_last": "case when a.c_acctbal > 5000e0 then 'f' when a.c_acctbal > 1000e0 then 'm' end",
    "mx_email_count_unique": "a.n_done * 1e0",
    "web_time_spent_sum": "a.n_open * 90e0",
    "hours_since__me_registration_date": "a.n_orders * 720e0",
}

_ATTRIBUTES = ",\n  ".join(
    f"cast({_ATTRIBUTE_VALUES[name]} as {'double' if kind == 'double' else 'string'}) as {name}"
    for name, kind in IDENTITY_ATTRIBUTES
)

INPUT_SQL: dict[str, str] = {
    "transactional_quantity": """
select cast(o.o_custkey as string) as customer_entity_id, p.p_brand as product_id,
       [order_ts] as purchase_dt, l.l_quantity as quantity
from {lineitem} l join {orders} o on o.o_orderkey = l.l_orderkey join {part} p on p.p_partkey = l.l_partkey""",
    "transactional_attributes": """
select cast(o.o_custkey as string) as customer_entity_id, [order_ts] as purchase_dt,
       cast(o.o_orderkey as string) as transaction_id, o.o_orderpriority as delivery_type,
       o.o_orderstatus as payment_type
from {orders} o""",
    "coupon_used": """
select cast(o.o_custkey as string) as customer_entity_id, cast(o.o_orderkey as string) as transaction_id,
       cast(l.l_suppkey as string) as voucher_id, [order_ts] as coupon_dt
from {lineitem} l join {orders} o on o.o_orderkey = l.l_orderkey""",
    "product_views": """
select cast(o.o_custkey as string) as customer_entity_id, [ship_ts] as viewed_dt, p.p_brand as product_id
from {lineitem} l join {orders} o on o.o_orderkey = l.l_orderkey join {part} p on p.p_partkey = l.l_partkey""",
    "utm_source": """
select cast(o.o_custkey as string) as customer_entity_id, [ship_ts] as source_dt,
       case o.o_orderpriority when '5-LOW' then null when '4-NOT SPECIFIED' then 'unknown'
            else o.o_orderpriority end as utm_source
from {lineitem} l join {orders} o on o.o_orderkey = l.l_orderkey""",
    "utm_medium": """
select cast(o.o_custkey as string) as customer_entity_id, [ship_ts] as medium_dt, n.n_name as utm_medium
from {lineitem} l join {orders} o on o.o_orderkey = l.l_orderkey
join {supplier} s on s.s_suppkey = l.l_suppkey join {nation} n on n.n_nationkey = s.s_nationkey""",
    "utm_campaign": """
select cast(o.o_custkey as string) as customer_entity_id, [ship_ts] as campaign_dt,
       case when s.s_acctbal >= 0 then cast(s.s_suppkey as string) end as utm_campaign
from {lineitem} l join {orders} o on o.o_orderkey = l.l_orderkey
join {supplier} s on s.s_suppkey = l.l_suppkey""",
    "banner_clicked": """
select cast(o.o_custkey as string) as customer_entity_id, [ship_ts] as clicked_dt,
       p.p_type as banner_name, cast(p.p_size as string) as banner_id
from {lineitem} l join {orders} o on o.o_orderkey = l.l_orderkey join {part} p on p.p_partkey = l.l_partkey""",
    "banner_impression": """
select cast(o.o_custkey as string) as customer_entity_id, [order_ts] as impression_dt,
       p.p_type as banner_name, cast(p.p_size as string) as banner_id
from {lineitem} l join {orders} o on o.o_orderkey = l.l_orderkey join {part} p on p.p_partkey = l.l_partkey""",
    "identity_identifiers": """
select cast(o.o_custkey as string) as customer_entity_id, cast(count(*) as double) as n_identifiers
from {orders} o group by o.o_custkey""",
    "identity_sources_raw": """
select cast(o.o_custkey as string) as customer_entity_id,
       case o.o_orderpriority when '1-URGENT' then 'magento' when '2-HIGH' then 'me_web'
            when '3-MEDIUM' then 'se' when '4-NOT SPECIFIED' then 'store' else 'phone' end as sources
from {orders} o""",
    "identity_attributes_raw": f"""
select a.customer_entity_id,
  {_ATTRIBUTES}
from (
  select cast(c.c_custkey as string) as customer_entity_id, c.c_acctbal, c.c_mktsegment, n.n_name, r.r_name,
         count(*) as n_orders,
         sum(case when o.o_orderpriority = '1-URGENT' then 1 else 0 end) as n_urgent,
         sum(case when o.o_orderpriority = '2-HIGH' then 1 else 0 end) as n_high,
         sum(case when o.o_orderstatus = 'O' then 1 else 0 end) as n_open,
         sum(case when o.o_orderstatus = 'F' then 1 else 0 end) as n_done,
         min(o.o_orderpriority) as first_priority, max(o.o_orderpriority) as last_priority,
         min(o.o_orderstatus) as first_status, max(o.o_orderstatus) as last_status,
         min(o.o_totalprice) as min_price, max(o.o_totalprice) as max_price
  from {{customer}} c join {{nation}} n on n.n_nationkey = c.c_nationkey
  join {{region}} r on r.r_regionkey = n.n_regionkey
  join {{orders}} o on o.o_custkey = c.c_custkey
  group by c.c_custkey, c.c_acctbal, c.c_mktsegment, n.n_name, r.r_name
) a""",
    "product_feed": """
select p.p_brand as item_id,
       case when min(p.p_size) > 1 then p.p_brand || ' > ' || min(p.p_type)
            else p.p_brand || ' > ' || min(p.p_type) || ' > ' || min(p.p_name) end as product_category,
       p.p_brand as brand, max(p.p_retailprice) as price
from {part} p group by p.p_brand""",
    "received_campaigns": """
select cast(e.user_id as string) as customer_entity_id, [event_ts] as received_dt,
       case when e.event_type <> 'error' then e.event_type end as automation_name, e.props as automation_id
from {events} e""",
    "opened_campaigns": """
select cast(e.user_id as string) as customer_entity_id, [event_ts] as opened_dt,
       case when e.value > 1 then e.event_type end as automation_name, e.props as automation_id
from {events} e""",
    "clicked_campaigns": """
select cast(e.user_id as string) as customer_entity_id, [event_ts] as clicked_dt,
       case when e.event_type = 'click' then e.event_type end as automation_name, e.props as automation_id
from {events} e""",
    "web_searches": """
select cast(e.user_id as string) as customer_entity_id, [event_ts] as search_dt,
       e.event_type as keywords, e.props as n_results
from {events} e""",
    "shop_orders": """
select cast(o.o_custkey as string) as customer_email, cast(l.l_partkey as string) as product_id__item,
       [order_ts] as created_at__item
from {lineitem} l join {orders} o on o.o_orderkey = l.l_orderkey""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spark_text(text: str) -> str:
    for word, expression in SPARK_WORDS.items():
        text = text.replace(word, expression)
    return text


def duck_text(text: str) -> str:
    for word, expression in DUCK_WORDS.items():
        text = text.replace(word, expression)
    return re.sub(r"\{(\w+)\}", r"\1", text)


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One reference-shaped input as a DataFrame."""
    configure(spark)
    text = INPUT_SQL[name]
    tables = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(spark_text(text), **tables)


_STAGED: dict[tuple[str, str, str], str] = {}


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input, or one of the tables the package itself derives from inputs."""
    if name == "replenishment_target":
        return replenishment_target(staged(spark, sf_dir, "transactional_quantity"))
    if name == "identity_sources":
        return identity_source_matrix(source(spark, sf_dir, "identity_sources_raw"), SOURCE_VALUES)
    if name == "identity_attributes":
        return identity_dimension(source(spark, sf_dir, "identity_attributes_raw"))
    if name == "identity_attributes_known":
        # Customers in debt have no attribute row, so the coverage filter has something to drop.
        return staged(spark, sf_dir, "identity_attributes").where("hours_since__modified >= 0")
    if name == "products":
        return product_dimension(source(spark, sf_dir, "product_feed"))
    if name == "modelling_data":
        return modelling_data(modelling_inputs(spark, sf_dir), ModellingSpec(staging=fresh_path(spark, "covered")))
    if name == "training_rows":
        return training_rows(spark, sf_dir)
    return source(spark, sf_dir, name)


def staged_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Path of the input as a Parquet table in the shared folder, written once per application.

    The loaders of the engine read tables that lie in storage; composite operators read such a
    table several times, so the star-schema joins behind it should not run each time.
    """
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGED:
        path = fresh_path(spark, name)
        settle(derived(spark, sf_dir, name), path)
        _STAGED[key] = path
    return _STAGED[key]


def staged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = staged_path(spark, sf_dir, name)
    return spark.read.parquet(path)


def modelling_inputs(spark: SparkSession, sf_dir: str) -> ModellingInputs:
    return ModellingInputs(**{
        field: staged(spark, sf_dir, name)
        for field, name in {
            "target": "replenishment_target",
            "purchases": "transactional_quantity",
            "views": "product_views",
            "utm_source": "utm_source",
            "utm_medium": "utm_medium",
            "utm_campaign": "utm_campaign",
            "banner_clicked": "banner_clicked",
            "banner_impression": "banner_impression",
            "identifiers": "identity_identifiers",
            "attributes": "identity_attributes_known",
            "sources": "identity_sources",
            "products": "products",
        }.items()
    })


TRAINING_SQL = """
select o.o_orderkey as row_id, ln(o.o_totalprice) as label, c.c_mktsegment as segment, n.n_name as nation,
       o.o_orderpriority as priority, c.c_acctbal as acctbal, o.o_totalprice / 1000e0 as price,
       cast(n.n_regionkey as double) as region_no, cast(c.c_custkey as double) as customer_no
from {orders} o join {customer} c on c.c_custkey = o.o_custkey join {nation} n on n.n_nationkey = c.c_nationkey"""


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with a label, categories and numbers, for the learning operators."""
    configure(spark)
    tables = {t: table(spark, sf_dir, t) for t in ("orders", "customer", "nation")}
    return spark.sql(TRAINING_SQL, **tables)
