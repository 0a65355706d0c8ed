"""Every query with the SQL it is checked against (none where SQL cannot express it)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refillcast import learning as L
from refillcast.functions import (
    days_between,
    feature_name,
    fill_defaults,
    log_features,
    na_fill_zero,
    parse_ts,
    path_level,
    strip_fraction,
    to_double,
    window_flag,
)
from refillcast.operators import joins, reshape, topk, trailing, volume
from refillcast.operators.trailing import CUSTOMER, TARGET_KEY, WINDOWS
from refillcast.plans import dimensions, modelling, target as target_plan
from refillcast.session import configure, fresh_path
from refillcast.sources import (
    EXPORTS,
    load,
    load_product_config,
    read_delimited,
    replace_partitions,
    save_model,
    scan_orders,
    write_report,
    write_table,
)
from registry import oracle
from registry.inputs import (
    INPUT_SQL,
    SOURCE_VALUES,
    TRAINING_SQL,
    duck_text,
    modelling_inputs,
    source,
    staged,
    staged_path,
    table,
)
from registry.oracle import months_between, with_inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return register


def over(name: str, body: str) -> str:
    """Check SQL over one input, which the text calls ``t``."""
    return with_inputs([name], body.replace("{t}", name))


PRODUCT_KEYS = [CUSTOMER, "product_id"]
KEY = oracle.KEY


# --- Sources and sinks -------------------------------------------------------------------


def as_text(df: DataFrame) -> DataFrame:
    """All columns as export text, timestamps with a fraction."""
    def text(f: T.StructField):
        if isinstance(f.dataType, T.TimestampType):
            return F.concat(F.date_format(f.name, "yyyy-MM-dd HH:mm:ss"), F.lit(".123"))
        return F.col(f.name).cast("string")

    return df.select(*[text(f).alias(f.name) for f in df.schema.fields])


def export(spark: SparkSession, df: DataFrame, name: str, sep: str = ",") -> str:
    path = fresh_path(spark, f"export-{name}")
    as_text(df).write.option("header", True).option("sep", sep).csv(path)
    return path


TEXT_TS = "strftime({0}, '%Y-%m-%d %H:%M:%S') || '.123'"


@query("s01_read_delimited", over("transactional_quantity", f"""
select customer_entity_id, product_id, {TEXT_TS.format('purchase_dt')} as purchase_dt,
       cast(quantity as varchar) as quantity from {{t}}"""))
def s01(spark, sf):
    return read_delimited(spark, export(spark, source(spark, sf, "transactional_quantity"), "quantity"))


@query("s02_glob_scan", over("transactional_attributes", f"""
select customer_entity_id, {TEXT_TS.format('purchase_dt')} as purchase_dt, transaction_id, delivery_type,
       payment_type from {{t}}"""))
def s02(spark, sf):
    orders = as_text(source(spark, sf, "transactional_attributes"))
    path = fresh_path(spark, "export-parts")
    writer = lambda df: df.write.mode("append").option("header", True).option("sep", "~").csv(path)
    writer(orders.where("payment_type = 'O'"))
    writer(orders.where("not (payment_type <=> 'O')"))
    return read_delimited(spark, f"{path}/*.csv", sep="~")


@query("s03_multi_line", """
select cast(p_partkey as varchar) as item_id, p_name || chr(10) || p_type || ', ' || p_brand as note from part""")
def s03(spark, sf):
    notes = table(spark, sf, "part").selectExpr(
        "cast(p_partkey as string) as item_id", "p_name || char(10) || p_type || ', ' || p_brand as note"
    )
    return read_delimited(spark, export(spark, notes, "notes"), multi_line=True)


@query("s04_load", over("product_views", "select * from {t}"))
def s04(spark, sf):
    return load(spark, export(spark, source(spark, sf, "product_views"), "views"), "product_views")


@query("s05_parquet_scan", "select o_orderkey, o_custkey, o_totalprice from orders")
def s05(spark, sf):
    return spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")


UNTIL = dt.date(2000, 12, 31)
ORDERS_UNTIL = f"(select * from shop_orders where created_at__item <= timestamp '{UNTIL} 00:00:00')"


@query("s06_scan_orders", over("shop_orders", f"select * from {ORDERS_UNTIL}"))
def s06(spark, sf):
    return scan_orders(spark, staged_path(spark, sf, "shop_orders"), UNTIL)


@query("s08_write_table", over("identity_identifiers", "select * from {t}"))
def s08(spark, sf):
    path = fresh_path(spark, "table")
    write_table(source(spark, sf, "identity_identifiers"), path)
    return spark.read.parquet(path)


@query("s09_replace_table", over("utm_medium", "select * from {t}"))
def s09(spark, sf):
    path = fresh_path(spark, "replaced")
    write_table(source(spark, sf, "utm_source"), path)
    write_table(source(spark, sf, "utm_medium"), path)
    return spark.read.parquet(path)


@query("s09_replace_partitions", over("transactional_quantity", """
select customer_entity_id, product_id, purchase_dt, case when year(purchase_dt) = 1995 then -quantity else quantity end as quantity,
       cast(year(purchase_dt) as int) as bought_in from {t} where purchase_dt is not null"""))
def s09_partitions(spark, sf):
    """A table by year of which one year is replaced; the other years stay."""
    path, columns = fresh_path(spark, "by-year"), ["customer_entity_id", "product_id", "purchase_dt", "quantity", "bought_in"]
    rows = staged(spark, sf, "transactional_quantity").where("purchase_dt is not null").withColumn("bought_in", F.year("purchase_dt"))
    replace_partitions(rows.select(columns), path, "bought_in")
    replace_partitions(rows.where("bought_in = 1995").withColumn("quantity", -F.col("quantity")).select(columns), path, "bought_in")
    return spark.read.parquet(path).select(columns)


@query("s10_write_report", over("products", """
select item_id, first_category, second_category, third_category, brand, cast(price as varchar) as price from {t}"""))
def s10(spark, sf):
    path = write_report(staged(spark, sf, "products"), fresh_path(spark, "report"), dt.date(2024, 1, 31))
    return read_delimited(spark, path, sep="~")


@query("s12_product_config", """
select cast(p_partkey as varchar) as PRODUCT_ID, case when p_size = 1 then 'NA' else p_name end as NAME,
       case when p_size < 30 then p_size end as REPLENISHMENT_DAYS, p_size < 30 as IS_DEFINED from part""")
def s12(spark, sf):
    path = fresh_path(spark, "config")
    table(spark, sf, "part").selectExpr(
        "'  ' || p_partkey || ' ' as PRODUCT_ID",
        "case when p_size = 1 then 'NA' else p_name end as NAME",
        "case when p_size < 30 then cast(p_size as string) else 'NA' end as REPLENISHMENT_DAYS",
        "case when p_size < 30 then 'yes' else 'no' end as IS_DEFINED",
    ).write.option("header", True).option("quoteAll", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return load_product_config(spark, path)


# Export name -> (input it is written from, check SQL).
_SECOND = "date_trunc('second', {0}) as {0}"
_CAMPAIGN = "select customer_entity_id, {0}, automation_name, automation_id from {1} where automation_name is not null"
_ATTR_SQL = ", ".join(
    f"coalesce({n}, 'Unknown') as {n}" if kind == "string"
    else f"coalesce({n}, 0) as {n}" if n == "me_transaction_count" else n
    for n, kind in dimensions.IDENTITY_ATTRIBUTES
)
LOADERS: dict[str, tuple[str, str]] = {
    "replenishment_target": ("replenishment_target", "select * from replenishment_target"),
    "identity_identifiers": ("identity_identifiers", "select * from identity_identifiers"),
    "identity_sources": ("identity_sources_raw", "select customer_entity_id, magento, me_web, se from identity_sources"),
    "transactional_quantity": ("transactional_quantity", "select * from transactional_quantity"),
    "transactional_attributes": ("transactional_attributes", "select * from transactional_attributes"),
    "coupon_used": ("coupon_used", "select * from coupon_used"),
    "products": ("product_feed", "select * from products"),
    "identity_attributes": (
        "identity_attributes_raw", f"select customer_entity_id, {_ATTR_SQL} from identity_attributes_raw"),
    "received_campaigns": (
        "received_campaigns", _CAMPAIGN.format(_SECOND.format("received_dt"), "received_campaigns")),
    "opened_campaigns": ("opened_campaigns", _CAMPAIGN.format(_SECOND.format("opened_dt"), "opened_campaigns")),
    "clicked_campaigns": ("clicked_campaigns", _CAMPAIGN.format(_SECOND.format("clicked_dt"), "clicked_campaigns")),
    "utm_source": ("utm_source", "select * from utm_source"),
    "utm_medium": ("utm_medium", "select * from utm_medium"),
    "utm_campaign": ("utm_campaign", "select * from utm_campaign"),
    "product_views": ("product_views", "select * from product_views"),
    "banner_clicked": ("banner_clicked", "select * from banner_clicked"),
    "banner_impression": ("banner_impression", "select * from banner_impression"),
    "web_searches": (
        "web_searches",
        f"select customer_entity_id, {_SECOND.format('search_dt')}, keywords, n_results from web_searches"),
}


def _loader(name: str, written: str) -> Query:
    def run(spark, sf):
        raw = source(spark, sf, written) if written in INPUT_SQL else staged(spark, sf, written)
        if name == "replenishment_target":
            raw = raw.drop("days_since_last_purchase")
        return load(spark, export(spark, raw, name, EXPORTS[name].sep), name)

    return run


for _i, (_name, (_written, _sql)) in enumerate(LOADERS.items(), 1):
    _needs = {"identity_sources": "identity_sources", "products": "products"}.get(_name, _written)
    query(f"s13_l{_i:02d}_{_name}", with_inputs([_needs], _sql))(_loader(_name, _written))


# --- Projections and scalars -------------------------------------------------------------

SHIPPED = """
select l.l_orderkey, l.l_linenumber, l.l_quantity, o.o_orderpriority as label,
       cast(o.o_custkey as string) as customer_entity_id, [order_ts] as order_ts, [ship_ts] as ship_ts
from {lineitem} l join {orders} o on o.o_orderkey = l.l_orderkey"""
INPUT_SQL["shipped"] = SHIPPED


@query("p01_project", "select c_custkey as customer_entity_id, c_name as customer_name from customer")
def p01(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_entity_id"), F.col("c_name").alias("customer_name")
    )


EVENT_TEXT = "case when event_type = 'error' then 'junk' else cast(ts as varchar) end"


def event_texts(spark, sf):
    return table(spark, sf, "events").selectExpr(
        "event_id", "case when event_type = 'error' then 'junk' else cast(ts as string) end as at"
    )


@query("p02_strip_fraction", f"select event_id, split_part({EVENT_TEXT}, '.', 1) as at from events")
def p02(spark, sf):
    return event_texts(spark, sf).select("event_id", strip_fraction("at").alias("at"))


@query("p03_parse_ts", f"select event_id, try_cast(split_part({EVENT_TEXT}, '.', 1) as timestamp) as at from events")
def p03(spark, sf):
    return event_texts(spark, sf).select("event_id", parse_ts("at").alias("at"))


@query("p04_days_between", over("shipped", """
select l_orderkey, l_linenumber, (epoch(ship_ts) - epoch(order_ts)) / 86400.0::double as days from {t}"""))
def p04(spark, sf):
    return source(spark, sf, "shipped").select(
        "l_orderkey", "l_linenumber", days_between("ship_ts", "order_ts").alias("days")
    )


@query("p05_to_double", """
select o_orderkey, case when o_orderstatus in ('F', 'P') then null else o_totalprice end as price from orders""")
def p05(spark, sf):
    texts = table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "case o_orderstatus when 'F' then '' when 'P' then 'n/a' else cast(o_totalprice as string) end as price",
    )
    return texts.select("o_orderkey", to_double("price").alias("price"))


@query("p06_path_level", """
select p_partkey, p_brand as level_0, coalesce(case when p_size > 10 then p_type end, 'Unknown') as level_1,
       'Unknown' as level_2 from part""")
def p06(spark, sf):
    paths = table(spark, sf, "part").selectExpr(
        "p_partkey", "case when p_size > 10 then p_brand || ' > ' || p_type else p_brand end as path"
    )
    return paths.select("p_partkey", *[path_level("path", i).alias(f"level_{i}") for i in range(3)])


def gaps_in_orders(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "case when o_orderstatus = 'F' then o_totalprice end as price",
        "case when o_orderstatus = 'O' then o_orderpriority end as priority",
    )


@query("p07_fill_defaults", """
select o_orderkey, coalesce(case when o_orderstatus = 'F' then o_totalprice end, 0) as price,
       coalesce(case when o_orderstatus = 'O' then o_orderpriority end, 'Unknown') as priority from orders""")
def p07(spark, sf):
    return fill_defaults(gaps_in_orders(spark, sf))


@query("p08_na_fill_zero", """
select o_orderkey, coalesce(case when o_orderstatus = 'F' then o_totalprice end, 0) as price,
       case when o_orderstatus = 'O' then o_orderpriority end as priority from orders""")
def p08(spark, sf):
    return na_fill_zero(gaps_in_orders(spark, sf))


@query("p09_months_between", over("shipped", f"""
select l_orderkey, l_linenumber, {months_between('ship_ts', 'order_ts')} as months from {{t}}"""))
def p09(spark, sf):
    return source(spark, sf, "shipped").select(
        "l_orderkey", "l_linenumber", F.months_between("ship_ts", "order_ts").alias("months")
    )


_FLAGS = {w: f"case when {months_between('ship_ts', 'order_ts')} between 0 and {w} then 1 else 0 end" for w in WINDOWS}


def flags():
    return {f"last{w}m": window_flag("ship_ts", "order_ts", w) for w in WINDOWS}


@query("p10_window_flag", over("shipped", "select l_orderkey, l_linenumber, "
       + ", ".join(f"{text} as last{w}m" for w, text in _FLAGS.items()) + " from {t}"))
def p10(spark, sf):
    return source(spark, sf, "shipped").select(
        "l_orderkey", "l_linenumber", *[c.alias(name) for name, c in flags().items()]
    )


@query("p11_product", over("shipped", "select l_orderkey, l_linenumber, "
       + ", ".join(f"l_quantity * {text} as quantity_last{w}m" for w, text in _FLAGS.items()) + " from {t}"))
def p11(spark, sf):
    return source(spark, sf, "shipped").select(
        "l_orderkey", "l_linenumber", *[(F.col("l_quantity") * c).alias(f"quantity_{n}") for n, c in flags().items()]
    )


@query("p12_feature_names", over("utm_medium", "select utm_medium, "
       + ", ".join(f"concat('medium_', rk, '__last{w}m_utm_medium') as name_{w}m" for w in WINDOWS)
       + f" from ({oracle.top_labels('utm_medium', ['utm_medium'], 10, True)})"))
def p12(spark, sf):
    ranked = trailing.ranked_labels(source(spark, sf, "utm_medium"), modelling.UTM_MEDIUM)

    def named(w: int):
        # The same name feature_name gives for a fixed rank, with the rank taken from the row.
        head, tail = feature_name("medium", 0, w, "utm_medium").split("0", 1)
        return F.concat(F.lit(head), F.col("rank").cast("string"), F.lit(tail)).alias(f"name_{w}m")

    return ranked.select("utm_medium", *[named(w) for w in WINDOWS])


@query("p13_literals", "select o_orderkey, 1 as in_source, 'n_emails' as val_type from orders")
def p13(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.lit(1).alias("in_source"), F.lit("n_emails").alias("val_type")
    )


@query("p14_log_label", over("replenishment_target", f"""
select {KEY}, round(ln(days_since_last_purchase), 6) as log_days from {{t}}"""))
def p14(spark, sf):
    return staged(spark, sf, "replenishment_target").select(
        *TARGET_KEY, F.round(F.log("days_since_last_purchase"), 6).alias("log_days")
    )


# Natural log, unrounded; rounded where it is the result.
LOG = "case when {0} <= 0 then 0 else ln(case when {0} > 0 then {0} end) end"
GUARDED = "round(case when {0} <= 0 then 0 else ln(case when {0} > 0 then {0} end) end, 6)"


@query("p15_log_features", f"""
select c_custkey, c_acctbal, {GUARDED.format('c_acctbal')} as log__c_acctbal from customer""")
def p15(spark, sf):
    logged = log_features(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])
    return logged.withColumn("log__c_acctbal", F.round("log__c_acctbal", 6))


@query("p16_to_date", over("shipped", "select l_orderkey, l_linenumber, cast(ship_ts as date) as day from {t}"))
def p16(spark, sf):
    return source(spark, sf, "shipped").select("l_orderkey", "l_linenumber", F.to_date("ship_ts").alias("day"))


@query("p17_year_month", over("shipped", """
select l_orderkey, l_linenumber, cast(year(ship_ts) as integer) as y, cast(month(ship_ts) as integer) as m from {t}"""))
def p17(spark, sf):
    return source(spark, sf, "shipped").select(
        "l_orderkey", "l_linenumber", F.year("ship_ts").alias("y"), F.month("ship_ts").alias("m")
    )


@query("p18_drop", "select c_custkey, c_name from customer")
def p18(spark, sf):
    return table(spark, sf, "customer").drop("c_nationkey", "c_acctbal", "c_mktsegment")


@query("p19_derived_tables", """
select n_orders, count(*) as n_customers from (select o_custkey, count(*) as n_orders from orders group by 1) group by 1
""")
def p19(spark, sf):
    per_customer = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    return per_customer.groupBy("n_orders").agg(F.count(F.lit(1)).alias("n_customers"))


# --- Filters -----------------------------------------------------------------------------


@query("f01_not_null", over("utm_campaign", "select * from {t} where utm_campaign is not null"))
def f01(spark, sf):
    return source(spark, sf, "utm_campaign").where(F.col("utm_campaign").isNotNull())


@query("f02_both_not_null", over("received_campaigns", """
select * from {t} where automation_name is not null and automation_id is not null"""))
def f02(spark, sf):
    return source(spark, sf, "received_campaigns").where(
        F.col("automation_name").isNotNull() & F.col("automation_id").isNotNull()
    )


@query("f03_min_gap", over("replenishment_target", "select * from {t} where days_since_last_purchase > 20"))
def f03(spark, sf):
    return staged(spark, sf, "replenishment_target").where(F.col("days_since_last_purchase") > 20)


@query("f04_until", f"select o_orderkey, o_orderdate from orders where o_orderdate <= timestamp '{UNTIL} 00:00:00'")
def f04(spark, sf):
    return table(spark, sf, "orders").where(F.col("o_orderdate") <= F.lit(str(UNTIL)).cast("timestamp_ntz")).select(
        "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate")
    )


@query("f05_coverage", with_inputs(
    ["replenishment_target", "identity_attributes_known", "identity_sources"], f"""
select t.customer_entity_id, t.product_id, t.purchase_dt, s.magento, a.me_city
from replenishment_target t left join identity_attributes_known a on t.customer_entity_id = a.customer_entity_id
left join identity_sources s on t.customer_entity_id = s.customer_entity_id
where a.customer_entity_id is not null and s.customer_entity_id is not null"""))
def f05(spark, sf):
    return joins.require_all(
        staged(spark, sf, "replenishment_target").select(*TARGET_KEY),
        staged(spark, sf, "identity_attributes_known").select(CUSTOMER, "me_city"),
        staged(spark, sf, "identity_sources").select(CUSTOMER, "magento"),
        key=CUSTOMER,
    )


@query("f06_between", over("shipped", f"""
select l_orderkey, l_linenumber from {{t}} where {months_between('ship_ts', 'order_ts')} between 0 and 1"""))
def f06(spark, sf):
    return source(spark, sf, "shipped").where(F.months_between("ship_ts", "order_ts").between(0, 1)).select(
        "l_orderkey", "l_linenumber"
    )


_KEPT = [n for n in L.NUM_FEATURES if n in dict(dimensions.IDENTITY_ATTRIBUTES)]


@query("f07_select_features", over("identity_attributes_raw", "select customer_entity_id, "
       + ", ".join("coalesce(me_transaction_count, 0) as me_transaction_count" if n == "me_transaction_count" else n
                   for n, kind in dimensions.IDENTITY_ATTRIBUTES if n in _KEPT) + " from {t}"))
def f07(spark, sf):
    attributes = staged(spark, sf, "identity_attributes")
    return attributes.select(CUSTOMER, *[n for n in L.select_features(L.candidate_num_features()) if n in attributes.columns])


# --- Joins -------------------------------------------------------------------------------


@query("j01_join_dim", with_inputs(["replenishment_target", "products"], f"""
select {KEY}, p.first_category, p.price from replenishment_target t left join products p on t.product_id = p.item_id"""))
def j01(spark, sf):
    dim = staged(spark, sf, "products").select("item_id", "first_category", "price")
    return joins.join_dim(staged(spark, sf, "replenishment_target").select(*TARGET_KEY), dim, "product_id", "item_id")


def quantity_features(spark, sf):
    return trailing.trailing_sum(
        staged(spark, sf, "replenishment_target"), staged(spark, sf, "transactional_quantity"), PRODUCT_KEYS,
        "quantity", "purchased_quantity",
    )


def view_features(spark, sf):
    return trailing.trailing_count(
        staged(spark, sf, "replenishment_target"), staged(spark, sf, "product_views"), PRODUCT_KEYS, "product_view",
        "viewed_dt",
    )


_FEATURE_JOIN = """
select t.*, q.purchased_quantity_last3m, v.last3m_product_view from replenishment_target t
{0} join qty q on t.customer_entity_id = q.customer_entity_id and t.product_id = q.product_id
  and t.purchase_dt = q.purchase_dt
{0} join vws v on t.customer_entity_id = v.customer_entity_id and t.product_id = v.product_id
  and t.purchase_dt = v.purchase_dt"""


def feature_join_sql(how: str) -> str:
    return with_inputs(["replenishment_target", "product_views"], _FEATURE_JOIN.format(how),
                       qty=oracle.trailing_quantity(), vws=oracle.trailing_views())


def feature_join(spark, sf, how):
    return joins.join_features(
        staged(spark, sf, "replenishment_target"),
        quantity_features(spark, sf).select(*TARGET_KEY, "purchased_quantity_last3m"),
        view_features(spark, sf).select(*TARGET_KEY, "last3m_product_view"),
        how=how,
    )


@query("j02_join_features", feature_join_sql("left"))
def j02(spark, sf):
    return feature_join(spark, sf, "left")


@query("j06_inner_features", feature_join_sql("inner"))
def j06(spark, sf):
    return feature_join(spark, sf, "inner")


_DAY_PAIRS = """
select {k}, t.target_day, e.event_day, e.n_events
from (select distinct {k0}, date_trunc('day', purchase_dt) as target_day from {targets}) t
left join (select {k0}, date_trunc('day', {ts}) as event_day, count(*) as n_events from {events} group by all) e
  on {on} and {m} {bound}"""


def day_pairs(targets: str, events: str, ts: str, keys: list[str], bound: str) -> str:
    text = _DAY_PAIRS.format(
        k=", ".join(f"t.{c}" for c in keys), k0=", ".join(keys), targets=targets, events=events, ts=ts, bound=bound,
        on=" and ".join(f"t.{c} = e.{c}" for c in keys), m=months_between("t.target_day", "e.event_day"),
    )
    return f"select * replace (cast(target_day as date) as target_day, cast(event_day as date) as event_day) from ({text})"


@query("j03_trailing_join", with_inputs(["replenishment_target"], day_pairs(
    "replenishment_target", "transactional_quantity", "purchase_dt", PRODUCT_KEYS, "> 0 and e.event_day is not null and "
    + months_between("t.target_day", "e.event_day") + " <= 12")))
def j03(spark, sf):
    return trailing.trailing_join(
        staged(spark, sf, "replenishment_target"), staged(spark, sf, "transactional_quantity"), PRODUCT_KEYS,
        "purchase_dt", include_zero=False,
    )


_SLOTS = oracle.top_labels("utm_source", ["utm_source"], 5, True)


@query("j04_channel_join", with_inputs(["replenishment_target", "utm_source"], day_pairs(
    "grid", "utm_source", "source_dt", [CUSTOMER, "utm_source"], "between 0 and 12"), grid=f"""
select t.customer_entity_id, t.purchase_dt, coalesce(s.utm_source, 'unknown') as utm_source
from replenishment_target t cross join ({_SLOTS}) s"""))
def j04(spark, sf):
    events = staged(spark, sf, "utm_source")
    slots = trailing.ranked_labels(events, modelling.UTM_SOURCE).select(
        "rank", F.coalesce("utm_source", F.lit(topk.UNKNOWN_LABEL)).alias("utm_source")
    )
    grid = topk.densify(staged(spark, sf, "replenishment_target").select(CUSTOMER, "purchase_dt"), slots, 5)
    return trailing.trailing_join(grid, events, [CUSTOMER, "utm_source"], "source_dt")


@query("j05_densify", with_inputs(["replenishment_target", "utm_source"], f"""
select {KEY}, s.utm_source, cast(s.rk as integer) as rank, s.n_rows
from replenishment_target t cross join ({_SLOTS}) s"""))
def j05(spark, sf):
    slots = trailing.ranked_labels(staged(spark, sf, "utm_source"), modelling.UTM_SOURCE)
    return topk.densify(staged(spark, sf, "replenishment_target").select(*TARGET_KEY), slots, 5)


# --- Aggregations ------------------------------------------------------------------------


@query("a01_label_counts", over("utm_source", "select utm_source, count(*) as n_rows from {t} group by 1"))
def a01(spark, sf):
    return topk.entity_counts(source(spark, sf, "utm_source"), ["utm_source"], keep_null=True)


@query("a01_label_counts_known", over("utm_campaign", """
select utm_campaign, count(*) as n_rows from {t} where utm_campaign is not null group by 1"""))
def a01_known(spark, sf):
    return topk.entity_counts(source(spark, sf, "utm_campaign"), ["utm_campaign"])


@query("a02_pair_counts", over("banner_clicked", """
select banner_name, banner_id, count(*) as n_rows from {t}
where banner_name is not null and banner_id is not null group by 1, 2"""))
def a02(spark, sf):
    return topk.entity_counts(source(spark, sf, "banner_clicked"), ["banner_name", "banner_id"])


@query("a03_weighted_sum", over("shipped", "select customer_entity_id, "
       + ", ".join(f"coalesce(sum(l_quantity * {t}), 0) as quantity_last{w}m" for w, t in _FLAGS.items())
       + " from {t} group by 1"))
def a03(spark, sf):
    return source(spark, sf, "shipped").groupBy(CUSTOMER).agg(
        *[F.coalesce(F.sum(F.col("l_quantity") * c), F.lit(0.0)).alias(f"quantity_{n}") for n, c in flags().items()]
    )


@query("a04_conditional_count", over("shipped", "select customer_entity_id, "
       + ", ".join(f"cast(sum({t}) as bigint) as n_last{w}m" for w, t in _FLAGS.items()) + " from {t} group by 1"))
def a04(spark, sf):
    return source(spark, sf, "shipped").groupBy(CUSTOMER).agg(*[F.sum(c).alias(f"n_{n}") for n, c in flags().items()])


@query("a05_conditional_distinct", over("shipped", "select customer_entity_id, label, "
       + ", ".join(f"count(distinct case when {t} = 1 then label end) as any_last{w}m" for w, t in _FLAGS.items())
       + " from {t} group by 1, 2"))
def a05(spark, sf):
    return source(spark, sf, "shipped").groupBy(CUSTOMER, "label").agg(
        *[F.max(c).cast("long").alias(f"any_{n}") for n, c in flags().items()]
    )


_DAILY = "select cast(created_at__item as date) as created_at, {0} as tmp_value from shop_orders group by 1"
# The volume series of the reports end at the cut-off date; their pieces take all orders.
_DAILY_UNTIL = _DAILY.replace("shop_orders", ORDERS_UNTIL)
N_ROWS, N_CUSTOMERS = "count(*)", "count(distinct customer_email)"


def all_orders(spark, sf):
    return scan_orders(spark, staged_path(spark, sf, "shop_orders"))


def orders_until(spark, sf):
    return scan_orders(spark, staged_path(spark, sf, "shop_orders"), UNTIL)


@query("a06_daily_counts", over("shop_orders", _DAILY.format(N_ROWS)))
def a06(spark, sf):
    return volume.daily_counts(all_orders(spark, sf), "created_at__item")


@query("a07_daily_uniques", over("shop_orders", _DAILY.format(N_CUSTOMERS)))
def a07(spark, sf):
    return volume.daily_uniques(all_orders(spark, sf), "created_at__item", "customer_email")


_STATUS = ("F", "O", "P")


@query("a08_pivot_sum", "select o_custkey, " + ", ".join(
    f"coalesce(sum(case when o_orderstatus = '{s}' then 1 end), 0)::bigint as {s}" for s in _STATUS)
    + " from orders group by 1")
def a08(spark, sf):
    ones = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", F.lit(1).alias("one"))
    return na_fill_zero(reshape.pivot_features(ones, ["o_custkey"], _STATUS, "o_orderstatus", "one"))


CATS = ["segment", "nation", "priority"]
TRAINING = {"train": duck_text(TRAINING_SQL)}


def ranks_sql(cat: str) -> str:
    return (f"select {cat} as value, '{cat}' as cat, count(*) as n_rows,"
            f" cast(row_number() over (order by count(*) desc, {cat}) - 1 as integer) as idx from train group by 1")


def training_sql(body: str, **ctes: str) -> str:
    return with_inputs([], body, **TRAINING, **ctes)


_NUMBERS: dict[tuple[str, str], DataFrame] = {}


def numbers(spark, sf) -> DataFrame:
    """The numbered category labels, written once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _NUMBERS:
        _NUMBERS[key] = L.number_categories(staged(spark, sf, "training_rows"), CATS)
    return _NUMBERS[key]


def indexed(spark, sf):
    return L.index_rows(staged(spark, sf, "training_rows"), numbers(spark, sf), CATS)


@query("a09_category_frequencies", training_sql(" union all ".join(
    f"select cat as orig_feature_name, value as feature_name, idx as category_index, n_rows from ({ranks_sql(c)})"
    for c in CATS)))
def a09(spark, sf):
    return L.category_frequencies(indexed(spark, sf), CATS)


@query("a10_offsets", training_sql("""
select cat as orig_feature_name, count(*)::int as n_slots, min(id)::int as first_id from (
""" + " union all ".join(
    f"select cat, value, idx + {' + '.join(['0', *[f'(select count(distinct {p}) from train)' for p in CATS[:i]]])}"
    f" as id from ({ranks_sql(c)})" for i, c in enumerate(CATS)) + ") group by 1"))
def a10(spark, sf):
    categories = dictionary(spark, sf).where("feature_type = 'categorical_attributes'")
    return categories.groupBy("orig_feature_name").agg(
        F.count(F.lit(1)).cast("int").alias("n_slots"), F.min("feature_id").alias("first_id")
    )


NUMS = ["acctbal", "price", "region_no"]
LOGGED = [f"log__{c}" for c in NUMS]


@query("a11_min_max", training_sql("select " + ", ".join(
    f"min({c}) as min_{c}, max({c}) as max_{c}" for c in NUMS) + " from train"))
def a11(spark, sf):
    return staged(spark, sf, "training_rows").agg(
        *[f(c).alias(f"{n}_{c}") for c in NUMS for n, f in (("min", F.min), ("max", F.max))]
    )


# --- Windows, top-k, reshape -------------------------------------------------------------


@query("w01_rank_entities", over("utm_medium", "select utm_medium, n_rows, cast(rk as integer) as rank from ("
       + oracle.top_labels("utm_medium", ["utm_medium"], 10, True) + ")"))
def w01(spark, sf):
    return trailing.ranked_labels(source(spark, sf, "utm_medium"), modelling.UTM_MEDIUM)


@query("w02_product_mean_gap", over("replenishment_target", f"""
select {KEY}, round(avg(days_since_last_purchase) over (partition by product_id), 6)
       as longterm_average_since_last_purchase
from {{t}} where days_since_last_purchase > 20"""))
def w02(spark, sf):
    live = staged(spark, sf, "replenishment_target").where("days_since_last_purchase > 20")
    return joins.join_dim(live, modelling.product_mean_gap(live), "product_id").select(
        *TARGET_KEY, F.round("longterm_average_since_last_purchase", 6).alias("longterm_average_since_last_purchase")
    )


@query("w03_monthly_mean", over("shop_orders", f"""
select created_at, tmp_value, round(avg(tmp_value) over (partition by year(created_at), month(created_at)), 6)
       as month_mean from ({_DAILY.format(N_ROWS)})"""))
def w03(spark, sf):
    daily = volume.daily_counts(all_orders(spark, sf), "created_at__item")
    return volume.monthly_mean(daily).withColumn("month_mean", F.round("month_mean", 6))


@query("w04_previous_purchase", over("transactional_quantity", f"""
select {KEY}, lag(purchase_dt) over (partition by customer_entity_id, product_id order by purchase_dt)
       as last_purchase_dt from (select distinct {KEY} from {{t}})"""))
def w04(spark, sf):
    return target_plan.previous_purchase(source(spark, sf, "transactional_quantity"))


@query("o01_top_k", over("banner_clicked", """
select banner_name, banner_id, count(*) as n_rows from {t}
where banner_name is not null and banner_id is not null
group by 1, 2 order by n_rows desc, banner_name, banner_id limit 10"""))
def o01(spark, sf):
    return topk.top_k_entities(source(spark, sf, "banner_clicked"), ["banner_name", "banner_id"], 10)


_SERIES = """
select created_at, 'avg_daily_emails' as val_type,
       round(avg(tmp_value) over (partition by year(created_at), month(created_at)), 6) as value from ({0})
union all
select created_at, 'n_emails', tmp_value::double from ({0})"""


def series_sql(metric: str, daily: str = _DAILY) -> str:
    return over("shop_orders", _SERIES.format(daily.format(metric)))


def series(orders, metric):
    return volume.daily_vs_monthly(orders, metric).withColumn("value", F.round("value", 6))


@query("o02_order_series", series_sql(N_ROWS))
def o02(spark, sf):
    return series(all_orders(spark, sf), "rows").orderBy("created_at", "val_type")


@query("r01_pivot_membership", over("identity_sources", "select * from {t}"))
def r01(spark, sf):
    return reshape.pivot_membership(source(spark, sf, "identity_sources_raw"), CUSTOMER, "sources", SOURCE_VALUES)


_QTY_COLS = [f"purchased_quantity_last{w}m" for w in WINDOWS]


@query("r02_pivot_features", with_inputs(["replenishment_target"], oracle.trailing_quantity()))
def r02(spark, sf):
    long = reshape.unpivot_windows(quantity_features(spark, sf), TARGET_KEY, _QTY_COLS)
    return reshape.pivot_features(long, TARGET_KEY, _QTY_COLS)


@query("r03_unpivot_windows", with_inputs(["replenishment_target"], " union all ".join(
    f"select {KEY}, '{c}' as name, {c} as value from wide" for c in _QTY_COLS), wide=oracle.trailing_quantity()))
def r03(spark, sf):
    return reshape.unpivot_windows(quantity_features(spark, sf), TARGET_KEY, _QTY_COLS)


@query("r04_long_union", over("shop_orders", f"""
select created_at, 'rows' as val_type, tmp_value from ({_DAILY.format(N_ROWS)}) union all
select created_at, 'customers', tmp_value from ({_DAILY.format(N_CUSTOMERS)})"""))
def r04(spark, sf):
    orders = all_orders(spark, sf)
    return reshape.long_union(
        volume.daily_counts(orders, "created_at__item").withColumn("val_type", F.lit("rows")),
        volume.daily_uniques(orders, "created_at__item", "customer_email").withColumn("val_type", F.lit("customers")),
    )


# --- Composite features ------------------------------------------------------------------


@query("replenishment_target", over("replenishment_target", "select * from {t}"))
def c01(spark, sf):
    return target_plan.replenishment_target(staged(spark, sf, "transactional_quantity"))


@query("w04_incremental_target", over("replenishment_target", "select * from {t}"))
def w04_increments(spark, sf):
    """The target in two increments, with the state of the first written in between."""
    purchases = staged(spark, sf, "transactional_quantity")
    early, late = purchases.where("purchase_dt < timestamp'1995-06-17'"), purchases.where("purchase_dt >= timestamp'1995-06-17'")
    path = fresh_path(spark, "last-purchases")
    write_table(target_plan.last_purchases(early), path)
    state = spark.read.parquet(path)
    return target_plan.replenishment_target(early).unionByName(target_plan.target_increment(state, late))


@query("trailing_quantity", with_inputs(["replenishment_target"], oracle.trailing_quantity()))
def c02(spark, sf):
    return quantity_features(spark, sf)


@query("trailing_views", with_inputs(["replenishment_target", "product_views"], oracle.trailing_views()))
def c04(spark, sf):
    return view_features(spark, sf)


def _channel(events: str, channel: trailing.Channel) -> Query:
    return lambda spark, sf: trailing.topk_trailing(
        staged(spark, sf, "replenishment_target"), staged(spark, sf, events), channel
    )


for _name, _events, _ch in (
    ("utm_source_flags", "utm_source", modelling.UTM_SOURCE),
    ("utm_medium_flags", "utm_medium", modelling.UTM_MEDIUM),
    ("utm_campaign_flags", "utm_campaign", modelling.UTM_CAMPAIGN),
    ("banner_click_counts", "banner_clicked", modelling.BANNER_CLICKED),
    ("banner_impression_counts", "banner_impression", modelling.BANNER_IMPRESSION),
):
    query(_name, with_inputs(["replenishment_target", _events], oracle.topk_sql(_events)))(_channel(_events, _ch))


@query("identity_source_matrix", over("identity_sources", "select customer_entity_id, magento, me_web, se from {t}"))
def c06(spark, sf):
    return dimensions.identity_source_matrix(source(spark, sf, "identity_sources_raw"))


@query("product_dimension", over("products", "select * from {t}"))
def c07(spark, sf):
    return dimensions.product_dimension(as_text(source(spark, sf, "product_feed")))


@query("identity_dimension", over("identity_attributes_raw", f"select customer_entity_id, {_ATTR_SQL} from {{t}}"))
def c08(spark, sf):
    return dimensions.identity_dimension(as_text(source(spark, sf, "identity_attributes_raw")))


def rounded_modelling_data(spark, sf):
    spec = modelling.ModellingSpec(staging=fresh_path(spark, "covered"))
    wide = modelling.modelling_data(modelling_inputs(spark, sf), spec)
    return wide.withColumns({
        c: F.round(c, 6) for c in ("log_days_since_last_purchase", "longterm_average_since_last_purchase")
    })


@query("modelling_data", oracle.modelling_data(dimensions.IDENTITY_ATTRIBUTES))
def c09(spark, sf):
    return rounded_modelling_data(spark, sf)


@query("daily_volume", series_sql(N_ROWS, _DAILY_UNTIL))
def c10(spark, sf):
    return series(orders_until(spark, sf), "rows")


@query("daily_customers", series_sql(N_CUSTOMERS, _DAILY_UNTIL))
def c11(spark, sf):
    return series(orders_until(spark, sf), "customers")


# --- Learning ----------------------------------------------------------------------------


@query("m01_log_features", training_sql(f"select row_id, {GUARDED.format('acctbal')} as log__acctbal from train"))
def m01(spark, sf):
    return log_features(staged(spark, sf, "training_rows"), ["acctbal"]).select(
        "row_id", F.round("log__acctbal", 6).alias("log__acctbal")
    )


@query("m02_index_categories", training_sql(
    "select t.row_id, " + ", ".join(f"{c}_r.idx::double as {c}__index" for c in CATS) + " from train t "
    + " ".join(f"join ({ranks_sql(c)}) {c}_r on {c}_r.value = t.{c}" for c in CATS)))
def m02(spark, sf):
    return indexed(spark, sf).select("row_id", *[f"{c}__index" for c in CATS])


@query("m03_one_hot", training_sql(
    "select t.row_id, " + ", ".join(
        f"(select count(distinct {c}) from train)::int as {c}_slots, {c}_r.idx as {c}_slot" for c in CATS)
    + " from train t " + " ".join(f"join ({ranks_sql(c)}) {c}_r on {c}_r.value = t.{c}" for c in CATS)))
def m03(spark, sf):
    rows = indexed(spark, sf)
    encoded = L.one_hot(CATS).fit(rows).transform(rows)
    slots = [(c, vector_to_array(f"{c}__encoded")) for c in CATS]
    return encoded.select(
        "row_id",
        *[F.size(v).alias(f"{c}_slots") for c, v in slots],
        *[(F.array_position(v, F.lit(1.0)) - 1).cast("int").alias(f"{c}_slot") for c, v in slots],
    )


def vectors(spark, sf):
    return L.assemble(NUMS).transform(staged(spark, sf, "training_rows"))


def spread(df: DataFrame, vector: str) -> DataFrame:
    array = vector_to_array(vector)
    return df.select("row_id", *[F.round(array[i], 6).alias(c) for i, c in enumerate(NUMS)])


@query("m04_assemble", training_sql("select row_id, " + ", ".join(f"round({c}, 6) as {c}" for c in NUMS) + " from train"))
def m04(spark, sf):
    return spread(vectors(spark, sf), "features")


_SCALED = {
    "m05a_minmax": ("minmax", "({0} - min({0}) over ()) / (max({0}) over () - min({0}) over ())"),
    "m05b_standard": ("standard", "{0} / stddev_samp({0}) over ()"),
    "m05c_maxabs": ("maxabs", "{0} / max(abs({0})) over ()"),
    "m05d_normalizer": ("normalizer", "{0} / sqrt(" + " + ".join(f"{c} * {c}" for c in NUMS) + ")"),
}


def _scaled(name: str) -> Query:
    def run(spark, sf):
        rows = vectors(spark, sf)
        stage = L.scaler(name)
        return spread((stage.fit(rows) if hasattr(stage, "fit") else stage).transform(rows), "scaled_features")

    return run


for _name, (_scaler, _text) in _SCALED.items():
    query(_name, training_sql(
        "select row_id, " + ", ".join(f"round({_text.format(c)}, 6) as {c}" for c in NUMS) + " from train"
    ))(_scaled(_scaler))


SCORED = [*NUMS, "customer_no"]


@query("m06_select_top", training_sql("""
select feature_id from (
  select feature_id, row_number() over (order by r * r / (1 - r * r) * (n - 2) desc) as place from (
""" + " union all ".join(
    f"select {i}::int as feature_id, corr({c}, label) as r, count(*) as n from train" for i, c in enumerate(SCORED))
    + ")) where place <= 2"))
def m06(spark, sf):
    rows = L.assemble(SCORED).setOutputCol("scaled_features").transform(staged(spark, sf, "training_rows"))
    chosen = L.select_top(2, "label").fit(rows).selectedFeatures
    return spark.createDataFrame([(int(i),) for i in chosen], "feature_id int")


def preprocessing(spark, sf):
    rows = log_features(indexed(spark, sf), NUMS)
    stages = L.preprocess(CATS, LOGGED, "label", "minmax", L.ElasticNetSpec().top_features, indexed=True)
    return stages.fit(rows), rows


def slot_sql(cat: str) -> str:
    """value and feature_id of one column's categories."""
    before = CATS[: CATS.index(cat)]
    offset = " + ".join(["0", *[f"(select count(distinct {p}) from train)" for p in before]])
    return f"select value, (idx + {offset})::int as feature_id from ({ranks_sql(cat)})"


N_CATEGORY_SLOTS = " + ".join(f"(select count(distinct {c}) from train)" for c in CATS)
# Long rows of the scaled vector: the slots that are not zero.
def scaled_sql(number: str) -> str:
    return " union all ".join(
        [f"select t.row_id, s.feature_id, 1e0 as value from train t join ({slot_sql(c)}) s on s.value = t.{c}" for c in CATS]
        + [f"select row_id, ({N_CATEGORY_SLOTS} + {i})::int as feature_id,"
           f" (x - min(x) over ()) / (max(x) over () - min(x) over ()) as value"
           f" from (select row_id, {number.format(c)} as x from train)" for i, c in enumerate(NUMS)])


@query("m07_preprocess", training_sql(
    "select row_id, feature_id, round(value, 4) as value from scaled where round(value, 4) <> 0", scaled=scaled_sql(LOG)))
def m07(spark, sf):
    model, rows = preprocessing(spark, sf)
    slots = F.posexplode(vector_to_array("selected_features")).alias("feature_id", "value")
    return model.transform(rows).select("row_id", slots).select(
        "row_id", "feature_id", F.round("value", 4).alias("value")).where("value <> 0")


@query("m08_single_feature_fit", training_sql("""
select round(regr_slope(label, price), 6) as slope, round(regr_intercept(label, price), 6) as intercept from train"""))
def m08(spark, sf):
    rows = L.assemble(["price"]).setOutputCol("selected_features").transform(staged(spark, sf, "training_rows"))
    model = L.elastic_net("label").fit(rows)
    return spark.createDataFrame(
        [(round(float(model.coefficients[0]), 6), round(model.intercept, 6))], "slope double, intercept double"
    )


@query("m10_evaluate", training_sql("""
select round(sqrt(avg((log10(price + 1) * 3 + 7 - label) ** 2)), 6) as rmse from train"""))
def m10(spark, sf):
    rows = staged(spark, sf, "training_rows").withColumn("prediction", F.log10(F.col("price") + 1) * 3 + 7)
    return spark.createDataFrame([(round(L.evaluate(rows, "label"), 6),)], "rmse double")


# The full grid and folds on one feature, where every fit has a closed form: the slope is the soft-thresholded
# covariance over the variance plus penalty; the quadratic part is scaled by the label's deviation.
SPEC = L.ElasticNetSpec()
FOLD_SQL = "(" + " + ".join(
    f"(strpos('0123456789abcdef', substr(md5('{SPEC.seed}|v' || row_id), {i}, 1)) - 1)::bigint * {16 ** (8 - i)}"
    for i in range(1, 9)) + f") % {SPEC.folds}"
_POINTS = ", ".join(f"({float(m)}::double, {float(p)}::double)" for m in SPEC.elastic_net_param for p in SPEC.reg_param)
_FIT = """select {0}, mix, pen, ybar - slope * xbar as intercept, slope from (
  select *, sign(cxy) * greatest(abs(cxy) - mix * pen, 0) / (vx + (1 - mix) * pen / sy) as slope from ({1}) cross join points)"""
_MOMENTS = ("avg(price) as xbar, avg(label) as ybar, covar_pop(price, label) as cxy, var_pop(price) as vx,"
            " stddev_pop(label) as sy")
CV_CTES = {
    "points": f"select * from (values {_POINTS}) p(mix, pen)",
    "folded": f"select row_id, label, price, ({FOLD_SQL})::int as fold from train",
    "folds": "select distinct fold from folded",
    "parts": f"select f.fold, {_MOMENTS} from folds f join folded t on t.fold <> f.fold group by f.fold",
    "fold_fits": _FIT.format("fold", "select * from parts"),
    "fold_errors": """select mix, pen, f.fold, sqrt(avg((label - intercept - slope * price) ** 2)) as rmse
from fold_fits f join folded t on t.fold = f.fold group by mix, pen, f.fold""",
    "scores": "select mix, pen, avg(rmse) as rmse from fold_errors group by mix, pen",
    "best": "select mix, pen from scores order by rmse, mix, pen limit 1",
    "best_fit": _FIT.format("1 as one", f"select {_MOMENTS} from train") + " where (mix, pen) in (select (mix, pen) from best)",
}
_CV: dict[tuple[str, str], CrossValidatorModel] = {}


def single_feature(spark, sf) -> DataFrame:
    rows = staged(spark, sf, "training_rows").withColumn("fold", L.fold_of(["row_id"], SPEC.folds, SPEC.seed))
    return L.assemble(["price"]).setOutputCol("selected_features").transform(rows)


def cross_validated(spark, sf) -> CrossValidatorModel:
    """The whole grid on all folds, fitted once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _CV:
        model = L.elastic_net("label")
        points = L.grid(model, SPEC.elastic_net_param, SPEC.reg_param)
        _CV[key] = L.cross_validate(single_feature(spark, sf), model, points, SPEC.folds, parallelism=8)
    return _CV[key]


@query("m11_cross_validate", training_sql(
    "select mix as elastic_net_param, pen as reg_param, round(rmse, 6) as rmse from scores", **CV_CTES))
def m11(spark, sf):
    cv = cross_validated(spark, sf)
    names = [{p.name: v for p, v in point.items()} for point in cv.getEstimatorParamMaps()]
    return spark.createDataFrame(
        [(float(n["elasticNetParam"]), float(n["regParam"]), round(float(m), 6)) for n, m in zip(names, cv.avgMetrics)],
        "elastic_net_param double, reg_param double, rmse double",
    )


@query("m11_fold_sizes", training_sql("select fold, count(*) as n_rows from folded group by 1", **CV_CTES))
def m11_folds(spark, sf):
    return single_feature(spark, sf).groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"))


_PREDICTED = "select t.row_id, {0}round(intercept + slope * price, 6) as prediction from train t cross join best_fit"


@query("m15_predict", training_sql(_PREDICTED.format("round(label, 6) as label, "), **CV_CTES))
def m15(spark, sf):
    return L.predict(cross_validated(spark, sf), single_feature(spark, sf)).select(
        "row_id", F.round("label", 6).alias("label"), F.round("prediction", 6).alias("prediction"))


@query("s11_save_model", training_sql(_PREDICTED.format(""), **CV_CTES))
def s11(spark, sf):
    path = save_model(cross_validated(spark, sf), fresh_path(spark, "model"), dt.date(2024, 1, 31))
    return L.predict(CrossValidatorModel.load(path), single_feature(spark, sf)).select(
        "row_id", F.round("prediction", 6).alias("prediction"))


def dictionary(spark, sf):
    model, rows = preprocessing(spark, sf)
    return L.feature_dictionary(model, rows, CATS, LOGGED, numbers=numbers(spark, sf))


@query("m12_feature_dictionary", training_sql(" union all ".join(
    f"select value as feature_name, cat as orig_feature_name,"
    f" (idx + {' + '.join(['0', *[f'(select count(distinct {p}) from train)' for p in CATS[:i]]])})::int as feature_id"
    f" from ({ranks_sql(c)})" for i, c in enumerate(CATS))))
def m12(spark, sf):
    return dictionary(spark, sf).where("feature_type = 'categorical_attributes'").select(
        "feature_name", "orig_feature_name", "feature_id"
    )


@query("m13_slot_ranges", training_sql(" union all ".join(
    f"select 'log__{c}' as feature_name, round(min(x), 6) as min, round(max(x), 6) as max"
    f" from (select {GUARDED.format(c)} as x from train)" for c in NUMS)))
def m13(spark, sf):
    return dictionary(spark, sf).where("feature_type = 'numerical_attributes'").select(
        "feature_name", F.round("min", 6).alias("min"), F.round("max", 6).alias("max")
    )


ESTIMATED_AT = dt.datetime(2024, 1, 31)
_FITTED: dict[tuple[str, str], L.FittedModel] = {}


def fitted(spark, sf) -> L.FittedModel:
    """The default specification, all grid points and folds, on the whole table; once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FITTED:
        _FITTED[key] = L.fit_replenishment_model(
            staged(spark, sf, "modelling_data"), L.ElasticNetSpec(parallelism=8), ESTIMATED_AT)
    return _FITTED[key]


@query("m14_coefficient_report")
def m14(spark, sf):
    return fitted(spark, sf).report


def dictionary_sql(prefix: str, number: str, applied: str) -> str:
    return " union all ".join(
        [f"select value as feature_name, '{c}' as orig_feature_name, 'categorical_attributes' as feature_type, feature_id,"
         f" '{applied}' as apply_log, 0e0 as min, 1e0 as max from ({slot_sql(c)})" for c in CATS]
        + [f"select '{prefix}{c}', '{prefix}{c}', 'numerical_attributes', ({N_CATEGORY_SLOTS} + {i})::int, '{applied}',"
           f" (select round(min(x), 6) from (select {number.format(c)} as x from train)),"
           f" (select round(max(x), 6) from (select {number.format(c)} as x from train))" for i, c in enumerate(NUMS)])


# Without logarithms: that of the price is the label itself up to a constant.
@query("j07_report_join", training_sql("""
select d.feature_id, d.feature_name, d.orig_feature_name, case when s.feature_id is not null then 1 end as is_selected,
       round(s.slope, 6) as coefficients, round(s.intercept, 6) as intercept
from dictionary d left join (select * from fits where place = 1) s on s.feature_id = d.feature_id""",
    scaled=scaled_sql("{0}"), dictionary=dictionary_sql("", "{0}", "Log Not Applied"),
    dense="""select t.row_id, t.label, d.feature_id, coalesce(s.value, 0) as value
from train t cross join (select feature_id from dictionary) d
left join scaled s on s.row_id = t.row_id and s.feature_id = d.feature_id""",
    fits="""select feature_id, regr_slope(label, value) as slope, regr_intercept(label, value) as intercept,
       row_number() over (order by abs(corr(label, value)) desc) as place from dense group by feature_id"""))
def j07(spark, sf):
    rows = staged(spark, sf, "training_rows")
    model = L.preprocess(CATS, NUMS, "label", "minmax", 1).fit(rows)
    data = model.transform(rows)
    regression = L.elastic_net("label").fit(data)
    report = L.coefficient_report(
        L.feature_dictionary(model, data, CATS, NUMS, False), model, regression, "minmax", ESTIMATED_AT)
    return report.select("feature_id", "feature_name", "orig_feature_name", "is_selected",
                         F.round("coefficients", 6).alias("coefficients"), F.round("intercept", 6).alias("intercept"))


@query("r05_dictionary", training_sql("select * from dictionary", dictionary=dictionary_sql("log__", GUARDED, "Log Applied")))
def r05(spark, sf):
    return dictionary(spark, sf).withColumns({c: F.round(c, 6) for c in ("min", "max")})


@query("m17_fit_replenishment_model")
def m17(spark, sf):
    path = fresh_path(spark, "master-data")
    write_table(fitted(spark, sf).data, path)
    return spark.read.parquet(path).select(
        *TARGET_KEY, L.ElasticNetSpec().label, vector_to_array("selected_features").alias("selected_features")
    )
