"""Check SQL for the composite operators, in the plain shape of their definition.

Every target row is crossed with the top-k labels, joined to all events within twelve months
by ``months_between`` on full timestamps, and counted. The package computes the same results
from calendar days and running totals, so the two share no step but the input texts.
"""

from __future__ import annotations

from registry.inputs import INPUT_SQL, duck_text

WINDOWS = (1, 3, 6, 12)
KEY = "customer_entity_id, product_id, purchase_dt"


def months_between(a: str, b: str) -> str:
    """Spark's months_between as DuckDB SQL."""
    months = f"((year({a}) - year({b})) * 12 + month({a}) - month({b}))"
    seconds = lambda t: f"(hour({t}) * 3600 + minute({t}) * 60 + floor(second({t})))"
    return (
        f"(case when day({a}) = day({b}) or ({a}::date = last_day({a}::date) and {b}::date = last_day({b}::date))"
        f" then {months}::double"
        f" else round({months} + ((day({a}) - day({b})) * 86400 + {seconds(a)} - {seconds(b)}) / 2678400.0::double, 8)"
        f" end)"
    )


DERIVED = {
    "replenishment_target": f"""
select *, (epoch(purchase_dt) - epoch(last_purchase_dt)) / 86400.0::double as days_since_last_purchase
from (
  select {KEY}, lag(purchase_dt) over (partition by customer_entity_id, product_id order by purchase_dt)
         as last_purchase_dt
  from (select distinct {KEY} from transactional_quantity)
)
where last_purchase_dt is not null""",
    "identity_sources": """
select customer_entity_id, count(*) filter (sources = 'magento') as magento,
       count(*) filter (sources = 'me_web') as me_web, count(*) filter (sources = 'se') as se,
       count(*) filter (sources = 'store') as store, count(*) filter (sources = 'phone') as phone
from identity_sources_raw where customer_entity_id is not null group by customer_entity_id""",
    "identity_attributes_known": "select * from identity_attributes_raw where hours_since__modified >= 0",
    "products": """
select item_id,
       coalesce(trim(string_split(product_category, '>')[1]), 'Unknown') as first_category,
       coalesce(trim(string_split(product_category, '>')[2]), 'Unknown') as second_category,
       coalesce(trim(string_split(product_category, '>')[3]), 'Unknown') as third_category,
       brand, price
from product_feed""",
}

NEEDS = {
    "replenishment_target": ("transactional_quantity",),
    "identity_sources": ("identity_sources_raw",),
    "identity_attributes_known": ("identity_attributes_raw",),
    "products": ("product_feed",),
}


def with_inputs(names: list[str] | tuple[str, ...], body: str, **ctes: str) -> str:
    """A statement over named inputs: each becomes a CTE, with what it derives from before it."""
    ordered: dict[str, str] = {}

    def add(name: str) -> None:
        for need in NEEDS.get(name, ()):
            add(need)
        ordered.setdefault(name, DERIVED[name] if name in DERIVED else duck_text(INPUT_SQL[name]))

    for name in names:
        add(name)
    ordered.update(ctes)
    parts = ",\n".join(f"{name} as ({text.strip()})" for name, text in ordered.items())
    return f"with {parts}\n{body.strip()}"


def trailing_quantity() -> str:
    m = months_between("t.purchase_dt", "e.purchase_dt")
    sums = ", ".join(
        f"coalesce(sum(quantity * case when m between 0 and {w} then 1 else 0 end), 0)"
        f" as purchased_quantity_last{w}m" for w in WINDOWS
    )
    return f"""
select {KEY}, {sums} from (
  select t.customer_entity_id, t.product_id, t.purchase_dt, coalesce(e.quantity, 0) as quantity, {m} as m
  from replenishment_target t left join transactional_quantity e
    on t.customer_entity_id = e.customer_entity_id and t.product_id = e.product_id and {m} > 0 and {m} <= 12
) group by {KEY}"""


def trailing_views() -> str:
    m = months_between("t.purchase_dt", "e.viewed_dt")
    sums = ", ".join(
        f"cast(sum(case when m between 0 and {w} then 1 else 0 end) as bigint) as last{w}m_product_view"
        for w in WINDOWS
    )
    return f"""
select {KEY}, {sums} from (
  select t.customer_entity_id, t.product_id, t.purchase_dt, {m} as m
  from replenishment_target t left join product_views e
    on t.customer_entity_id = e.customer_entity_id and t.product_id = e.product_id and {m} between 0 and 12
) group by {KEY}"""


def top_labels(events: str, labels: list[str], k: int, keep_null: bool) -> str:
    cols = ", ".join(labels)
    order = "n_rows desc, " + ", ".join(f"{c} asc nulls first" for c in labels)
    where = "" if keep_null else "where " + " and ".join(f"{c} is not null" for c in labels)
    return f"""
select *, row_number() over (order by {order}) as rk
from (select {cols}, count(*) as n_rows from {events} {where} group by {cols} order by {order} limit {k})"""


def topk(events: str, ts: str, labels: list[str], match: str, k: int, mode: str, keep_null: bool,
         entity: str, kind: str) -> str:
    m = months_between("g.purchase_dt", f"e.{ts}")
    extra = "".join(f", s.{c}" for c in labels if c != match)
    extra_g = "".join(f", g.{c}" for c in labels if c != match)
    extra_k = "".join(f", {c}" for c in labels if c != match)
    if mode == "flag":
        per = ", ".join(f"count(distinct case when m between 0 and {w} then label end) as l{w}" for w in WINDOWS)
    else:
        per = ", ".join(f"sum(case when m between 0 and {w} then 1 else 0 end) as l{w}" for w in WINDOWS)
    wide = ", ".join(
        f"cast(coalesce(sum(case when rk = {r} then l{w} end), 0) as bigint) as {entity}_{r}__last{w}m_{kind}"
        for r in range(1, k + 1) for w in WINDOWS
    )
    return f"""
select {KEY}, {wide} from (
  select {KEY}, label, rk{extra_k}, {per} from (
    select g.customer_entity_id, g.product_id, g.purchase_dt, g.label, g.rk{extra_g}, {m} as m
    from (
      select t.customer_entity_id, t.product_id, t.purchase_dt, coalesce(s.{match}, 'unknown') as label,
             s.rk{extra}
      from ({top_labels(events, labels, k, keep_null).strip()}) s cross join replenishment_target t
    ) g left join {events} e
      on g.customer_entity_id = e.customer_entity_id and g.label = e.{match} and {m} between 0 and 12
  ) group by {KEY}, label, rk{extra_k}
) group by {KEY}"""


TOPK = {
    "utm_source": dict(ts="source_dt", labels=["utm_source"], match="utm_source", k=5, mode="flag",
                       keep_null=True, entity="source", kind="utm_source"),
    "utm_medium": dict(ts="medium_dt", labels=["utm_medium"], match="utm_medium", k=10, mode="flag",
                       keep_null=True, entity="medium", kind="utm_medium"),
    "utm_campaign": dict(ts="campaign_dt", labels=["utm_campaign"], match="utm_campaign", k=10, mode="flag",
                         keep_null=False, entity="campaign", kind="utm_campaign"),
    "banner_clicked": dict(ts="clicked_dt", labels=["banner_name", "banner_id"], match="banner_name", k=10,
                           mode="count", keep_null=False, entity="banner", kind="clicked_banner"),
    "banner_impression": dict(ts="impression_dt", labels=["banner_name", "banner_id"], match="banner_name", k=10,
                              mode="count", keep_null=False, entity="banner", kind="impression_banner"),
}


def topk_sql(events: str) -> str:
    return topk(events, **TOPK[events])


def topk_names(events: str) -> list[str]:
    c = TOPK[events]
    return [f"{c['entity']}_{r}__last{w}m_{c['kind']}" for r in range(1, c["k"] + 1) for w in WINDOWS]


def modelling_data(names: list[tuple[str, str]]) -> str:
    """The wide table as left joins from the target, with the filters on top."""
    text = {"first_category", "second_category", "third_category", "brand"}
    feature_sets = {
        "ppur": trailing_quantity(),
        "vw": trailing_views(),
        "clk": topk_sql("banner_clicked"),
        "imp": topk_sql("banner_impression"),
        "cmp": topk_sql("utm_campaign"),
        "med": topk_sql("utm_medium"),
        "src": topk_sql("utm_source"),
    }
    columns = [f"t.{c}" for c in (
        "customer_entity_id", "product_id", "purchase_dt", "last_purchase_dt", "days_since_last_purchase")]
    columns += [
        "round(ln(t.days_since_last_purchase), 6) as log_days_since_last_purchase",
        "round(avg(t.days_since_last_purchase) over (partition by t.product_id), 6)"
        " as longterm_average_since_last_purchase",
        "idi.n_identifiers",
        "coalesce(prd.price, 0) as price",
    ]
    columns += [f"coalesce(prd.{c}, 'Unknown') as {c}" for c in sorted(text)]
    columns += [
        f"coalesce(ida.{c}, " + ("0" if kind == "double" else "'Unknown'") + f") as {c}" for c, kind in names
    ]
    columns += [f"coalesce(ids.{c}, 0) as {c}" for c in ("magento", "me_web", "se")]
    columns += [f"ppur.purchased_quantity_last{w}m" for w in WINDOWS]
    columns += [f"vw.last{w}m_product_view" for w in WINDOWS]
    for alias, events in (("clk", "banner_clicked"), ("imp", "banner_impression"), ("cmp", "utm_campaign"),
                          ("med", "utm_medium"), ("src", "utm_source")):
        columns += [f"{alias}.{c}" for c in topk_names(events)]
    joins = "\n".join(
        f"left join {a} on t.customer_entity_id = {a}.customer_entity_id and t.product_id = {a}.product_id"
        f" and t.purchase_dt = {a}.purchase_dt" for a in feature_sets
    )
    matched = " and ".join(f"{a}.customer_entity_id is not null" for a in ("ida", "ids", *feature_sets))
    body = f"""
select {", ".join(columns)}
from replenishment_target t
left join identity_identifiers idi on t.customer_entity_id = idi.customer_entity_id
left join products prd on t.product_id = prd.item_id
left join identity_attributes_known ida on t.customer_entity_id = ida.customer_entity_id
left join identity_sources ids on t.customer_entity_id = ids.customer_entity_id
{joins}
where t.days_since_last_purchase > 20 and {matched}"""
    inputs = ["replenishment_target", "product_views", *TOPK, "identity_identifiers", "products",
              "identity_attributes_known", "identity_sources"]
    return with_inputs(inputs, body, **feature_sets)
