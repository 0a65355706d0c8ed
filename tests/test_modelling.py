import math
import time
from dataclasses import replace

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from refillcast.operators import joins, reshape
from refillcast.operators.trailing import channel_totals, topk_trailing
from refillcast.plans.dimensions import IDENTITY_ATTRIBUTES
from refillcast.plans.modelling import (
    BANNER_CLICKED,
    UTM_SOURCE,
    ModellingInputs,
    ModellingSpec,
    modelling_data,
    product_mean_gap,
)
from refillcast.plans.target import with_gap
from refillcast.session import fresh_path, settle


def frame(spark, data, schema):
    return spark.createDataFrame([tuple(at(v) if str(v)[:2] == "20" else v for v in row) for row in data], schema)


@pytest.fixture(scope="module")
def inputs(spark):
    key = "customer_entity_id string"
    target = with_gap(frame(spark, [
        ("c", "p", "2022-03-15", "2022-01-01"),
        ("c", "p", "2022-03-15", "2022-01-01"),   # the same row twice
        ("c", "q", "2022-03-01", "2022-02-09"),   # gap of exactly 20 days
        ("d", "p", "2022-05-01", "2022-01-01"),
        ("x", "p", "2022-05-01", "2022-01-01"),   # no attributes
        (None, "p", "2022-05-01", "2022-01-01"),
    ], f"{key}, product_id string, purchase_dt timestamp, last_purchase_dt timestamp"))
    attributes = spark.createDataFrame(
        [tuple([c] + [None] * len(IDENTITY_ATTRIBUTES)) for c in ("c", "d", "d")],   # d twice: fans out
        ", ".join([key, *[f"{n} {t}" for n, t in IDENTITY_ATTRIBUTES]]))
    label = lambda ts, *names: ", ".join([key, f"{ts} timestamp", *[f"{n} string" for n in names]])
    banners = [("c", "2022-03-01", "n", "1"), ("c", "2022-03-01", "n", "2")]
    return ModellingInputs(
        target=target,
        purchases=frame(spark, [("c", "p", "2022-03-01", 2.5), ("c", "p", "2022-03-15", 9.0)],
                        f"{key}, product_id string, purchase_dt timestamp, quantity double"),
        views=frame(spark, [("c", "2022-03-15", "p")], f"{key}, viewed_dt timestamp, product_id string"),
        utm_source=frame(spark, [("c", "2022-03-01", "a"), ("d", "2022-03-01", None)], label("source_dt", "utm_source")),
        utm_medium=frame(spark, [("c", "2022-03-01", "m")], label("medium_dt", "utm_medium")),
        utm_campaign=frame(spark, [("d", "2021-12-01", "k")], label("campaign_dt", "utm_campaign")),
        banner_clicked=frame(spark, banners, label("clicked_dt", "banner_name", "banner_id")),
        banner_impression=frame(spark, banners, label("impression_dt", "banner_name", "banner_id")),
        identifiers=spark.createDataFrame([("c", 3.0)], f"{key}, n_identifiers double"),
        attributes=attributes,
        sources=spark.createDataFrame([("c", 1, 0, 2), ("d", 0, 1, 0)], f"{key}, magento long, me_web long, se long"),
        products=spark.createDataFrame(
            [("q", "a", "b", "Unknown", "x", 2.5)],
            "item_id string, first_category string, second_category string, third_category string, brand string,"
            " price double"),
    )


def test_modelling_table(inputs):
    wide = modelling_data(inputs)
    assert len(wide.columns) == len(set(wide.columns)) == 248
    got = {}
    for r in wide.collect():
        got.setdefault(r["customer_entity_id"], []).append(r.asDict())
    assert {c: len(rs) for c, rs in got.items()} == {"c": 2, "d": 2}
    c, d = got["c"][0], got["d"][0]
    assert c["purchased_quantity_last1m"] == 5.0        # 2.5 for each copy, the same day left out
    assert c["last1m_product_view"] == 2                # the same day counts
    assert c["banner_1__last1m_clicked_banner"] == 4    # both events match by name, two copies
    assert c["banner_3__last12m_clicked_banner"] == 0
    assert c["medium_1__last1m_utm_medium"] == 1
    assert d["campaign_1__last6m_utm_campaign"] == 1 and d["campaign_1__last3m_utm_campaign"] == 0
    assert (c["brand"], c["price"], c["me_city"], c["se_open_rate"]) == ("Unknown", 0.0, "Unknown", 0.0)
    assert (c["n_identifiers"], d["n_identifiers"], c["se"], d["se"]) == (3.0, None, 2, 0)
    assert c["log_days_since_last_purchase"] == math.log(73)
    # Over output rows of the product: two of 73 days, two of 120 days.
    assert c["longterm_average_since_last_purchase"] == pytest.approx((73 * 2 + 120 * 2) / 4)


def test_staging_changes_nothing(spark, inputs):
    staged = modelling_data(inputs, ModellingSpec(staging=fresh_path(spark, "covered")))
    assert rows(staged) == rows(modelling_data(inputs))


def test_spec_sets_slots_and_windows(inputs):
    small = ModellingSpec(windows=(2,), utm_source=replace(UTM_SOURCE, k=1))
    cols = modelling_data(inputs, small).columns
    assert "source_1__last2m_utm_source" in cols and "source_2__last2m_utm_source" not in cols


def test_mean_gap_matches_window(spark, inputs):
    by_window = inputs.target.selectExpr(
        "product_id", "avg(days_since_last_purchase) over (partition by product_id) as m").distinct()
    assert rows(product_mean_gap(inputs.target)) == rows(by_window)


def test_pivot_undoes_unpivot(spark):
    wide = spark.createDataFrame([("a", 1, 2), ("b", 3, 4)], "k string, x long, y long")
    long = reshape.unpivot_windows(wide, ["k"], ["x", "y"])
    assert long.count() == 4
    assert rows(reshape.pivot_features(long, ["k"], ["x", "y"])) == rows(wide)


def test_pivot_counts_rows_and_null_label(spark):
    df = spark.createDataFrame([("c", "s"), ("c", "s"), ("c", None), (None, "s")], "k string, label string")
    assert rows(reshape.pivot_membership(df, "k", "label", ["s", "t", "null"])) == [("c", 2, 0, 1)]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert rows(joins.duplicate_keys(df, ["k"])) == [("a", 2)]


def test_feature_plans_have_no_cross_join(inputs):
    features = topk_trailing(inputs.target, inputs.utm_source, UTM_SOURCE)
    for df in (features, modelling_data(inputs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        for word in ("CartesianProduct", "NestedLoop", "Expand", "PythonUDF", "ArrowEval"):
            assert word not in plan


def test_target_is_filtered_before_feature_work(inputs):
    """Below the filter on the gap stands nothing but the target itself."""
    lines = modelling_data(inputs)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    found = [i for i, line in enumerate(lines) if "Filter" in line and "> 20.0" in line]
    assert found
    for i in found:
        end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
        below = " ".join(lines[i + 1 : end])
        assert not any(word in below for word in ("Join", "Aggregate", "Window"))


def test_channel_history_lists_nothing(inputs):
    channels = [(UTM_SOURCE, inputs.utm_source), (BANNER_CLICKED, inputs.banner_clicked)]
    plan = channel_totals(inputs.target, channels)._jdf.queryExecution().optimizedPlan().toString()
    # The ranks of a label (k rows in all) are the only list.
    assert plan.count("collect_list") == plan.count("collect_list(rank")


def test_hot_key_is_split_even_against_an_aggregate(spark):
    """A side that an aggregate left partitioned by the key still lets a hot partition split."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        left = spark.range(0, 120000, 1, 6).selectExpr(
            "if(id % 2 = 0, 'hot', cast(id as string)) as k", "uuid() as payload")
        right = spark.range(0, 120000, 1, 6).selectExpr(
            "if(id % 2 = 0, 'hot', cast(id as string)) as k").groupBy("k").count()
        plan = joins.join_hot(left, right, "k", "inner")._jdf.queryExecution()
        assert plan.toRdd().count() == 120000
        assert "skew=true" in plan.executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_product_totals_are_not_joined_back(inputs):
    """The target's rows go through the product's windows themselves."""
    plan = modelling_data(inputs)._jdf.queryExecution().optimizedPlan().toString()
    joins_on = [line for line in plan.splitlines() if "Join" in line]
    assert joins_on and not any("product_id" in line and "day#" in line for line in joins_on)


def test_staging_leaves_no_shuffles_and_one_exchange_to_join(spark, inputs, tmp_path):
    """What the last join meets is written, each table by a query of its own that drops its shuffle files."""
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false")
    wide = modelling_data(inputs, ModellingSpec(staging=str(tmp_path / "covered")))
    assert {p.name for p in tmp_path.iterdir()} == {"covered", "covered-products", "covered-windows", "covered-customers"}
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Aggregate" not in plan
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == before


def test_settled_rows_leave_only_their_table(spark, tmp_path):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {f for f in disk.getAllFiles().mkString("|").split("|") if "shuffle_" in f}
    before = shuffled()
    table = settle(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), str(tmp_path / "t"))
    left = shuffled()
    for _ in range(50):
        if not left - before:
            break
        time.sleep(0.1)
        left = shuffled()
    assert not left - before and table.count() == 7
