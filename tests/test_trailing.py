import random

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from refillcast.functions import window_start
from refillcast.operators import topk, trailing
from refillcast.operators.trailing import TARGET_KEY, WINDOWS, Channel
from refillcast.plans.target import (
    last_purchases, late_purchases, previous_purchase, replenishment_target, target_increment)

KEYS = ["customer_entity_id", "product_id"]
TARGET = "customer_entity_id string, product_id string, purchase_dt timestamp"
COUNTS = [f"last{w}m_view" for w in WINDOWS]


def target_of(spark, *data):
    return spark.createDataFrame([(c, p, at(t)) for c, p, t in data], TARGET)


def views_of(spark, *data):
    return spark.createDataFrame(
        [(c, p, at(t)) for c, p, t in data], "customer_entity_id string, product_id string, viewed_dt timestamp"
    )


def count_views(target, views, include_zero=True):
    return trailing.trailing_count(target, views, KEYS, "view", "viewed_dt", include_zero=include_zero)


@pytest.mark.parametrize("target, event, closed, strict", [
    ("2022-03-15 10:00", "2022-03-15 18:00", (1, 1, 1, 1), (0, 0, 0, 0)),
    ("2022-03-31 01:00", "2022-02-28 23:00", (1, 1, 1, 1), (1, 1, 1, 1)),
    ("2022-03-30 01:00", "2022-02-28 23:00", (0, 1, 1, 1), (0, 1, 1, 1)),
    ("2024-02-29", "2023-02-28", (0, 0, 0, 1), (0, 0, 0, 1)),
    ("2022-03-15", "2021-03-15", (0, 0, 0, 1), (0, 0, 0, 1)),
    ("2022-03-15", "2021-03-14", (0, 0, 0, 0), (0, 0, 0, 0)),
    ("2022-03-15 10:00", "2022-03-16 09:00", (0, 0, 0, 0), (0, 0, 0, 0)),
])
def test_window_edges(spark, target, event, closed, strict):
    t, v = target_of(spark, ("c", "p", target)), views_of(spark, ("c", "p", event))
    assert rows(count_views(t, v), *COUNTS) == [closed]
    assert rows(count_views(t, v, include_zero=False), *COUNTS) == [strict]


def test_duplicate_target_doubles_counts_not_flags(spark):
    t = target_of(spark, ("c", "p", "2022-03-15"), ("c", "p", "2022-03-15"))
    v = views_of(spark, ("c", "p", "2022-03-10"))
    assert rows(count_views(t, v), *COUNTS) == [(2, 2, 2, 2)]
    flags = trailing.trailing_flag(t, v, KEYS, "view", "viewed_dt")
    assert rows(flags, *COUNTS) == [(1, 1, 1, 1)]


def test_null_keys_never_match_but_stay(spark):
    t = target_of(spark, (None, "p", "2022-03-15"), ("c", "p", None))
    v = views_of(spark, (None, "p", "2022-03-15"), ("c", "p", None))
    assert rows(count_views(t, v), *COUNTS) == [(0, 0, 0, 0), (0, 0, 0, 0)]


def test_fractional_sums_leave_no_residue(spark):
    t = target_of(spark, ("c", "p", "2022-12-31"), ("c", "p", "2020-02-01"))
    bought = spark.createDataFrame(
        [("c", "p", at("2020-01-10"), 0.1), ("c", "p", at("2020-01-11"), 0.2), ("c", "p", at("2020-01-12"), None),
         ("c", "p", at("2020-01-13"), 1e15)],
        "customer_entity_id string, product_id string, purchase_dt timestamp, quantity double",
    )
    got = trailing.trailing_sum(t, bought, KEYS, "quantity", "q")
    assert rows(got, "q_last12m") == [(0.0,), (0.1 + 0.2 + 1e15,)]


def plain_counts(spark, target, events, ts):
    """Row-level left join on months_between, as the definition reads."""
    target.createOrReplaceTempView("plain_target")
    events.createOrReplaceTempView("plain_events")
    sums = ", ".join(f"sum(case when m between 0 and {w} then 1 else 0 end) as last{w}m_view" for w in WINDOWS)
    return spark.sql(f"""
      select customer_entity_id, product_id, purchase_dt, {sums} from (
        select t.*, months_between(t.purchase_dt, e.{ts}) as m from plain_target t left join plain_events e
          on t.customer_entity_id = e.customer_entity_id and t.product_id = e.product_id
          and months_between(t.purchase_dt, e.{ts}) between 0 and 12)
      group by 1, 2, 3""")


def random_time(rng):
    return f"{rng.choice((2019, 2020, 2021))}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}" \
           f" {rng.randint(0, 23):02d}:{rng.randint(0, 59):02d}"


def skewed(rng, n):
    """A third of the rows on one customer and product."""
    return [("hot", "p0", random_time(rng)) if i % 3 == 0 else
            (f"c{rng.randint(0, 9)}", f"p{rng.randint(0, 3)}", random_time(rng)) for i in range(n)]


def test_hot_key_equals_plain_join(spark):
    rng = random.Random(7)
    t, v = target_of(spark, *skewed(rng, 300)), views_of(spark, *skewed(rng, 900))
    assert rows(count_views(t, v), *TARGET_KEY, *COUNTS) == rows(
        plain_counts(spark, t, v, "viewed_dt"), *TARGET_KEY, *COUNTS)


def test_hot_key_is_bounded_by_days(spark):
    """However many rows a key has, the window step sees at most one row per day."""
    v = spark.range(20000).selectExpr(
        "'hot' as customer_entity_id", "'p' as product_id",
        "timestamp_seconds(1640995200 + id * 60) as viewed_dt", "1 as one")
    t = target_of(spark, ("hot", "p", "2022-01-20"))
    days = trailing.day_rows(t, v, KEYS, "viewed_dt", {"n": F.sum("one")})
    assert days.count() == v.select(F.to_date("viewed_dt")).union(t.select(F.to_date("purchase_dt"))).distinct().count()
    assert days.agg(F.sum("n")).first()[0] == 20000


def test_result_does_not_depend_on_partitioning(spark):
    rng = random.Random(3)
    t, v = target_of(spark, *skewed(rng, 120)), views_of(spark, *skewed(rng, 240))
    assert rows(count_views(t.repartition(1), v.repartition(7))) == rows(count_views(t.repartition(5), v.repartition(2)))


def test_windows_grow(spark):
    rng = random.Random(5)
    got = count_views(target_of(spark, *skewed(rng, 200)), views_of(spark, *skewed(rng, 400)))
    assert got.where("last1m_view > last3m_view or last3m_view > last6m_view or last6m_view > last12m_view").isEmpty()


def labelled(spark, *data):
    return spark.createDataFrame(
        [(c, at(t), x) for c, t, x in data], "customer_entity_id string, at timestamp, label string"
    )


def channel(k=2, mode="flag", keep_null=True, **more):
    return Channel("slot", "x", "at", ("label",), "label", k, mode, keep_null, **more)


def names(k, w=12):
    return [f"slot_{r}__last{w}m_x" for r in range(1, k + 1)]


def test_null_label_takes_a_slot_that_matches_the_literal(spark):
    events = labelled(
        spark, *[("n", "2022-01-01", None)] * 3, *[("c", "2022-03-01", "unknown")] * 2, ("c", "2022-03-01", "rare"))
    t = target_of(spark, ("c", "p", "2022-03-15"), ("n", "p", "2022-03-15"))
    got = trailing.topk_trailing(t, events, channel())
    assert rows(got, "customer_entity_id", *names(2)) == [("c", 1, 1), ("n", 0, 0)]
    known = trailing.topk_trailing(t, events, channel(keep_null=False))
    assert rows(known, "customer_entity_id", *names(2)) == [("c", 1, 1), ("n", 0, 0)]


def test_ties_go_to_the_smaller_label(spark):
    events = labelled(spark, ("c", "2022-03-01", "b"), ("d", "2022-03-01", "a"))
    ranked = trailing.ranked_labels(events, channel(k=1, keep_null=False))
    assert rows(ranked, "label", "rank") == [("a", 1)]


def test_fewer_labels_than_slots(spark):
    events = labelled(spark, ("c", "2022-03-01", "a"), ("c", "2022-03-02", "a"), ("c", "2022-03-02", "b"))
    got = trailing.topk_trailing(target_of(spark, ("c", "p", "2022-03-15")), events, channel(k=5, mode="count"))
    assert len(got.columns) == 3 + 5 * 4
    assert rows(got, *names(5)) == [(2, 1, 0, 0, 0)]


def test_ids_with_one_name_share_counts(spark):
    events = spark.createDataFrame(
        [("c", at("2022-03-01"), "n", "1"), ("c", at("2022-03-02"), "n", "1"), ("c", at("2022-03-02"), "n", "2")],
        "customer_entity_id string, at timestamp, name string, id string")
    ch = Channel("slot", "x", "at", ("name", "id"), "name", 3, "count")
    got = trailing.topk_trailing(target_of(spark, ("c", "p", "2022-03-15"), ("c", "p", "2022-03-15")), events, ch)
    assert rows(got, *names(3)) == [(6, 6, 0)]


def test_strictly_before_channel(spark):
    events = labelled(spark, ("c", "2022-03-15 08:00", "a"))
    t = target_of(spark, ("c", "p", "2022-03-15 10:00"))
    for mode in ("flag", "count"):
        open_day = trailing.topk_trailing(t, events, channel(k=1, mode=mode))
        before = trailing.topk_trailing(t, events, channel(k=1, mode=mode, include_zero=False))
        assert rows(open_day, *names(1)) == [(1,)] and rows(before, *names(1)) == [(0,)]


def test_more_flags_than_one_mask_holds(spark):
    labels = [f"l{i:03d}" for i in range(70)]
    events = labelled(spark, *[("c", "2022-03-01", x) for x in labels], *[("d", "2022-03-01", x) for x in labels[60:]])
    got = trailing.topk_trailing(target_of(spark, ("d", "p", "2022-03-15")), events, channel(k=70, keep_null=False))
    # The ten labels of two customers come first.
    assert rows(got, *names(70)) == [tuple([1] * 10 + [0] * 60)]


def test_stacked_channels_equal_single_ones(spark):
    rng = random.Random(11)
    pick = lambda n: [(f"c{rng.randint(0, 4)}", random_time(rng), rng.choice("abcd")) for _ in range(n)]
    t = target_of(spark, *[(f"c{rng.randint(0, 5)}", "p", random_time(rng)) for _ in range(60)])
    flags, counts = channel(k=3), channel(k=3, mode="count")
    e1, e2 = labelled(spark, *pick(80)), labelled(spark, *pick(80))
    both = trailing.channel_totals(t, [(flags, e1), (counts, e2)])
    outputs = trailing.channel_outputs([counts])
    single = trailing.per_target(t, trailing.channel_totals(t, [(counts, e2)]), ["customer_entity_id"], outputs)
    stacked = trailing.per_target(t, both, ["customer_entity_id"], outputs)
    assert rows(single) == rows(stacked)


def test_unknown_mode_is_rejected():
    with pytest.raises(ValueError):
        channel(mode="sum")


def test_densify_gives_every_entity(spark):
    slots = spark.createDataFrame([(1, "a"), (2, "b")], "rank int, label string")
    t = target_of(spark, ("c", "p", "2022-03-15"), ("d", "p", "2022-03-15"))
    assert topk.densify(t, slots, 5).count() == 4


def test_trailing_join_keeps_unmatched(spark):
    t = target_of(spark, ("c", "p", "2022-03-15"), ("d", "p", "2022-03-15"))
    v = views_of(spark, ("c", "p", "2022-03-01 08:00"), ("c", "p", "2022-03-01 09:00"), ("c", "p", "2020-01-01"))
    got = trailing.trailing_join(t, v, KEYS, "viewed_dt")
    assert [(r[0], str(r[1]), r[2]) for r in rows(got, "customer_entity_id", "event_day", "n_events")] == [
        ("c", "2022-03-01", 2), ("d", "None", None)]


def test_previous_purchase(spark):
    bought = target_of(
        spark, ("c", "p", "2022-01-01 08:00"), ("c", "p", "2022-01-01 08:00"), ("c", "p", "2022-01-01 09:00"),
        ("c", "p", "2022-02-01"), ("c", "q", "2022-02-01"))
    before = previous_purchase(bought).select(
        F.date_format("purchase_dt", "MM-dd HH"), "product_id", F.date_format("last_purchase_dt", "MM-dd HH"))
    assert rows(before) == [
        ("01-01 08", "p", None), ("01-01 09", "p", "01-01 08"), ("02-01 00", "p", "01-01 09"), ("02-01 00", "q", None)]
    gaps = replenishment_target(bought)
    assert sorted(r[0] for r in gaps.select("days_since_last_purchase").collect()) == [1 / 24, 30.625]


@pytest.mark.parametrize("include_zero", [True, False])
def test_running_totals_equal_the_window_test_on_every_day(spark, include_zero):
    """Fractional sums of every window against window_start, around month ends, a leap year and a century."""
    days = spark.sql("""
      select explode(sequence(date'1999-12-25', date'2001-03-31')) as day
      union all select explode(sequence(date'2022-12-25', date'2024-05-31'))""")
    target = days.selectExpr("'c' as customer_entity_id", "'p' as product_id", "cast(day as timestamp) as purchase_dt")
    bought = days.selectExpr(
        "'c' as customer_entity_id", "'p' as product_id", "cast(day as timestamp) + interval 5 hours as purchase_dt",
        "pmod(xxhash64(day), 1000) / 7 - 40 as quantity")
    got = trailing.trailing_sum(target, bought, KEYS, "quantity", "q", include_zero=include_zero)
    last = F.col("t.day") if include_zero else F.date_sub("t.day", 1)
    met = days.alias("t").join(bought.withColumn("day", F.to_date("purchase_dt")).alias("e"), F.col("e.day") <= F.col("t.day"), "left")
    want = met.groupBy("t.day").agg(*[
        F.coalesce(F.sum(F.when(F.col("e.day").between(window_start(F.col("t.day"), m), last), F.col("quantity"))), F.lit(0.0))
        .alias(f"q_last{m}m") for m in WINDOWS])
    names = [f"q_last{m}m" for m in WINDOWS]
    found = {r["day"]: r[1:] for r in got.select(F.to_date("purchase_dt").alias("day"), *names).collect()}
    asked = {r["day"]: r[1:] for r in want.select("day", *names).collect()}
    assert found.keys() == asked.keys()
    for day, values in asked.items():
        assert found[day] == pytest.approx(values, abs=1e-9), day


def test_sums_that_are_no_number(spark):
    t = target_of(spark, ("c", "p", "2022-03-15"), ("c", "p", "2022-06-20"), ("c", "q", "2022-03-15"))
    bought = spark.createDataFrame(
        [("c", "p", at("2022-03-01"), float("nan")), ("c", "p", at("2022-06-01"), -0.5), ("c", "q", at("2022-03-01"), 1e300)],
        "customer_entity_id string, product_id string, purchase_dt timestamp, quantity double")
    got = trailing.trailing_sum(t, bought, KEYS, "quantity", "q").orderBy("product_id", "purchase_dt").collect()
    assert [str(r["q_last1m"]) for r in got] == ["nan", "-0.5", "nan"]
    assert [str(r["q_last12m"]) for r in got] == ["nan", "nan", "nan"]


def test_plan_lists_nothing(spark, capsys):
    t, v = target_of(spark, ("c", "p", "2022-03-15")), views_of(spark, ("c", "p", "2022-03-10"))
    count_views(t, v).explain()
    plan = capsys.readouterr().out
    assert "collect_list" not in plan and "Window" in plan


@pytest.mark.parametrize("months, include_zero", [(12, True), (12, False), (1, True)])
def test_trailing_join_meets_two_buckets_at_most(spark, months, include_zero):
    """The pairs of the plain join, from at most two rows per target day before the join."""
    rng = random.Random(13)
    t, v = target_of(spark, *skewed(rng, 200)), views_of(spark, *skewed(rng, 600))
    got = trailing.trailing_join(t, v, KEYS, "viewed_dt", max_months=months, include_zero=include_zero)
    days, events = t.select(*KEYS, F.to_date("purchase_dt").alias("d")).distinct(), v.select(*KEYS, F.to_date("viewed_dt").alias("e"))
    far = F.months_between("d", "e")
    want = days.join(events, KEYS).where(far.between(0, months) & ((far > 0) | F.lit(include_zero)))
    assert rows(got.where("event_day is not null"), *KEYS, "target_day", "event_day", "n_events") == rows(
        want.groupBy(*KEYS, "d", "e").count())
    plan = got._jdf.queryExecution().optimizedPlan()
    generated = [line for line in plan.toString().splitlines() if "Generate" in line]
    assert len(generated) == 1 and "bucket" in generated[0] and "sequence" not in generated[0]


def purchases_of(spark, rng, n):
    data = [(rng.choice(["c", "d", None]), rng.choice(["p", "q", None]), at(random_time(rng)), 1.0) for _ in range(n)]
    data += [("c", "p", None, 1.0), ("c", "p", at("2020-06-01 10:00"), 1.0), ("c", "p", at("2020-06-01 10:00"), 2.0)]
    return spark.createDataFrame(data, "customer_entity_id string, product_id string, purchase_dt timestamp, quantity double")


def test_increments_equal_the_whole_build(spark):
    """Month after month, with the state handed on; NULL keys and repeated times included."""
    bought = purchases_of(spark, random.Random(21), 120)
    cuts = ["2019-01-01", "2019-07-01", "2020-06-01", "2020-06-02", "2022-01-01"]
    state, built = last_purchases(bought.where("false")), None
    for a, b in zip(cuts, cuts[1:]):
        batch = bought.where(f"purchase_dt >= '{a}' and purchase_dt < '{b}'")
        # The last batch's rows come again: times that the state knows are not counted twice.
        part = target_increment(state, batch.unionByName(batch))
        built = part if built is None else built.unionByName(part)
        state = last_purchases(batch, state)
    whole = replenishment_target(bought)
    assert rows(built.select(whole.columns)) == rows(whole) and whole.count() > 50
    assert late_purchases(state, bought).count() == bought.where("purchase_dt is not null").count() - bought.alias("b").join(
        state.alias("s"), F.expr("b.customer_entity_id <=> s.customer_entity_id and b.product_id <=> s.product_id"
                                 " and b.purchase_dt = s.last_purchase_dt"), "left_semi").count()


def test_counts_of_a_channel_around_month_ends(spark):
    """Counts of a slot equal those of the plain windows on every day of a leap year and its neighbours."""
    days = spark.sql("select explode(sequence(date'2022-12-25', date'2024-05-31')) as day")
    target = days.selectExpr("'c' as customer_entity_id", "'p' as product_id", "cast(day as timestamp) as purchase_dt")
    events = days.selectExpr(
        "'c' as customer_entity_id", "'p' as product_id", "cast(day as timestamp) as at", "'a' as label", "pmod(hash(day), 3) as n"
    ).selectExpr("*", "explode(sequence(0, n)) as nth")
    for include_zero in (True, False):
        got = trailing.topk_trailing(target, events, channel(k=1, mode="count", include_zero=include_zero))
        plain = trailing.trailing_count(target, events, KEYS, "view", "at", include_zero=include_zero)
        assert rows(got, "purchase_dt", *[f"slot_1__last{w}m_x" for w in WINDOWS]) == rows(plain, "purchase_dt", *COUNTS)


def test_target_days_stay_single_rows_in_channel_windows(spark):
    """No row per window and target day, and no aggregate over hundreds of columns behind the window."""
    events = labelled(spark, ("c", "2022-03-15 08:00", "a"))
    t = target_of(spark, ("c", "p", "2022-03-15 10:00"))
    plan = trailing.channel_totals(t, [(channel(mode="count"), events)])._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    window = next(i for i, line in enumerate(lines) if "Window [" in line and "adds" in line)
    assert "inline(" not in plan and not any("Aggregate" in line for line in lines[:window])


def test_previous_purchase_takes_one_exchange_and_no_groups(spark):
    """Repeated and NULL times included; no table of groups is built before the exchange."""
    null = None
    bought = target_of(
        spark, ("c", "p", null), ("c", "p", null), ("c", "p", "2022-01-01 08:00"), ("c", "p", "2022-01-01 08:00"),
        (null, "p", "2022-01-02"), (null, "p", "2022-01-03"), (null, null, null))
    got = previous_purchase(bought)
    assert rows(got, *[F.col(c).cast("string") for c in got.columns]) == rows(spark.createDataFrame([
        ("c", "p", null, null), ("c", "p", "2022-01-01 08:00:00", null), (null, "p", "2022-01-02 00:00:00", null),
        (null, "p", "2022-01-03 00:00:00", "2022-01-02 00:00:00"), (null, null, null, null)], "a string, b string, c string, d string"))
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "Aggregate" not in plan and plan.count("Window [") == 1


def test_rows_of_a_scan_and_of_a_shuffled_part_are_bounded(spark, tmp_path):
    """A staged file of some bytes a row is read in several tasks, so that none adds up ten million rows."""
    spark.range(9_000_000).selectExpr("xxhash64(id) as x").coalesce(1).write.option("compression", "none").parquet(str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).rdd.getNumPartitions() >= 3
    assert int(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) <= 32 << 20


def test_no_frame_slides(spark):
    """Frames start at the first row: one that slides copies every row of the key."""
    t, v = target_of(spark, ("c", "p", "2022-03-15")), views_of(spark, ("c", "p", "2022-03-10"))
    plan = count_views(t, v)._jdf.queryExecution().optimizedPlan().toString()
    assert "specifiedwindowframe(RangeFrame, unboundedpreceding$()" in plan and "specifiedwindowframe(RangeFrame, -" not in plan
