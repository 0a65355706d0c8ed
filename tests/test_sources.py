import datetime as dt

import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from refillcast.session import fresh_path
from refillcast.sources import (
    EXPORTS,
    land,
    load,
    load_product_config,
    read_delimited,
    replace_partitions,
    scan_orders,
    write_report,
    write_table,
)


def write(path, name, text):
    (path / name).write_text(text, encoding="utf-8")
    return str(path / name)


def test_everything_is_text(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'id,n,note\n1,2.5,"x, y"\n,,\n')
    df = read_delimited(spark, path)
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}
    assert rows(df) == [("1", "2.5", "x, y"), (None, None, None)]


def test_glob_and_separator(spark, tmp_path):
    write(tmp_path, "a.csv", "id~n\n1~2\n")
    write(tmp_path, "b.csv", "id~n\n3~4\n")
    assert rows(read_delimited(spark, f"{tmp_path}/*.csv", sep="~")) == [("1", "2"), ("3", "4")]


def test_quoted_newline(spark, tmp_path):
    path = write(tmp_path, "a.csv", 'item_id,product_category,brand,price\n1,"a >\nb",x,2.5\n2,a,y,\n')
    assert rows(load(spark, path, "products")) == [
        ("1", "a", "\nb", "Unknown", "x", 2.5), ("2", "a", "Unknown", "Unknown", "y", None)]


def test_target_export(spark, tmp_path):
    path = write(
        tmp_path, "t.csv",
        "customer_entity_id,product_id,purchase_dt,last_purchase_dt\n"
        "c,p,2022-01-03 12:00:00.123,2022-01-01 00:00:00.9\nd,p,junk,2022-01-01 00:00:00\n")
    got = load(spark, path, "replenishment_target").select(
        "customer_entity_id", F.date_format("purchase_dt", "yyyy-MM-dd HH:mm:ss"), "days_since_last_purchase")
    assert rows(got) == [("c", "2022-01-03 12:00:00", 2.5), ("d", None, None)]


def test_impression_time_is_parsed(spark, tmp_path):
    path = write(tmp_path, "b.csv",
                 "customer_entity_id,impression_dt,banner_name,banner_id\nc,2022-01-03 12:00:00.5,n,7\n")
    assert load(spark, path, "banner_impression").where("impression_dt is not null").count() == 1


def test_campaigns_need_a_name(spark, tmp_path):
    path = write(tmp_path, "r.csv", "customer_entity_id,received_dt,automation_name,automation_id\n"
                                    "c,2022-01-03 12:00:00,n,7\nc,2022-01-03 12:00:00,,8\n")
    df = load(spark, path, "received_campaigns")
    assert "received_dt" in df.columns and rows(df, "automation_id") == [("7",)]


def test_sources_become_columns(spark, tmp_path):
    path = write(tmp_path, "s.csv", "customer_entity_id,sources\nc,se\nc,se\nc,other\n,se\nd,magento\n")
    got = load(spark, path, "identity_sources")
    assert rows(got, "customer_entity_id", "magento", "me_web", "se") == [("c", 0, 0, 2), ("d", 1, 0, 0)]


def test_attributes_keep_system_name_as_text(spark, tmp_path):
    names = [n for n, _ in __import__("refillcast.plans.dimensions", fromlist=["x"]).IDENTITY_ATTRIBUTES]
    values = ["Android" if n == "me_os_most_freq" else "" for n in names]
    path = write(tmp_path, "a.csv", "~".join(["customer_entity_id", *names]) + "\n" + "~".join(["c", *values]) + "\n")
    row = load(spark, path, "identity_attributes").first()
    assert row["me_os_most_freq"] == "Android" and row["me_city"] == "Unknown"
    assert row["me_transaction_count"] == 0.0 and row["se_open_rate"] is None


def test_all_exports_are_declared():
    assert len(EXPORTS) == 18
    assert EXPORTS["identity_attributes"].sep == "~" and EXPORTS["products"].multi_line


def test_product_config(spark, tmp_path):
    path = write(tmp_path, "c.csv", '"PRODUCT_ID","NAME","REPLENISHMENT_DAYS","IS_DEFINED"\n'
                                    '" 1 ","NA, 400 g",6,"yes"\n"2","NA",NA,"no"\n')
    assert rows(load_product_config(spark, path)) == [("1", "NA, 400 g", 6, True), ("2", "NA", None, False)]


def test_table_is_replaced(spark):
    path = fresh_path(spark, "replace")
    write_table(spark.range(5), path)
    write_table(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_land(spark, tmp_path):
    path = write(tmp_path, "i.csv", "customer_entity_id,n_identifiers\nc,3\n")
    assert rows(land(spark, path, "identity_identifiers", fresh_path(spark, "landed"))) == [("c", 3.0)]


def test_report_is_dated(spark):
    out = write_report(spark.createDataFrame([("a", 1.5)], "n string, v double"),
                       fresh_path(spark, "report"), dt.date(2024, 1, 31))
    assert out.endswith("run_date=20240131")
    assert rows(read_delimited(spark, out, sep="~")) == [("a", "1.5")]


def test_orders_until_is_inclusive_and_pushed_down(spark):
    path = fresh_path(spark, "orders")
    spark.createDataFrame(
        [("a", "p", at("2022-12-20")), ("b", "p", at("2022-12-20 00:00:01"))],
        "customer_email string, product_id__item string, created_at__item timestamp").write.parquet(path)
    df = scan_orders(spark, path, "2022-12-20")
    assert rows(df, "customer_email") == [("a",)]
    assert "LessThanOrEqual(created_at__item" in df._jdf.queryExecution().toString()


def test_replace_partitions_keeps_other_dates_and_survives_a_failed_write(spark, tmp_path):
    path = str(tmp_path / "dated")
    day = lambda k, v: spark.createDataFrame([(v, k)], "value int, run_date int")
    replace_partitions(day(1, 10).unionByName(day(2, 20)), path, "run_date")
    replace_partitions(day(2, 21), path, "run_date")
    held = lambda: sorted(tuple(r) for r in spark.read.parquet(path).select("run_date", "value").collect())
    assert held() == [(1, 10), (2, 21)]
    broken = day(1, 11).unionByName(day(3, 0)).selectExpr("10 div value as value", "run_date")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        replace_partitions(broken, path, "run_date")
    assert held() == [(1, 10), (2, 21)]
    replace_partitions(day(1, 5).where("false"), path, "run_date")
    assert held() == [(1, 10), (2, 21)]
