import pytest
from conftest import at, rows
from pyspark.sql import functions as F

from refillcast.operators.volume import daily_vs_monthly


@pytest.fixture()
def orders(spark):
    data = [("a", "2022-01-01 08:00"), ("a", "2022-01-01 09:00"), ("b", "2022-01-02"), ("c", "2022-02-01")]
    return spark.createDataFrame(
        [(c, at(t)) for c, t in data], "customer_email string, created_at__item timestamp")


def series(df):
    return rows(df.select(F.date_format("created_at", "MM-dd"), "val_type", "value"))


def test_rows_per_day(orders):
    assert series(daily_vs_monthly(orders, "rows")) == [
        ("01-01", "avg_daily_emails", 1.5), ("01-01", "n_emails", 2.0),
        ("01-02", "avg_daily_emails", 1.5), ("01-02", "n_emails", 1.0),
        ("02-01", "avg_daily_emails", 1.0), ("02-01", "n_emails", 1.0)]


def test_customers_per_day(orders):
    assert [v for *_, v in series(daily_vs_monthly(orders, "customers"))] == [1.0] * 6


def test_unknown_metric(orders):
    with pytest.raises(ValueError):
        daily_vs_monthly(orders, "items")
