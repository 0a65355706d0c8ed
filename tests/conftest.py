import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from refillcast.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("refillcast-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


def at(text: str | None) -> dt.datetime | None:
    """UTC time from 'YYYY-MM-DD' or 'YYYY-MM-DD HH:MM[:SS]'."""
    if text is None:
        return None
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def rows(df, *cols):
    """Rows as a sorted list of tuples."""
    data = df.select(*cols).collect() if cols else df.collect()
    return sorted((tuple(r) for r in data), key=lambda r: tuple((v is None, str(v)) for v in r))
