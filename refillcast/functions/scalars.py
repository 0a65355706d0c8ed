"""Column expressions: parsing that survives ANSI mode, calendar windows, defaults, names."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECONDS_PER_DAY = 86400


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_fraction(c: Column | str) -> Column:
    """Text before the first dot: drops fractional seconds."""
    return F.substring_index(_col(c), ".", 1)


def parse_ts(c: Column | str) -> Column:
    """Timestamp at second precision from text; text that is no timestamp gives NULL."""
    return F.try_to_timestamp(strip_fraction(c))


def to_double(c: Column | str) -> Column:
    """Double from text; empty or bad text gives NULL."""
    return _col(c).try_cast("double")


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Days from ``earlier`` to ``later`` as a double, with the time of day as a fraction."""
    return (F.unix_timestamp(_col(later)) - F.unix_timestamp(_col(earlier))) / F.lit(SECONDS_PER_DAY)


def path_level(c: Column | str, i: int, sep: str = ">") -> Column:
    """Element ``i`` of a separated path, trimmed; ``'Unknown'`` where the path is shorter."""
    return F.coalesce(F.trim(F.get(F.split(_col(c), re.escape(sep)), F.lit(i))), F.lit("Unknown"))


def window_start(day: Column | str, months: int) -> Column:
    """First calendar day of the trailing window of ``months`` that ends on ``day``.

    ``0 <= months_between(t, e) <= months`` holds exactly when
    ``window_start(to_date(t), months) <= to_date(e) <= to_date(t)``: equal days of the month
    and pairs of month ends count as whole months whatever the time of day, and every other
    pair is ordered by its date. Where the day does not exist in the first month, that month
    takes part only if ``day`` ends its own month. The strict form ``months_between > 0``
    only drops the day itself.
    """
    day = _col(day)
    start = F.add_months(day, -months)
    reaches = (F.dayofmonth(start) == F.dayofmonth(day)) | (day == F.last_day(day))
    return F.when(reaches, start).otherwise(F.date_add(start, 1))


def window_flag(at: Column | str, event: Column | str, months: int) -> Column:
    """1 where ``event`` lies zero to ``months`` months before ``at``, else 0."""
    return F.when(F.months_between(_col(at), _col(event)).between(0, months), 1).otherwise(0)


def guarded_log(c: Column | str) -> Column:
    """Natural log; zero and below give 0, NULL stays NULL."""
    c = _col(c).cast("double")
    return F.when(c <= 0, F.lit(0.0)).otherwise(F.log(c))


def log_features(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Add ``log__<name>`` for each column, in one projection."""
    return df.withColumns({f"log__{c}": guarded_log(c) for c in cols})


def feature_name(entity: str, rank: int, months: int, kind: str) -> str:
    return f"{entity}_{rank}__last{months}m_{kind}"


def fill_defaults(df: DataFrame, num: float = 0, txt: str = "Unknown", cols: Iterable[str] | None = None) -> DataFrame:
    """NULL numbers become ``num`` and NULL texts ``txt`` in the given columns (default: all)."""
    wanted = set(df.columns if cols is None else cols)
    return df.select(
        *[
            F.coalesce(F.col(f.name), F.lit(num).cast(f.dataType)).alias(f.name)
            if f.name in wanted and isinstance(f.dataType, T.NumericType)
            else F.coalesce(F.col(f.name), F.lit(txt)).alias(f.name)
            if f.name in wanted and isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def na_fill_zero(df: DataFrame) -> DataFrame:
    """NULL becomes 0 in every numeric column."""
    return df.na.fill(0)
