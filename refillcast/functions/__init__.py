from refillcast.functions.scalars import (
    days_between,
    feature_name,
    fill_defaults,
    guarded_log,
    log_features,
    na_fill_zero,
    parse_ts,
    path_level,
    strip_fraction,
    to_double,
    window_flag,
    window_start,
)

__all__ = [
    "days_between",
    "feature_name",
    "fill_defaults",
    "guarded_log",
    "log_features",
    "na_fill_zero",
    "parse_ts",
    "path_level",
    "strip_fraction",
    "to_double",
    "window_flag",
    "window_start",
]
