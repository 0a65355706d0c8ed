"""Repurchase-timing analytics on Spark: trailing features, volume series, elastic-net model."""

__version__ = "0.1.0"
