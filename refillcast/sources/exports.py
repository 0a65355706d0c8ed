"""The typed exports: where each comes from and what its columns mean."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refillcast.functions import parse_ts, to_double
from refillcast.operators.trailing import CUSTOMER
from refillcast.plans.dimensions import identity_dimension, identity_source_matrix, product_dimension
from refillcast.plans.target import with_gap
from refillcast.sources.delimited import read_delimited
from refillcast.sources.sinks import write_table

_PARSERS: dict[str, Callable[[str], Column]] = {"text": F.col, "ts": parse_ts, "double": to_double}


@dataclass(frozen=True)
class Export:
    """A delimited export. ``columns`` are (name, kind) with kind text, ts or double."""

    columns: tuple[tuple[str, str], ...] = ()
    required: tuple[str, ...] = ()
    sep: str = ","
    multi_line: bool = False
    shape: Callable[[DataFrame], DataFrame] | None = None

    def typed(self, raw: DataFrame) -> DataFrame:
        """Type the text columns, drop rows without a required one, then apply ``shape``."""
        if self.required:
            raw = raw.dropna(subset=list(self.required))
        if self.columns:
            raw = raw.select(*[_PARSERS[kind](name).alias(name) for name, kind in self.columns])
        return self.shape(raw) if self.shape else raw


def _events(ts: str, *texts: str, required: tuple[str, ...] = ()) -> Export:
    return Export(((CUSTOMER, "text"), (ts, "ts"), *[(t, "text") for t in texts]), required)


# Names, columns and formats of the exports.
EXPORTS: dict[str, Export] = {
    "replenishment_target": Export(
        ((CUSTOMER, "text"), ("product_id", "text"), ("purchase_dt", "ts"), ("last_purchase_dt", "ts")),
        shape=with_gap,
    ),
    "identity_identifiers": Export(((CUSTOMER, "text"), ("n_identifiers", "double"))),
    "identity_sources": Export(((CUSTOMER, "text"), ("sources", "text")), shape=identity_source_matrix),
    "transactional_quantity": Export(
        ((CUSTOMER, "text"), ("product_id", "text"), ("purchase_dt", "ts"), ("quantity", "double"))
    ),
    "transactional_attributes": _events("purchase_dt", "transaction_id", "delivery_type", "payment_type"),
    "coupon_used": Export(
        ((CUSTOMER, "text"), ("transaction_id", "text"), ("voucher_id", "text"), ("coupon_dt", "ts"))
    ),
    "products": Export(multi_line=True, shape=product_dimension),
    "identity_attributes": Export(sep="~", shape=identity_dimension),
    "received_campaigns": _events("received_dt", "automation_name", "automation_id", required=("automation_name",)),
    "opened_campaigns": _events("opened_dt", "automation_name", "automation_id", required=("automation_name",)),
    "clicked_campaigns": _events("clicked_dt", "automation_name", "automation_id", required=("automation_name",)),
    "utm_source": _events("source_dt", "utm_source"),
    "utm_medium": _events("medium_dt", "utm_medium"),
    "utm_campaign": _events("campaign_dt", "utm_campaign"),
    "product_views": _events("viewed_dt", "product_id"),
    "banner_clicked": _events("clicked_dt", "banner_name", "banner_id"),
    "banner_impression": _events("impression_dt", "banner_name", "banner_id"),
    "web_searches": _events("search_dt", "keywords", "n_results"),
}


def load(spark: SparkSession, path: str, export: Export | str) -> DataFrame:
    """Scan an export and give its columns their types, in one step."""
    spec = EXPORTS[export] if isinstance(export, str) else export
    return spec.typed(read_delimited(spark, path, spec.sep, spec.multi_line))


def land(spark: SparkSession, path: str, export: Export | str, out: str) -> DataFrame:
    """Convert an export to Parquet once; later plans prune columns and push filters there."""
    write_table(load(spark, path, export), out)
    return spark.read.parquet(out)
