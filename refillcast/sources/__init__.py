from refillcast.sources.delimited import read_delimited
from refillcast.sources.exports import EXPORTS, Export, land, load
from refillcast.sources.orders import load_product_config, scan_orders
from refillcast.sources.sinks import replace_partitions, save_model, write_report, write_table

__all__ = [
    "EXPORTS",
    "Export",
    "land",
    "load",
    "load_product_config",
    "read_delimited",
    "replace_partitions",
    "save_model",
    "scan_orders",
    "write_report",
    "write_table",
]
