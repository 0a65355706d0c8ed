"""Delimited text scans: header names, every column a string."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    multi_line: bool = False,
    encoding: str = "utf-8",
    quote: str = '"',
    header: bool = True,
) -> DataFrame:
    """Read delimited text without type inference; ``path`` may be a glob.

    ``multi_line`` keeps quoted line breaks in one record, at the price of one task per file:
    land such a source as Parquet once.
    """
    return spark.read.csv(
        path,
        sep=sep,
        header=header,
        inferSchema=False,
        encoding=encoding,
        quote=quote,
        multiLine=multi_line,
    )
