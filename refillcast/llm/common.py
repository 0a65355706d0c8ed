"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refillcast.session import fresh_path

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write the frame to the shared folder and read it back: the lineage ends in files that
    survive the loss of an executor."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """Words of a text, in order; no empty ones."""
    return F.filter(F.split(text, SPACE), lambda w: w != F.lit(""))


def least_hashed(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, those with the least hash of the key, of a narrow frame.

    The hash first thins the rows to a few times as many, so the task that orders them gets no
    more than that, however many there were.
    """
    n, h = rows.count(), F.xxhash64(key)
    thin = rows.where(F.pmod(h, F.lit(n)) < 4 * most) if n > 4 * most else rows
    return thin.orderBy(h, key).limit(most)


def as_bytes(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of a text column, empty where it is null."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def bounded(batches: Iterable[pa.RecordBatch], column: str, most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that one holds about ``most`` bytes of the column, or one row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = size = 0
        for i, n in enumerate(lengths.tolist()):
            if size and size + n > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < len(lengths):
            yield batch.slice(start)
