"""Table specifications: what to ingest and how to read it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class TableSpec:
    """One ingested table.

    ``source`` is any DataFrame, or a callable building one from the
    session (a parquet path, a JDBC read partitioned on the key, ...).
    ``columns`` is the projection taken from the source (None = all); it
    is applied before the watermark filter so the scan reads only those
    columns.  Delta rows with a NULL in a ``required`` column fail the run
    before anything is written (the mark stays where it was).
    """

    name: str
    key: str
    ts: str
    source: DataFrame | Callable[[SparkSession], DataFrame]
    columns: tuple[str, ...] | None = None
    required: tuple[str, ...] | None = None     # NOT NULL columns; default key + ts

    def required_columns(self) -> list[str]:
        return list(self.required) if self.required is not None else [self.key, self.ts]

    def read(self, spark: SparkSession) -> DataFrame:
        df = self.source(spark) if callable(self.source) else self.source
        if self.columns:
            df = df.select(*self.columns)
        return df


def parquet_source(path: str) -> Callable[[SparkSession], DataFrame]:
    return lambda spark: spark.read.parquet(path)


def jdbc_source(url: str, table: str, key: str, lower: int, upper: int,
                partitions: int, **props) -> Callable[[SparkSession], DataFrame]:
    """JDBC read split on the numeric key into ``partitions`` ranges.

    The watermark filter applied afterwards is pushed into each range's
    SQL by the JDBC source.
    """
    def read(spark: SparkSession) -> DataFrame:
        return spark.read.jdbc(url, table, column=key, lowerBound=lower, upperBound=upper,
                               numPartitions=partitions, properties=props)
    return read
