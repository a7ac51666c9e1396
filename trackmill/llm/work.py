"""Intermediate tables in the shared folder, and Arrow batches with flat columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from trackmill.session import new_shared_dir


class Scratch:
    """Tables below one folder of the shared storage.

    A settled table cuts the lineage: it lives on storage that every executor reads, so a
    lost executor costs its running tasks only. `drop` removes tables no longer read.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.root, self.made = spark, new_shared_dir(spark, purpose), []

    def path(self, name: str) -> str:
        path = f"{self.root}/{len(self.made)}-{name}"
        self.made.append(path)
        return path

    def settle(self, df: DataFrame, name: str) -> DataFrame:
        """The frame, written once and read back with the same schema."""
        path = self.path(name)
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._scratch = path
        return table

    def drop(self, *tables: DataFrame | str) -> None:
        for table in tables:
            remove(self.spark, table if isinstance(table, str) else table._scratch)

    def drop_all_but(self, *tables: DataFrame) -> None:
        kept = {table._scratch for table in tables}
        for path in self.made:
            if path not in kept:
                remove(self.spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder through the file system that Spark itself uses for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """Texts as bytes; null becomes empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def binary(rows: list[bytes] | np.ndarray) -> pa.Array:
    return pa.array(list(rows), pa.binary())


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """Runs a batch function over each partition; `make` builds it once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                yield work(batch.slice(lo, 2000))

    return df.mapInArrow(run, schema)


def map_groups(df: DataFrame, keys: list[str], make: Callable[[], Callable[[pa.Table, np.ndarray], pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """Runs a function over tables of whole groups of equal keys.

    The rows are dealt out and sorted by the keys, so that a task streams through its groups
    and holds a few of them at a time. The function gets the rows and the groups' bounds in
    them; the caller sees to it that no group is large. Keys must not be null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, held = make(), None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            edges = _edges(held, keys)
            if len(edges) > 2:
                yield work(held.slice(0, edges[-2]).combine_chunks(), edges[:-1])
                held = held.slice(edges[-2])
        if held is not None and held.num_rows:
            yield work(held.combine_chunks(), _edges(held, keys))

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _edges(table: pa.Table, keys: list[str]) -> np.ndarray:
    changed = np.zeros(table.num_rows, bool)
    for key in keys:
        values = table.column(key).to_numpy()
        changed[1:] |= values[1:] != values[:-1]
    return np.concatenate(([0], np.flatnonzero(changed), [table.num_rows]))
