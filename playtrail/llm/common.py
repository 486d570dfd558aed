"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from playtrail.plans.guards import checkpoint_dir, materialize


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back.

    The table is computed once, later plans read its files, and a lost
    executor costs only the tasks that were reading them.
    """
    checkpoint_dir(df.sparkSession)
    return materialize(df)


def shuffle_parts(df: DataFrame) -> int:
    """The session's shuffle partition count."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def text_chunks(
    batches: Iterable[pa.RecordBatch], rows: int = 256
) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of at most ``rows`` rows, so that what a
    task holds as Python objects stays small whatever Spark's batch size."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


class Memory:
    """Values by key in two generations of at most ``limit`` keys each: what was
    asked for lately stays, and the rest goes when the younger one is full."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def find(self, key):
        """The value of a key that isn't among the young, or None."""
        value = self.old.get(key)
        if value is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}
        self.young[key] = value
