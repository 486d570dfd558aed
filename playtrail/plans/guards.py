"""Size-checked broadcasts and lineage cuts.

A side is broadcast only after its row count has been checked against a
bound; past the bound the caller gets the DataFrame back and Spark plans a
shuffle join instead. Tables that are expensive to recompute are first
written to the cluster's checkpoint folder (they survive executor loss), so
the count and the join read the same files. Cached tables are avoided on
purpose: every cached plan is matched against every later query's plan,
which slows planning down in long sessions.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The largest side worth copying to every executor; bigger sides take a
# shuffle join. Rows may be wide (titles, arrays), so both bounds hold.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 128 << 20


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder every executor can reach "
            "(the cluster's shared storage) before running this job"
        )
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession) -> str:
    """The configured shared folder itself (``spark.checkpoint.dir``), stable
    across runs; the context's checkpoint folder adds a per-run subfolder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or checkpoint_dir(spark)


def materialize(df: DataFrame) -> DataFrame:
    """Write a small derived table to the checkpoint folder and read it back.

    The written table cuts the lineage and survives executor loss (unlike a
    local checkpoint); it is computed once, and the read-back table carries
    its real size for the planner. (``DataFrame.checkpoint`` would compute it
    twice: once to count, once to write.)
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/guard-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def fits(
    df: DataFrame,
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
    also: Column | None = None,
) -> tuple:
    """(is it small enough to broadcast, rows[, value of the aggregate ``also``]): at most ``max_rows``
    rows and ``max_bytes`` bytes (of its rows spelled out, keys left out), in one job."""
    width = F.octet_length(F.array_join(F.array(*[F.col(c).cast("string") for c in df.columns]), ","))
    more = [] if also is None else [also]
    rows, size, *values = df.agg(F.count(F.lit(1)), F.sum(width), *more).first()
    return rows <= max_rows and (size or 0) <= max_bytes, rows, *values


def bounded_broadcast(
    df: DataFrame,
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    materialize_first: bool = False,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> tuple[DataFrame, int]:
    """Return ``(side, rows)``: ``side`` is broadcast only if it has at most
    ``max_rows`` rows and ``max_bytes`` bytes (of its rows spelled out, keys left out).

    With ``materialize_first`` the table is written once and both the count
    and the join read it; use it when recomputing the table would mean
    scanning a whole period again. Otherwise the count is one job and the
    broadcast stage recomputes the (cheap) table.
    """
    if materialize_first:
        df = materialize(df)
    small, rows = fits(df, max_rows, max_bytes)
    return (F.broadcast(df) if small else df), rows
