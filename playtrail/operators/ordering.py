"""Global positions of an ordered result (O1-O3).

The original ends in an ORDER BY. Rows of a table have no order of their own, so a result that has to
be checked, paged or resumed gets a position column instead: 1, 2, 3, ... in the final order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.guards import materialize

SLOT_BITS = 33  # of monotonically_increasing_id: the row's number in its partition


def with_positions(df: DataFrame, keys: list[str], descending: tuple[str, ...] = (), name: str = "position") -> DataFrame:
    """``df`` with the position of every row in the order of ``keys`` (NULLs first, last where descending).

    Ties of the keys go by all other columns, so that only equal rows are interchangeable.
    One range shuffle deals the rows out by the whole order, so a key that many rows share is split as
    well; each partition is sorted by itself and written, and a row's position is its number there
    plus the rows of the partitions before. No window runs over the rows: the only one spans the
    partitions' counts, a row for each partition.
    """
    order = [F.col(k).desc() if k in descending else F.col(k).asc() for k in [*keys, *(c for c in df.columns if c not in keys)]]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = materialize(ranged.select("*", F.monotonically_increasing_id().alias("_slot")))
    part = F.shiftright("_slot", SLOT_BITS)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # As many rows as the table has files.
    offsets = F.broadcast(sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before")))
    inside = F.col("_slot").bitwiseAND(F.lit((1 << SLOT_BITS) - 1))
    return rows.withColumn("_part", part).join(offsets, "_part").select(
        *df.columns, (F.col("_before") + inside + 1).alias(name)
    )


def with_totals_before(df: DataFrame, keys: list[str], weight: str, name: str) -> DataFrame:
    """``df`` with the sum of ``weight`` over all rows before a row in the order of ``keys``, which no two rows share.

    A prefix sum in two levels: inside the partitions of one range shuffle, and over the
    partitions' sums. No window is longer than a partition."""
    order = [F.col(k).asc() for k in keys]
    rows = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order).select("*", F.monotonically_increasing_id().alias("_slot"))
    )
    part = F.shiftright("_slot", SLOT_BITS)
    rows = rows.withColumn("_part", part)
    sums = rows.groupBy("_part").agg(F.sum(weight).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = F.broadcast(sums.select("_part", F.coalesce(before, F.lit(0)).alias("_before")))
    own = F.sum(weight).over(Window.partitionBy("_part").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1))
    inside = rows.withColumn("_own", F.coalesce(own, F.lit(0)))
    return inside.join(offsets, "_part").select(*df.columns, (F.col("_before") + F.col("_own")).alias(name))
