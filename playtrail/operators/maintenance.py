"""Table maintenance on day-partitioned Parquet tables.

The attribution table is stored ``partitionBy("event_date")``; writes are
rebalanced by day so files have a sensible size however many tasks built
the rows. A table is one of three kinds, and every operation here takes each:

* versioned, by path (``save_table(..., versioned=True)``) or by its name in the catalog
  (``schema.table``, the kind a new name gets): ``versions.py``. Replacing the table, or any
  number of its days, is one commit: readers see the old table or the new one.
* plain, by path: the folder holds nothing but ``event_date=...`` folders, so any reader can
  read it. ``save_table`` writes a replacement beside the old table and swaps folders
  (between the two renames a reader finds no table); days are staged first and then
  committed over the old ones by the writer.
* a catalog table that another program created: its partitions are replaced in place.

``reload_days`` recomputes any number of days in one build and commits them together; a
recompute that fails leaves the old days in place, an empty one removes its day, and twice
equals once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import RuleSet
from ..plans.guards import materialize
from ..sources.readers import is_table_name, scan
from . import versions as V
from .attribution import build_days
from .clicks import _as_date

# Working columns the original drops from a saved table.
WORKING_COLUMNS = (
    "player_event",
    "click_details",
    "binge_type",
    "island",
    "island_seconds",
    "watch_time_start",
    "watch_time_carry",
)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = V._fs(spark, path)
    return bool(fs.exists(p))


def _rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, p = V._fs(spark, src)
    _, q = V._fs(spark, dst)
    if not fs.rename(p, q):
        raise OSError(f"could not rename {src} to {dst}")


def _versioned(spark: SparkSession, table: str) -> str | None:
    """The folder of a versioned table (by path or name), or None for another kind."""
    if is_table_name(table):
        return V.named_path(spark, table)
    return table if V.is_versioned(spark, table) else None


def _shown(spark: SparkSession, table: str, path: str) -> None:
    if is_table_name(table):
        V.switch_view(spark, table, path)


def save_table(
    df: DataFrame, path: str, partition: str = "event_date", mode: str = "overwrite", versioned: bool = False
) -> None:
    """Create or replace a day-partitioned table.

    The job's rows are hash-partitioned by account, so every task holds
    every day; written as is, each day would get one small file per task.
    The ``rebalance`` hint lets AQE size the write tasks instead: it groups
    rows by day, splits a large day over several tasks (so no day lands in
    one task) and merges small ones. Inside each file rows are clustered by
    account, device and time.

    A new table is versioned if its ``path`` is a catalog name or ``versioned`` is set; a table that
    exists keeps its kind, but for a plain folder that ``versioned`` replaces.
    """
    spark = df.sparkSession
    folder = _versioned(spark, path)
    if folder is None and is_table_name(path) and not spark.catalog.tableExists(V.qualified(spark, path)):
        folder = V.new_path(spark, path)
    if folder is not None or versioned:
        if mode != "overwrite":
            raise ValueError("a versioned table is replaced as a whole or by days, not appended to")
        if folder is None and path_exists(spark, path):
            # Another kind of folder: it goes once the versioned one stands beside it.
            beside = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
            V.replace(df, beside, partition)
            swap_table(spark, beside, path)
            return
        V.replace(df, folder or path, partition)
        _shown(spark, path, folder or path)
        return
    if is_table_name(path):
        # Built in full before the catalog drops the old table for the new one.
        df = materialize(df)
    order = [partition] + [c for c in V.CLUSTER_ORDER if c in df.columns]
    writer = df.hint("rebalance", partition).sortWithinPartitions(*order).write.partitionBy(partition)
    if is_table_name(path):
        name = V.qualified(spark, path)
        writer.mode(mode).option("partitionOverwriteMode", "static").format("parquet").saveAsTable(name)
    elif mode == "overwrite" and path_exists(spark, path):
        new_path = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
        writer.parquet(new_path)
        swap_table(spark, new_path, path)
    else:
        writer.mode(mode).option("partitionOverwriteMode", "static").parquet(path)


def day_path(path: str, day, partition: str = "event_date") -> str:
    return f"{path.rstrip('/')}/{partition}={day}"


def delete_day(spark: SparkSession, path: str, day, partition: str = "event_date") -> None:
    """Remove one day's rows (its partition)."""
    folder = _versioned(spark, path)
    if folder is not None:
        V.delete_days(spark, folder, [day])
        _shown(spark, path, folder)
    elif is_table_name(path):
        spark.sql(f"ALTER TABLE {V.qualified(spark, path)} DROP IF EXISTS PARTITION ({partition} = DATE'{day}')")
    else:
        V._delete(spark, day_path(path, day, partition))


def replace_day(df: DataFrame, path: str, day, partition: str = "event_date") -> None:
    """Write ``df``'s rows of ``day`` as the new content of that day."""
    replace_days(df, path, [day], partition)


def replace_days(df: DataFrame, path: str, days, partition: str = "event_date") -> None:
    """Write ``df``'s rows of ``days`` as the new content of these days, in one commit."""
    spark = df.sparkSession
    folder = _versioned(spark, path)
    if folder is not None:
        V.replace_days(df, folder, days, partition)
        _shown(spark, path, folder)
        return
    rows = df.where(F.col(partition).isin(*[F.lit(str(d)).cast("date") for d in days]))
    if is_table_name(path):
        staged = materialize(rows)
        name = V.qualified(spark, path)
        staged.select(*spark.table(name).columns).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).insertInto(name)
        _drop_missing(spark, staged, path, days, partition)
        return
    staging = f"{path.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    try:
        save_table(rows, staging, partition)
        staged = spark.read.schema(rows.schema).parquet(staging)
        # The writer's commit replaces the days' folders; until then the old days stand.
        writer = staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(partition).parquet(path)
        _drop_missing(spark, staged, path, days, partition)
    finally:
        V._delete(spark, staging)


def _drop_missing(spark: SparkSession, staged: DataFrame, path: str, days, partition: str) -> None:
    """Days that were recomputed and have no rows leave the table."""
    found = {str(r[0]) for r in staged.select(partition).distinct().collect()}
    for day in days:
        if str(day) not in found:
            delete_day(spark, path, day, partition)


def reload_days(
    clicks: DataFrame,
    videos: DataFrame,
    path: str,
    days,
    rules: RuleSet | str = "R3",
    *,
    map_date=None,
    map_lag_days: int = 0,
    **build_kwargs,
) -> None:
    """Recompute ``days`` with a rule set in one build and put them in place together.

    Each day's map is built from the log of ``map_lag_days`` before it (0: the day itself, the last
    finished one when it is reloaded), or all from ``map_date``.
    """
    days = sorted({_as_date(d) for d in days})
    if days:
        built = build_days(
            clicks, videos, days, rules, map_date=map_date, map_lag_days=map_lag_days, **build_kwargs
        )
        replace_days(built, path, days)


def reload_day(
    clicks: DataFrame,
    videos: DataFrame,
    path: str,
    day,
    rules: RuleSet | str = "R3",
    map_date=None,
    **build_kwargs,
) -> None:
    """S9 / C18 for one day; ``map_date`` defaults to the day itself."""
    reload_days(clicks, videos, path, [day], rules, map_date=map_date, **build_kwargs)


def prune_columns(df: DataFrame, columns=WORKING_COLUMNS) -> DataFrame:
    """``SELECT * EXCEPT (...)``; names the table lacks are ignored."""
    return df.drop(*columns)


def swap_table(spark: SparkSession, new_path: str, path: str) -> None:
    """Make ``new_path`` the table at ``path``; the old copy is removed last."""
    old = f"{path.rstrip('/')}.old-{uuid.uuid4().hex}"
    replaced = path_exists(spark, path)
    if replaced:
        _rename(spark, path, old)
    try:
        _rename(spark, new_path, path)
    except Exception:
        if replaced:
            _rename(spark, old, path)
        raise
    V._delete(spark, old)


def prune_table(spark: SparkSession, path: str, columns=WORKING_COLUMNS, partition: str = "event_date") -> None:
    """Drop working columns from a saved table. The path that is read is never written over:
    the copy is a new version, or a folder that takes the place of the old one."""
    save_table(prune_columns(scan(spark, path), columns), path, partition)
