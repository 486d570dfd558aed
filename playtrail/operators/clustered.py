"""The attribution table laid out for its two-title reports.

Those reports look for one or two titles over a long period and then go by account. The table
kept here is bucketed by account and, in each bucket, ordered by title, with Bloom filters on both title
columns: a report reads the row groups that may hold its titles only, and its
groupings and its join by account need no shuffle, as a bucket holds all rows of its accounts.

It is a copy for reports; ``maintenance`` keeps the table by day. Titles that hold a large share of all
plays spread over all buckets, so no task has more than its accounts' share of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

TITLES = ("title", "feeder_title")
ROW_GROUP_BYTES = 16 << 20  # small, so that a title lies in few rows besides its own


def save_clustered(
    attribution: DataFrame, name: str, buckets: int, path: str | None = None, distinct_titles: int = 100_000,
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> DataFrame:
    """Create or replace the catalog table ``name`` (its files at ``path``, if given); returns it. One task
    writes a bucket, so choose ``buckets`` for files of a few GB at most."""
    # The rows come in the buckets' own partitioning: one file a bucket.
    writer = attribution.repartition(buckets, "account_id").write.format("parquet").mode("overwrite")
    for title in TITLES:
        writer = writer.option(f"parquet.bloom.filter.enabled#{title}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{title}", str(distinct_titles))
    writer = writer.option("parquet.block.size", str(row_group_bytes))
    if path is not None:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, "account_id").sortBy("title", "feeder_title", "account_id").saveAsTable(name)
    return attribution.sparkSession.table(name)
