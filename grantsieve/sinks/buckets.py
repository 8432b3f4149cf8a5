"""Landed pages in a layout that jobs meet without moving page source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.resolve import first_pages

LANDED = "url STRING, html STRING"


def land_bucketed(
    pages: DataFrame,
    name: str,
    path: str,
    buckets: int,
    order: Sequence[str] = ("page_id",),
    all_readable: bool = False,
) -> DataFrame:
    """Store the first readable page of every URL as the table ``name`` at ``path``, in buckets by URL.

    Page source is moved once, here; joins with ``resolve_landed`` never move it again. One task
    writes one bucket, in the order of URLs. ``buckets`` should make a bucket's jobs fit in a
    task and its file a few hundred MB. Landing again replaces the table.
    """
    first = first_pages(pages, order, all_readable).select("url", "html")
    (
        first.repartition(buckets, "url")
        .sortWithinPartitions("url")
        .write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, "url")
        .sortBy("url")
        .option("path", path)
        .saveAsTable(name)
    )
    return pages.sparkSession.table(name)


def open_bucketed(spark: SparkSession, name: str, path: str, buckets: int) -> DataFrame:
    """A table written by ``land_bucketed``, in a session whose catalogue does not know it."""
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({LANDED}) USING parquet "
        f"CLUSTERED BY (url) SORTED BY (url) INTO {int(buckets)} BUCKETS LOCATION '{place}'"
    )
    return spark.table(name)
