"""Page parsing on streams: the same stateless plan, fed by newly landed pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.fixed_values import Profile
from ..operators.records import parse_pages

PAGE_SCHEMA = StructType(
    [
        StructField("file_stem", StringType()),
        StructField("url", StringType()),
        StructField("html", StringType()),
    ]
)


def stream_pages(
    spark: SparkSession,
    path: str,
    schema: StructType = PAGE_SCHEMA,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of a landed page table (parquet)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def parse_stream(
    pages: DataFrame,
    out_path: str,
    checkpoint: str | None = None,
    profile: Profile | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Append records of newly landed pages to a parquet table, exactly once per page.

    The checkpoint belongs to the table: without another place for it, it stands beside
    ``out_path``, so every run continues where the last one stopped.
    """
    writer = (
        parse_pages(pages, profile)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint or f"{out_path.rstrip('/')}_checkpoint")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(out_path)
