"""Outcome log of jobs that arrive as a stream, written batch by batch, each outcome once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.resolve import fetch_log, page_index


def log_stream(
    jobs: DataFrame,
    pages: DataFrame,
    log_path: str,
    out_dir: str = "",
    order: Sequence[str] = ("page_id",),
    all_readable: bool = False,
    checkpoint: str | None = None,
    available_now: bool = True,
    on_written: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Resolve a stream of jobs against landed pages and log every micro-batch when it is done.

    A batch is the folder ``batch=<number>`` of the log table. A batch that failed after it was
    written, but before the stream had noted it, is run again under the same number and replaces
    its folder, so the log holds each outcome once. ``on_written`` is called with the number of a
    batch whose folder stands. The checkpoint belongs to the table and stands beside it.
    """

    def write(batch: DataFrame, number: int) -> None:
        asked = pages.join(batch.select("url").distinct(), "url", "left_semi")
        outcome = fetch_log(batch, page_index(asked, order, all_readable), out_dir)
        folder = f"{log_path.rstrip('/')}/batch={number:012d}"
        outcome.write.mode("overwrite").option("ignoreNullFields", False).json(folder)
        if on_written:
            on_written(number)

    writer = jobs.writeStream.foreachBatch(write).option(
        "checkpointLocation", checkpoint or f"{log_path.rstrip('/')}_checkpoint"
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
