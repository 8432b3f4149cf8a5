"""Distinct jobs of a catalogue that arrives as a stream."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def first_jobs(jobs: DataFrame, key: str = "url", order: str = "ord") -> DataFrame:
    """First row per key of a stream: of the first micro-batch that holds the key, the least by
    ``order`` (a whole number, nulls first); rows that tie there are taken by their JSON text.

    The state is one flag per key, kept for good, as a repeated key may come at any time. The rows
    of a key in one micro-batch stream through its task, which holds the best one only. Rows
    travel as JSON, so numbers and nulls keep their types. Null keys are one key.
    """
    packed = jobs.select(
        F.col(key).alias("_key"),
        F.col(order).isNotNull().alias("_has"),
        F.coalesce(F.col(order).cast("bigint"), F.lit(0)).alias("_at"),
        F.to_json(F.struct(*jobs.columns), {"ignoreNullFields": "false"}).alias("_row"),
    )

    def first(_: Any, frames: Iterator[pd.DataFrame], seen: GroupState) -> Iterator[pd.DataFrame]:
        best = None
        for f in frames:
            if not seen.exists:
                least = min(zip(f["_has"].tolist(), f["_at"].tolist(), f["_row"].tolist()))
                best = least if best is None else min(best, least)
        if best is not None:
            seen.update((True,))
            yield pd.DataFrame({"_row": [best[2]]})

    rows = packed.groupBy("_key").applyInPandasWithState(
        first, "_row string", "seen boolean", "append", GroupStateTimeout.NoTimeout
    )
    return rows.select(F.from_json("_row", jobs.schema).alias("_job")).select("_job.*")


def write_first_jobs(
    jobs: DataFrame,
    path: str,
    key: str = "url",
    order: str = "ord",
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Append the first row per key to a parquet table, each key once over all runs.

    The checkpoint, which holds the state, belongs to the table and stands beside it.
    """
    writer = (
        first_jobs(jobs, key, order)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint or f"{path.rstrip('/')}_checkpoint")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
