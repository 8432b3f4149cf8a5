"""Pipelines: catalogue to jobs to pages to records to files."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import DEFAULT_RETRIES, Profile
from ..functions.scalars import normalize_url
from ..operators.dedup import first_n, keep_first, page_order
from ..operators.filters import drop_blank_urls
from ..operators.records import parse_pages
from ..operators.resolve import (
    attempt_log, fetch_log, first_failures, outcome_summary, page_index, resolve_pages, with_page_key,
)
from ..sinks.writers import append_fetch_log, write_flat_csv, write_json, write_json_per_record
from ..sources.catalogue import job_rows, newest_snapshot, read_catalogue


def jobs_of(catalogue: DataFrame) -> DataFrame:
    """Distinct jobs of a catalogue, the first row per URL winning."""
    jobs = drop_blank_urls(job_rows(catalogue))
    order = [c for c in ("source_file", "ord") if c in jobs.columns]
    return keep_first(jobs, "url", order)


def catalogue_jobs(spark: SparkSession, path: str) -> DataFrame:
    return jobs_of(read_catalogue(spark, path))


@dataclass(frozen=True)
class Written:
    """What ``write_records`` produced."""

    records: int
    table: str
    json: str | None
    csv: str | None


def write_records(
    records: DataFrame, out_dir: str, profile: Profile | None = None, per_record: bool = False
) -> Written:
    """Write the record table once, then JSON lines and flattened CSV from it.

    Parsing is the expensive step and sorting samples its input, so both exports and
    the count read the written table and a lost executor never costs a second parse. Both
    exports take the same sorted parts: records are moved into page order once per batch.
    An empty batch writes no exports.
    """
    spark = records.sparkSession
    table = f"{out_dir.rstrip('/')}/records"
    records.write.mode("overwrite").parquet(table)
    stored = spark.read.parquet(table)
    count = stored.count()
    if not count:
        return Written(0, table, None, None)
    json, csv = f"{out_dir.rstrip('/')}/records_json", f"{out_dir.rstrip('/')}/records_csv"
    in_order = stored.orderBy(page_order()).persist(StorageLevel.DISK_ONLY)
    try:
        write_json(in_order, json, ordered=True)
        write_flat_csv(in_order, csv, profile, ordered=True)
    finally:
        in_order.unpersist()
    if per_record:
        write_json_per_record(stored, f"{out_dir.rstrip('/')}/json")
    return Written(count, table, json, csv)


def parse_batch(
    pages: DataFrame, out_dir: str, profile: Profile | None = None, per_record: bool = False
) -> Written:
    """Parse pages and write every export."""
    return write_records(parse_pages(pages, profile), out_dir, profile, per_record)


def catalogue_records(
    catalogue: DataFrame,
    pages: DataFrame,
    n: int,
    profile: Profile | None = None,
    order: Sequence[str] = ("page_id",),
    all_readable: bool = False,
) -> DataFrame:
    """Records of the first ``n`` distinct jobs of a catalogue that have a page.

    ``all_readable=True``, for tables as written by ``land_pages``, keeps page source out of
    the scan that looks for the pages.
    """
    jobs = jobs_of(catalogue)
    by = [c for c in ("source_file", "ord") if c in jobs.columns]
    return parse_pages(resolve_pages(first_n(jobs, n, by), pages, order, all_readable), profile)


def catalogue_batch(
    spark: SparkSession,
    snapshots: str,
    pages: DataFrame,
    n: int,
    out_dir: str,
    profile: Profile | None = None,
    order: Sequence[str] = ("page_id",),
    all_readable: bool = False,
) -> Written:
    """Newest landed catalogue snapshot to written records."""
    newest = newest_snapshot(spark, snapshots)
    if newest is None:
        raise FileNotFoundError(f"no catalogue snapshot matches {snapshots}")
    records = catalogue_records(read_catalogue(spark, newest), pages, n, profile, order, all_readable)
    return write_records(records, out_dir, profile)


def url_records(
    pages: DataFrame, url: str, profile: Profile | None = None, order: Sequence[str] = ("page_id",)
) -> DataFrame:
    """Record of one URL; the URL filter reaches the page scan."""
    wanted = pages.sparkSession.range(1).select(normalize_url(F.lit(url))).first()[0]
    if wanted is None:
        raise ValueError("the URL is empty")
    page = pages.filter((F.col("url") == wanted) & F.col("html").isNotNull()).orderBy(*order, "html").limit(1)
    bare = F.lit(None).cast("string")
    keyed = with_page_key(page.withColumns({"title": bare, "program_id": bare, "nsf_pd_num": bare}))
    return parse_pages(keyed, profile)


def url_batch(
    pages: DataFrame, url: str, out_dir: str, profile: Profile | None = None, order: Sequence[str] = ("page_id",)
) -> Written:
    """Record of one URL, with every export."""
    return write_records(url_records(pages, url, profile, order), out_dir, profile)


@dataclass(frozen=True)
class Fetched:
    """Outcome of ``fetch_batch``: the log table and two small reports over it."""

    log: DataFrame
    summary: DataFrame
    failures: DataFrame


def fetch_batch(
    jobs: DataFrame,
    pages: DataFrame,
    log_path: str,
    out_dir: str = "",
    order: Sequence[str] = ("page_id",),
    all_readable: bool = False,
) -> Fetched:
    """Resolve jobs, append the outcome log, and report on the rows just written.

    Every batch is a folder ``batch=<id>`` of the log table at ``log_path``. The reports
    read that folder, so jobs are resolved once.
    """
    outcome = fetch_log(
        jobs, page_index(pages.join(jobs.select("url").distinct(), "url", "left_semi"), order, all_readable), out_dir
    )
    return _logged(outcome, log_path)


def fetch_batch_from_attempts(
    jobs: DataFrame, attempts: DataFrame, log_path: str, out_dir: str = "", retries: int = DEFAULT_RETRIES
) -> Fetched:
    """As ``fetch_batch``, with the status and last error that each job's attempts were logged with."""
    return _logged(attempt_log(jobs, attempts, out_dir, retries), log_path)


def _logged(outcome: DataFrame, log_path: str) -> Fetched:
    batch = f"{log_path.rstrip('/')}/batch={uuid4().hex}"
    append_fetch_log(outcome, batch)
    written = outcome.sparkSession.read.schema(outcome.schema).json(batch)
    return Fetched(written, outcome_summary(written), first_failures(written))
