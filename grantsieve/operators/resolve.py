"""Resolving jobs to landed pages, retry resolution and outcome summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.scalars import page_key
from .filters import is_success


def with_page_key(jobs: DataFrame, name: str = "file_stem") -> DataFrame:
    return jobs.withColumn(
        name,
        page_key(F.col("url"), F.col("title"), F.col("program_id"), F.col("nsf_pd_num")),
    )


def page_index(
    pages: DataFrame, order: Sequence[str] = ("page_id",), all_readable: bool = False
) -> DataFrame:
    """One narrow row per URL naming its first readable page.

    Without the page source, so that deduplication never moves or sorts pages. Checking
    for unreadable pages still scans the source; ``all_readable=True`` leaves the check
    out for tables that hold readable pages only, as written by ``land_pages``.
    """
    if not all_readable:
        pages = pages.filter(F.col("html").isNotNull())
    if len(order) == 1:  # plain values aggregate by hash, structs by sorting
        return pages.groupBy("url").agg(F.min(order[0]).alias(order[0]))
    return pages.groupBy("url").agg(F.min(F.struct(*order)).alias("_page")).select(
        "url", *[F.col("_page")[c].alias(c) for c in order]
    )


def fetch_log(
    jobs: DataFrame,
    index: DataFrame,
    out_dir: str = "",
    error: str = "Unknown error",
    status: Column | None = None,
) -> DataFrame:
    """Exactly one outcome row per job: ``url, ok, http_status, error, saved_path``.

    ``index`` holds each URL at most once (see ``page_index``), so the join keeps the
    number of jobs. Status and path are reported for resolved jobs only.
    """
    found = index.select("url", F.lit(True).alias("_found"))
    ok = F.coalesce(F.col("_found"), F.lit(False))
    prefix = out_dir.rstrip("/") + "/" if out_dir else ""
    path = F.concat(F.lit(prefix), F.col("file_stem"), F.lit(".html"))
    extra = [c for c in jobs.columns if c == "ord"]
    return with_page_key(jobs).join(found, "url", "left").select(
        *extra,
        "url",
        ok.alias("ok"),
        F.when(ok, F.lit(200) if status is None else status).cast("int").alias("http_status"),
        F.when(~ok, F.lit(error)).alias("error"),
        F.when(ok, path).alias("saved_path"),
    )


def _places(pages: DataFrame, order: Sequence[str], *more: Column) -> DataFrame:
    """Pages by ``_url`` and the order as ``_at_<name>``, so that no name meets one of the jobs."""
    return pages.select(F.col("url").alias("_url"), *[F.col(c).alias(f"_at_{c}") for c in order], *more)


def _first_places(rows: DataFrame, by: Sequence[str], at: Sequence[str]) -> DataFrame:
    """Least order value per ``by``, and how many rows hold it, in ``_n``. Narrow rows only.

    A single order value of fixed width aggregates by hash; a null one counts as the last.
    """
    counted = rows.groupBy(*by, *at).agg(F.count("*").alias("_n"))
    if len(at) == 1:
        least, n = F.min(at[0]), F.coalesce(F.min_by("_n", at[0]), F.sum("_n"))
        return counted.groupBy(*by).agg(least.alias(at[0]), n.alias("_n"))
    place = F.struct(*at)
    return (
        counted.groupBy(*by)
        .agg(F.min(place).alias("_place"), F.min_by("_n", place).alias("_n"))
        .select(*by, *[F.col("_place")[c].alias(c) for c in at], "_n")
    )


def _sources(
    readable: DataFrame, order: Sequence[str], first: DataFrame, by: Sequence[str], at: Sequence[str]
) -> DataFrame:
    """``by`` and ``html`` of the pages at their first places, one row for each.

    A place that one page holds is met by a join alone; only pages that share their place, of which
    the least source is taken, are grouped and so sorted.
    """
    pages = _places(readable, order, F.col("html"))
    wanted = first.withColumnsRenamed({c: f"_first{c}" for c in at})
    same = [F.col("url") == F.col("_url"), *[F.col(c).eqNullSafe(F.col(f"_first{c}")) for c in at]]
    alone = pages.join(wanted.filter("_n = 1"), same).select(*by, "html")
    shared = pages.join(wanted.filter("_n > 1"), same).groupBy(*by).agg(F.min("html").alias("html"))
    return alone.union(shared)


def resolve_pages(
    jobs: DataFrame,
    pages: DataFrame,
    order: Sequence[str] = ("page_id",),
    all_readable: bool = False,
) -> DataFrame:
    """The page of every resolved job as ``file_stem, url, html``: one row per job.

    Only pages with a wanted URL enter the index. A page without an order value counts as the
    last one; of readable pages of one URL that tie, the least source is taken.

    Jobs meet the narrow page index first; the page source takes part only in the last
    join, as the filtered side. With few jobs Spark broadcasts them and no page is
    moved; with many, each wanted page crosses the network once.
    """
    readable = pages if all_readable else pages.filter(F.col("html").isNotNull())
    by, at = ("file_stem", "url"), [f"_at_{c}" for c in order]
    keyed = with_page_key(jobs).select(*by)
    wanted = _places(readable, order).join(keyed, F.col("_url") == F.col("url"))
    return _sources(readable, order, _first_places(wanted, by, at), by, at)


def first_pages(
    pages: DataFrame, order: Sequence[str] = ("page_id",), all_readable: bool = False
) -> DataFrame:
    """First readable page of every URL as ``url, html``; ties as in ``resolve_pages``."""
    readable = pages if all_readable else pages.filter(F.col("html").isNotNull())
    rows = _places(readable, order).filter("_url IS NOT NULL").withColumnRenamed("_url", "url")
    at = [f"_at_{c}" for c in order]
    return _sources(readable, order, _first_places(rows, ("url",), at), ("url",), at)


def resolve_landed(jobs: DataFrame, landed: DataFrame) -> DataFrame:
    """The page of every resolved job as ``file_stem, url, html``, from a table of ``land_bucketed``.

    The table holds a URL once, so a match is the page and nothing is aggregated. Jobs go to the
    buckets and are hashed there: page source is read in place, neither moved nor sorted.
    """
    keyed = with_page_key(jobs).select("file_stem", "url")
    return landed.join(keyed.hint("shuffle_hash"), "url").select("file_stem", "url", "html")


def attempt_outcomes(attempts: DataFrame, retries: int = fv.DEFAULT_RETRIES) -> DataFrame:
    """Outcome per URL of logged attempts: ``url, ok, attempt, http_status, error``.

    The first success among the first ``retries + 1`` attempts gives its number and status.
    Otherwise the last error is reported, ``HTTP <status>`` for a plain response. Minimum
    and maximum combine before the shuffle: a URL sends one row per partition. Bodies are
    not read. Attempts without a URL belong to no job and are left out.
    """
    ok = F.coalesce(is_success(F.col("status")), F.lit(False))
    error = F.when(
        ~ok, F.coalesce(F.col("error"), F.concat(F.lit("HTTP "), F.col("status").cast("string")))
    )
    outcome = (
        attempts.filter(F.col("url").isNotNull() & (F.col("attempt") <= retries))
        .groupBy("url")
        .agg(
            F.min(F.when(ok, F.struct("attempt", "status"))).alias("_first"),
            F.max(F.when(error.isNotNull(), F.struct("attempt", error.alias("text")))).alias("_error"),
        )
    )
    return outcome.select(
        "url",
        F.col("_first").isNotNull().alias("ok"),
        F.col("_first.attempt").alias("attempt"),
        F.col("_first.status").alias("http_status"),
        F.when(
            F.col("_first").isNull(), F.coalesce(F.col("_error.text"), F.lit("Unknown error"))
        ).alias("error"),
    )


def resolve_attempts(attempts: DataFrame, retries: int = fv.DEFAULT_RETRIES) -> DataFrame:
    """Outcome per URL with the body of its first success: ``url, ok, http_status, error, body``.

    Outcomes are settled on narrow rows (see ``attempt_outcomes``); only bodies of successful
    attempts meet them, by a join alone. Of several bodies logged for that attempt the least is
    taken: only these are grouped and so sorted.
    """
    named = {"url": "_url", "attempt": "_attempt", "status": "_status"}
    fetched = attempts.filter(is_success(F.col("status"))).select(*named, "body").withColumnsRenamed(named)
    same = [
        F.col("url") == F.col("_url"), F.col("attempt") == F.col("_attempt"), F.col("http_status") == F.col("_status")
    ]
    several = fetched.groupBy(*named.values()).agg(F.count("*").alias("_n")).filter("_n > 1")
    outcomes = attempt_outcomes(attempts, retries).join(several, same, "left").drop(*named.values())
    alone = outcomes.filter("_n IS NULL").join(fetched, same, "left")
    shared = outcomes.filter("_n > 1").join(fetched, same)
    least = shared.groupBy("url", "ok", "http_status", "error").agg(F.min("body").alias("body"))
    return alone.select("url", "ok", "http_status", "error", "body").union(least)


def attempt_log(
    jobs: DataFrame, attempts: DataFrame, out_dir: str = "", retries: int = fv.DEFAULT_RETRIES
) -> DataFrame:
    """One outcome row per job as ``fetch_log`` gives it, from logged attempts.

    A success has its own status, a failure its last error; a job that was never tried has
    failed with an unknown error. Attempts of other URLs are dropped before they are resolved.
    """
    asked = attempts.join(jobs.select("url").distinct(), "url", "left_semi")
    outcome = attempt_outcomes(asked, retries).select(
        "url", *[F.col(c).alias(f"_{c}") for c in ("ok", "http_status", "error")]
    )
    ok = F.coalesce(F.col("_ok"), F.lit(False))
    prefix = out_dir.rstrip("/") + "/" if out_dir else ""
    extra = [c for c in jobs.columns if c == "ord"]
    return with_page_key(jobs).join(outcome, "url", "left").select(
        *extra,
        "url",
        ok.alias("ok"),
        F.col("_http_status").cast("int").alias("http_status"),
        F.when(~ok, F.coalesce(F.col("_error"), F.lit("Unknown error"))).alias("error"),
        F.when(ok, F.concat(F.lit(prefix), F.col("file_stem"), F.lit(".html"))).alias("saved_path"),
    )


def outcome_summary(log: DataFrame) -> DataFrame:
    """One row: ``total, ok, failed``."""
    return log.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("ok")).alias("ok"),
        F.count_if(~F.col("ok")).alias("failed"),
    )


def first_failures(log: DataFrame, n: int = 10, order: Sequence[str] = ("ord",)) -> DataFrame:
    """First ``n`` failed jobs as ``url, error``, in job order."""
    failed = log.filter(~F.col("ok"))
    return failed.orderBy(*order).limit(n).select(*order, "url", "error")
