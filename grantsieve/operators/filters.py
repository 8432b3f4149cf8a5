"""Row filters and guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_space


def drop_blank_urls(jobs: DataFrame, url: str = "url") -> DataFrame:
    """Jobs without a URL are not jobs."""
    return jobs.filter(F.col(url).isNotNull())


def looks_like_html(payload: Column) -> Column:
    """True where a payload that should be CSV is an HTML page (case-sensitive test)."""
    start = strip_space(payload)
    return start.startswith("<!DOCTYPE") | start.startswith("<html")


def is_success(status: Column) -> Column:
    return status.between(200, 299)


def readable_pages(pages: DataFrame) -> DataFrame:
    """Pages that could be read; a page without source yields no record."""
    return pages.filter(F.col("html").isNotNull())


def quarantined_pages(pages: DataFrame) -> DataFrame:
    """The complement of ``readable_pages``, without the source column."""
    return pages.filter(F.col("html").isNull()).drop("html")
