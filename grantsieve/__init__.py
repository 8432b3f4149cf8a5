"""Document extraction for funding-opportunity pages on Spark."""

from .functions.fixed_values import TOPIC_RULES, Profile
from .operators.records import flatten_records, page_texts, parse_pages, with_calendar_dates
from .plans.pipelines import (
    catalogue_batch, catalogue_jobs, catalogue_records, fetch_batch, parse_batch, url_records,
    write_records,
)

__all__ = [
    "TOPIC_RULES", "Profile", "catalogue_batch", "catalogue_jobs", "catalogue_records",
    "fetch_batch", "flatten_records", "page_texts", "parse_batch", "parse_pages", "url_records",
    "with_calendar_dates", "write_records",
]
