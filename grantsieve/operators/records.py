"""Page source to structured record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..functions import extract as E
from ..functions import html as H
from ..functions.fixed_values import Profile
from ..functions.scalars import calendar_date
from ..functions.tagging import Rules, joined_tags, rule_snippets, tag_text, topic_tags
from ..functions.text import cut_phrases, fold_case, or_empty, or_null
from .filters import readable_pages

RECORD_FIELDS = (
    "foa_id", "title", "agency", "open_date", "close_date", "dates_raw", "eligibility_text",
    "program_description", "total_award", "award_range", "source_url", "semantic_tags",
    "parser_source",
)


def record_schema(profile: Profile | None = None) -> StructType:
    """Schema of a record, for reading exports back."""
    tags = StructType(
        [StructField(c, ArrayType(StringType())) for c in (profile or Profile()).rules]
    )
    return StructType(
        [StructField(c, tags if c == "semantic_tags" else StringType()) for c in RECORD_FIELDS]
    )


def page_texts(
    pages: DataFrame, profile: Profile | None = None, keep: Sequence[str] = ("file_stem",)
) -> DataFrame:
    """``text`` of every readable page, its ``folded`` form and the other parts of a record.

    Each ``select`` below uses the columns of the one before several times, so the
    optimizer keeps them apart and every text is built once per page. Parts that a query
    does not use are pruned; the three small ones share one expression.
    """
    profile = profile or Profile()
    visible = F.col("_visible")
    small_parts = F.array(
        H.classed_heading(visible, profile.title_class),
        H.element_markup(visible, "title"),
        H.labelled_item(visible, profile.posted_class, profile.posted_label),
    )
    raw, cut = F.col("_raw"), F.col("_cut")
    return (
        readable_pages(pages)
        .select(
            *keep, H.visible_markup(F.col("html"), profile.hidden_elements).alias("_visible")
        )
        .select(
            *keep,
            H.markup_text(H.root_markup(visible, profile.root_elements)).alias("_raw"),
            F.transform(small_parts, H.markup_text).alias("_parts"),
            H.canonical_url(visible).alias("source_url"),
        )
        .select(
            *keep,
            "_raw",
            F.coalesce(or_null(F.get("_parts", F.lit(0))), F.get("_parts", F.lit(1))).alias(
                "full_title"
            ),
            F.get("_parts", F.lit(2)).alias("posted_item"),
            "source_url",
        )
        # looking for the phrases costs no more than a folded form that would tell of them
        .withColumn("_cut", cut_phrases(raw, profile.boilerplate))
        # a clean text without its phrases holds no white space but plain spaces, some of them in a row
        .withColumn("text", F.when(cut == raw, raw).otherwise(F.trim(F.regexp_replace(cut, "  +", " "))))
        .select(
            *keep,
            "text",
            fold_case(F.col("text")).alias("folded"),
            "full_title",
            "posted_item",
            "source_url",
        )
    )


def with_topic_tags(df: DataFrame, text: str, rules: Rules, name: str = "tags") -> DataFrame:
    """Add the tags of a text column as ``struct<category: array<label>>``."""
    return (
        df.withColumn("_tag_folded", fold_case(or_empty(F.col(text))))
        .withColumn("_tag_snippets", rule_snippets(F.col("_tag_folded"), rules))
        .withColumn(name, topic_tags("_tag_snippets", "_tag_folded", rules))
        .drop("_tag_folded", "_tag_snippets")
    )


def parse_pages(
    pages: DataFrame, profile: Profile | None = None, keep: Sequence[str] = ("file_stem",)
) -> DataFrame:
    """One record per readable page, behind the ``keep`` columns.

    ``pages`` holds ``file_stem`` and ``html``; it may be a batch or a streaming
    DataFrame, as every step is a projection or a filter.
    """
    p = profile or Profile()
    keep = tuple(dict.fromkeys((*keep, "file_stem")))
    text, folded = F.col("text"), F.col("folded")
    full_title, stem = F.col("full_title"), F.col("file_stem")
    fields = (
        page_texts(pages, p, keep)
        .select(
            *keep,
            "source_url",
            E.identifier(full_title, stem, p.identifier_prefix).alias("foa_id"),
            E.title(full_title, stem, p.identifier_prefix).alias("title"),
            E.agency(text, p).alias("agency"),
            E.posted_date(F.col("posted_item"), text, p, folded).alias("open_date"),
            E.due_date(text, p, folded).alias("_due"),
            E.eligibility(text, p, folded, clean=True).alias("eligibility_text"),
            E.description(text, p, folded, clean=True).alias("program_description"),
            E.award(E.award_section(text, p, folded, clean=True), p.strict_units).alias("_award"),
        )
        .select(
            *keep,
            "foa_id",
            "title",
            "agency",
            "open_date",
            F.col("_due.iso").alias("close_date"),
            F.col("_due.raw").alias("dates_raw"),
            "eligibility_text",
            "program_description",
            or_empty(F.col("_award.total")).alias("total_award"),
            or_empty(F.col("_award.range")).alias("award_range"),
            "source_url",
        )
    )
    tagged = tag_text(
        *[
            F.col(c)
            for c in ("title", "program_description", "eligibility_text", "award_range",
                      "total_award", "dates_raw")
        ]
    )
    records = with_topic_tags(
        fields.withColumn("_tag_text", tagged), "_tag_text", p.rules, "semantic_tags"
    )
    return records.select(
        *keep, *RECORD_FIELDS[:-1], F.lit(p.parser_source).alias("parser_source")
    )


def flatten_records(
    records: DataFrame, profile: Profile | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """String-only form of the records: tag lists joined, nulls empty, no parser source."""
    rules = (profile or Profile()).rules
    plain = [c for c in RECORD_FIELDS if c not in ("semantic_tags", "parser_source")]
    return records.select(
        *keep,
        *[or_empty(F.col(c)).alias(c) for c in plain],
        *joined_tags(F.col("semantic_tags"), rules),
    )


def with_calendar_dates(records: DataFrame) -> DataFrame:
    """Add ``open_date_d`` and ``close_date_d`` of type date; impossible days give null."""
    return records.withColumns(
        {f"{c}_d": calendar_date(F.col(c)) for c in ("open_date", "close_date")}
    )
