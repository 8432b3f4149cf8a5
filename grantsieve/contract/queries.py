"""One registered query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import extract as E
from ..functions import html as H
from ..functions import scalars as S
from ..functions import text as X
from ..functions.fixed_values import Profile
from ..functions.tagging import joined_tags, tag_text
from ..operators.dedup import first_n, keep_first, page_order
from ..operators.filters import drop_blank_urls, is_success, looks_like_html, quarantined_pages
from ..operators.records import (
    RECORD_FIELDS, flatten_records, page_texts, parse_pages, record_schema,
    with_calendar_dates, with_topic_tags,
)
from ..operators.resolve import (
    fetch_log, first_failures, outcome_summary, page_index, resolve_attempts, resolve_landed,
    resolve_pages, with_page_key,
)
from ..operators.rule_table import labels_by_category, phrase_index, rule_hits
from ..plans import pipelines as L
from ..session import shared_folder
from ..sinks import buckets as B
from ..sinks import writers as K
from ..sources.catalogue import job_rows, newest_snapshot, payload_records, read_catalogue
from ..sources.pages import read_html_folder
from ..streaming.jobs import write_first_jobs
from . import fixtures as fx
from .fixtures import table
from .rules import WORD_RULES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
P = Profile()


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def documents(spark, sf_dir, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", *columns)


def texts(spark, sf_dir) -> DataFrame:
    return page_texts(fx.solicitation_pages(spark, sf_dir), P, ("k", "file_stem"))


def visible(spark, sf_dir) -> DataFrame:
    pages = fx.solicitations(spark, sf_dir)
    return pages.select("k", H.visible_markup(F.col("html"), P.hidden_elements).alias("v"))


def jobs(spark, sf_dir) -> DataFrame:
    return L.jobs_of(fx.catalogue(spark, sf_dir))


def log(spark, sf_dir) -> DataFrame:
    return fetch_log(jobs(spark, sf_dir), page_index(table(spark, sf_dir, "pages")), "landed")


# ---- text and scalars -------------------------------------------------------------


@query
def x1_clean_text(spark, sf_dir):
    d = documents(spark, sf_dir, "text")
    return d.select("doc_id", X.clean_text(F.col("text")).alias("clean"))


@query
def x2_remove_boilerplate(spark, sf_dir):
    raw = visible(spark, sf_dir).select("k", H.markup_text(F.col("v")).alias("t"))
    return raw.select("k", X.remove_phrases(F.col("t"), P.boilerplate).alias("text"))


@query
def x3_iso_date(spark, sf_dir):
    return texts(spark, sf_dir).select("k", S.iso_date(F.col("text")).alias("iso"))


@query
def x4_date_as_written(spark, sf_dir):
    return texts(spark, sf_dir).select("k", S.date_as_written(F.col("text")).alias("raw"))


@query
def x5_normalize_url(spark, sf_dir):
    c = fx.catalogue(spark, sf_dir)
    return c.select("ord", S.normalize_url(F.col("Solicitation URL")).alias("url"))


@query
def x6_safe_filename(spark, sf_dir):
    d = documents(spark, sf_dir, "text")
    return d.select("doc_id", S.safe_filename(F.col("text")).alias("name"))


@query
def x7_sha1(spark, sf_dir):
    d = documents(spark, sf_dir, "text")
    return d.select("doc_id", S.sha1_hex(F.col("text")).alias("sha1"))


@query
def x8_page_key(spark, sf_dir):
    rows = drop_blank_urls(job_rows(fx.catalogue(spark, sf_dir)))
    return with_page_key(rows).select("ord", "file_stem")


@query
def x9_money_value(spark, sf_dir):
    tokens = texts(spark, sf_dir).select(
        "k", F.posexplode(S.money_tokens(F.col("text"))).alias("pos", "raw")
    )
    return tokens.select(
        "k", F.col("pos").cast("bigint").alias("pos"), S.money_value(F.col("raw")).alias("value")
    )


@query
def x10_money_tokens(spark, sf_dir):
    t = texts(spark, sf_dir)
    return t.select("k", X.join_list(S.money_tokens(F.col("text")), "|").alias("tokens"))


@query
def x11_join_list(spark, sf_dir):
    d = documents(spark, sf_dir, "text", "lang")
    return d.select("doc_id", X.join_list(F.split("text", " "), "; ").alias("words"))


@query
def x12_or_empty(spark, sf_dir):
    a = fx.attempts(spark, sf_dir)
    return a.select("url", "attempt", X.or_empty(F.col("error")).alias("error"))


@query
def x13_strip(spark, sf_dir):
    c = fx.catalogue(spark, sf_dir)
    return c.select(
        "ord", *[X.strip_space(F.col(f"`{n}`")).alias(a) for n, a in
                 (("Title", "title"), ("Program ID", "program_id"), ("NSF/PD Num", "nsf_pd_num"))]
    )


@query
def s5_file_stem(spark, sf_dir):
    path = F.concat(F.lit("/landed/a.b/"), F.col("file_stem"), F.lit(".v1.html"))
    return fx.solicitations(spark, sf_dir).select("k", S.file_stem(path).alias("stem"))


# ---- catalogue, filters, deduplication ---------------------------------------------


@query
def s2_job_rows(spark, sf_dir):
    return job_rows(fx.catalogue(spark, sf_dir))


@query
def s1_s4_k6_catalogue_round_trip(spark, sf_dir):
    base = shared_folder(spark, "catalogue")
    K.write_catalogue_snapshot(fx.catalogue(spark, sf_dir), f"{base}/nsf")
    return job_rows(read_catalogue(spark, newest_snapshot(spark, f"{base}/nsf_*"))).drop(
        "source_file", "ord"
    )


@query
def s3_html_folder(spark, sf_dir):
    """The given pages as one text file each, read back as page files."""
    out = shared_folder(spark, "files")
    fx.write_page_files(fx.keyed_pages(spark, sf_dir).select("file_stem", "html"), out)
    files = read_html_folder(spark, out, "*.txt")
    stem = F.regexp_extract("path", r"file_stem=([^/]+)\.txt$", 1)
    return files.select(stem.alias("file_stem"), S.sha1_hex(F.col("html")).alias("sha1"))


@query
def p1_drop_blank_urls(spark, sf_dir):
    return drop_blank_urls(job_rows(fx.catalogue(spark, sf_dir))).select("ord", "url")


@query
def p2_reject_html_payload(spark, sf_dir):
    payloads = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("page "), "page_id").alias("id"), F.concat(F.lit("\n "), "html").alias("payload")
    ).union(
        table(spark, sf_dir, "documents").select(
            F.concat(F.lit("doc "), "doc_id").alias("id"), F.col("text").alias("payload")
        )
    )
    return payloads.filter(~looks_like_html(F.col("payload"))).select("id")


@query
def p3_success_status(spark, sf_dir):
    a = fx.attempts(spark, sf_dir)
    return a.select("url", "attempt", "status", is_success(F.col("status")).alias("ok"))


@query
def p4_quarantined_pages(spark, sf_dir):
    """Fetched bodies as pages: those without a body are set aside."""
    pages = fx.attempts(spark, sf_dir).select("url", "attempt", F.col("body").alias("html"))
    return quarantined_pages(pages)


@query
def p5_positive_amounts(spark, sf_dir):
    ranked = texts(spark, sf_dir).select("k", E.rank_amounts(F.col("text")).alias("r"))
    return ranked.select(
        "k",
        F.size("r").cast("bigint").alias("n"),
        F.array_join(F.col("r.raw"), "|").alias("ascending"),
    )


@query
def p6_length_gate(spark, sf_dir):
    d = documents(spark, sf_dir, "text")
    return d.select("doc_id", X.longer_than(X.clean_text(F.col("text")), 30).alias("kept"))


@query
def d1_keep_first(spark, sf_dir):
    return keep_first(drop_blank_urls(job_rows(fx.catalogue(spark, sf_dir))), "url")


@query
def d1_keep_first_stream(spark, sf_dir):
    """The catalogue as a stream, each URL once."""
    schema = table(spark, sf_dir, "pages").schema
    # a pattern finds the table as one file and as a folder of part files alike; a stream takes
    # the plain path of a folder only
    pages = spark.readStream.schema(schema).parquet(f"{sf_dir}/[p]ages.parquet")
    path = shared_folder(spark, "jobs")
    write_first_jobs(drop_blank_urls(job_rows(fx.catalogue_of(pages))), path).awaitTermination()
    return spark.read.parquet(path)


@query
def d2_first_n(spark, sf_dir):
    return first_n(jobs(spark, sf_dir), 100)


@query
def d3_first_failures(spark, sf_dir):
    return first_failures(log(spark, sf_dir))


@query
def d4_page_order(spark, sf_dir):
    return fx.solicitations(spark, sf_dir).orderBy(page_order()).select("file_stem")


@query
def d5_stable_order_of_amounts(spark, sf_dir):
    ranked = texts(spark, sf_dir).select(
        "k", F.posexplode(E.rank_amounts(F.col("text"))).alias("rank", "a")
    )
    return ranked.select(
        "k", F.col("rank").cast("bigint").alias("rank"), F.col("a.raw").alias("raw"),
        F.col("a.pos").cast("bigint").alias("pos"),
    )


# ---- resolution and summaries -------------------------------------------------------


@query
def j1_resolve_jobs(spark, sf_dir):
    return log(spark, sf_dir)


@query
def j1_resolve_pages(spark, sf_dir):
    return resolve_pages(jobs(spark, sf_dir), table(spark, sf_dir, "pages"))


@query
def j1_resolve_landed(spark, sf_dir):
    """Pages landed in buckets by URL, then met by all jobs without moving page source."""
    landed = B.land_bucketed(
        table(spark, sf_dir, "pages"), f"landed_{uuid4().hex}", shared_folder(spark, "buckets"), 16
    )
    return resolve_landed(jobs(spark, sf_dir), landed)


@query
def a1_outcome_summary(spark, sf_dir):
    return outcome_summary(log(spark, sf_dir))


@query
def a2_payload_records(spark, sf_dir):
    d = documents(spark, sf_dir, "text")
    return d.select("doc_id", payload_records(F.col("text")).alias("records"))


@query
def a2_record_count(spark, sf_dir):
    return parse_pages(fx.keyed_pages(spark, sf_dir)).agg(F.count("*").alias("records"))


@query
def a3_amount_bounds(spark, sf_dir):
    ranked = texts(spark, sf_dir).select("k", E.rank_amounts(F.col("text")).alias("r"))
    return ranked.select(
        "k",
        F.get("r", F.lit(0))["v"].alias("smallest"),
        F.try_element_at("r", F.lit(-1))["v"].alias("largest"),
    )


@query
def a4_resolve_attempts(spark, sf_dir):
    return resolve_attempts(fx.attempts(spark, sf_dir))


@query
def a4_resolve_attempts_more_retries(spark, sf_dir):
    return resolve_attempts(fx.attempts(spark, sf_dir), retries=5)


# ---- HTML ---------------------------------------------------------------------------


@query
def h1_element_text(spark, sf_dir):
    pages = fx.keyed_pages(spark, sf_dir).select(
        "page_id", H.visible_markup(F.col("html"), P.hidden_elements).alias("v")
    )
    return pages.select("page_id", H.markup_text(H.element_markup(F.col("v"), "title")).alias("title"))


@query
def h2_page_text(spark, sf_dir):
    return page_texts(fx.keyed_pages(spark, sf_dir), P, ("page_id",)).select("page_id", "text")


@query
def h2_solicitation_text(spark, sf_dir):
    return texts(spark, sf_dir).select("k", "text")


@query
def h3_canonical_url(spark, sf_dir):
    return visible(spark, sf_dir).select("k", H.canonical_url(F.col("v")).alias("source_url"))


@query
def h4_heading(spark, sf_dir):
    return visible(spark, sf_dir).select("k", H.heading(F.col("v"), P.title_class).alias("heading"))


@query
def h5_labelled_item(spark, sf_dir):
    item = H.labelled_item(F.col("v"), P.posted_class, P.posted_label)
    return visible(spark, sf_dir).select("k", H.markup_text(item).alias("item"))


# ---- extraction ---------------------------------------------------------------------


@query
def e1_slice_between(spark, sf_dir):
    sliced = E.slice_between(
        F.col("text"), P.description_starts, P.description_ends, F.col("folded"), clean=True
    )
    return texts(spark, sf_dir).select("k", sliced.alias("section"))


@query
def e2_identifier(spark, sf_dir):
    return texts(spark, sf_dir).select(
        "k", E.identifier(F.col("full_title"), F.col("file_stem")).alias("foa_id")
    )


@query
def e3_title(spark, sf_dir):
    return texts(spark, sf_dir).select(
        "k", E.title(F.col("full_title"), F.col("file_stem")).alias("title")
    )


@query
def e4_agency(spark, sf_dir):
    return texts(spark, sf_dir).select("k", E.agency(F.col("text"), P).alias("agency"))


@query
def e5_posted_date(spark, sf_dir):
    posted = E.posted_date(F.col("posted_item"), F.col("text"), P, F.col("folded"))
    return texts(spark, sf_dir).select("k", posted.alias("open_date"))


@query
def e6_due_date(spark, sf_dir):
    due = texts(spark, sf_dir).select("k", E.due_date(F.col("text"), P, F.col("folded")).alias("d"))
    return due.select("k", F.col("d.raw").alias("dates_raw"), F.col("d.iso").alias("close_date"))


@query
def e7_description(spark, sf_dir):
    return texts(spark, sf_dir).select(
        "k", E.description(F.col("text"), P, F.col("folded"), clean=True).alias("program_description")
    )


@query
def e8_award_section(spark, sf_dir):
    return texts(spark, sf_dir).select(
        "k", E.award_section(F.col("text"), P, F.col("folded"), clean=True).alias("section")
    )


@query
def e9_award(spark, sf_dir):
    award = E.award(E.award_section(F.col("text"), P, F.col("folded"), clean=True))
    a = texts(spark, sf_dir).select("k", award.alias("a"))
    return a.select("k", F.col("a.total").alias("total_award"), F.col("a.range").alias("award_range"))


@query
def e9_award_strict_units(spark, sf_dir):
    award = E.award(E.award_section(F.col("text"), P, F.col("folded"), clean=True), strict_units=True)
    a = texts(spark, sf_dir).select("k", award.alias("a"))
    return a.select("k", F.col("a.total").alias("total_award"), F.col("a.range").alias("award_range"))


@query
def e10_e11_eligibility(spark, sf_dir):
    return texts(spark, sf_dir).select(
        "k", E.eligibility(F.col("text"), P, F.col("folded"), clean=True).alias("eligibility_text")
    )


# ---- tags, records, pipelines -------------------------------------------------------


@query
def t1_topic_tags(spark, sf_dir):
    d = with_topic_tags(documents(spark, sf_dir, "text"), "text", P.rules)
    return d.select("doc_id", *joined_tags(F.col("tags"), P.rules))


@query
def t1_topic_tags_own_rules(spark, sf_dir):
    d = with_topic_tags(documents(spark, sf_dir, "text"), "text", WORD_RULES)
    return d.select("doc_id", *joined_tags(F.col("tags"), WORD_RULES))


@query
def t1_rule_table(spark, sf_dir):
    """Which documents hold the first two words of which others: a rule for every document."""
    d = documents(spark, sf_dir, "text", "lang")
    phrase = F.lower(F.regexp_extract("text", r"^[A-Za-z0-9]+ [A-Za-z0-9]+(?=[ .,\n]|$)", 0))
    openings = d.filter(phrase != "").groupBy(phrase.alias("phrase")).agg(F.min(F.coalesce("lang", F.lit(""))).alias("category"))
    rules = openings.select("category", F.col("phrase").alias("label"), F.lit(0).alias("place"), "phrase")
    hits = labels_by_category(rule_hits(d, phrase_index(rules), ("doc_id",)), ("doc_id",))
    return hits.select("doc_id", "category", X.join_list(F.col("labels")).alias("labels"))


@query
def t1_page_topics(spark, sf_dir):
    t = page_texts(fx.keyed_pages(spark, sf_dir), P, ("page_id",))
    tagged = with_topic_tags(t.select("page_id", "text"), "text", P.rules)
    return tagged.select("page_id", *joined_tags(F.col("tags"), P.rules))


@query
def t2_tag_text(spark, sf_dir):
    r = parse_pages(fx.solicitation_pages(spark, sf_dir), P, ("k",))
    fields = ("title", "program_description", "eligibility_text", "award_range", "total_award", "dates_raw")
    return r.select("k", tag_text(*[F.col(c) for c in fields]).alias("tag_text"))


@query
def r1_records(spark, sf_dir):
    r = parse_pages(fx.solicitation_pages(spark, sf_dir), P, ("k",))
    plain = [c for c in RECORD_FIELDS if c != "semantic_tags"]
    return r.select("k", *plain, *joined_tags(F.col("semantic_tags"), P.rules))


@query
def r1_page_records(spark, sf_dir):
    r = parse_pages(fx.keyed_pages(spark, sf_dir), P, ("page_id",))
    plain = [c for c in RECORD_FIELDS if c != "semantic_tags"]
    return r.select("page_id", *plain, *joined_tags(F.col("semantic_tags"), P.rules))


@query
def r2_flat_records(spark, sf_dir):
    return flatten_records(parse_pages(fx.solicitation_pages(spark, sf_dir), P, ("k",)), P, ("k",))


@query
def r1_calendar_dates(spark, sf_dir):
    r = with_calendar_dates(parse_pages(fx.solicitation_pages(spark, sf_dir), P, ("k",)))
    return r.select(
        "k", *[F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("open_date_d", "close_date_d")]
    )


@query
def l1_k2_json_round_trip(spark, sf_dir):
    out = shared_folder(spark, "records")
    written = L.parse_batch(fx.solicitation_pages(spark, sf_dir).drop("k"), out)
    return flatten_records(spark.read.schema(record_schema()).json(written.json))


@query
def l1_k3_csv_round_trip(spark, sf_dir):
    out = shared_folder(spark, "records")
    written = L.parse_batch(fx.solicitation_pages(spark, sf_dir).drop("k"), out)
    back = spark.read.option("header", True).option("escape", '"').csv(written.csv)
    return back.na.fill("")


@query
def k1_json_per_record(spark, sf_dir):
    out = shared_folder(spark, "records")
    K.write_json_per_record(parse_pages(fx.keyed_pages(spark, sf_dir)), out)
    back = spark.read.schema(record_schema().add("file_stem", "string")).json(out)
    return back.select("file_stem", "title", "agency", "open_date")


@query
def k4_fetch_log_round_trip(spark, sf_dir):
    path = shared_folder(spark, "log")
    return L.fetch_batch(jobs(spark, sf_dir), table(spark, sf_dir, "pages"), path, "landed").log


@query
def k5_land_pages_round_trip(spark, sf_dir):
    path = shared_folder(spark, "landed")
    K.land_pages(resolve_pages(jobs(spark, sf_dir), table(spark, sf_dir, "pages")), path)
    return spark.read.parquet(path)


@query
def p7_empty_batch(spark, sf_dir):
    """A batch of all given pages and one without pages: records, and whether it was exported."""
    rows = []
    for batch, pages in (("all", fx.keyed_pages(spark, sf_dir)), ("none", fx.keyed_pages(spark, sf_dir).limit(0))):
        done = L.parse_batch(pages, shared_folder(spark, "batch"))
        rows.append((batch, done.records, done.json is not None and done.csv is not None))
    return spark.createDataFrame(rows, "batch string, records bigint, exported boolean")


@query
def l2_catalogue_records(spark, sf_dir):
    r = L.catalogue_records(fx.catalogue(spark, sf_dir), table(spark, sf_dir, "pages"), 100)
    return flatten_records(r, P, ("file_stem",))


@query
def l3_url_record(spark, sf_dir):
    pages = fx.solicitation_pages(spark, sf_dir)
    return flatten_records(L.url_records(pages, " example.org/opportunity/7 ", P, ("k",)))


def attempted(spark, sf_dir) -> L.Fetched:
    path = shared_folder(spark, "log")
    return L.fetch_batch_from_attempts(fx.order_jobs(spark, sf_dir), fx.attempts(spark, sf_dir), path, "landed")


@query
def l4_fetch_batch_from_attempts(spark, sf_dir):
    return attempted(spark, sf_dir).log


@query
def l4_attempts_summary(spark, sf_dir):
    return attempted(spark, sf_dir).summary


@query
def l4_attempts_first_failures(spark, sf_dir):
    return attempted(spark, sf_dir).failures


@query
def l4_fetch_batch_summary(spark, sf_dir):
    path = shared_folder(spark, "log")
    return L.fetch_batch(jobs(spark, sf_dir), table(spark, sf_dir, "pages"), path, "landed").summary
