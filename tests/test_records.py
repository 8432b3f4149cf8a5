from pyspark.sql import functions as F

from grantsieve import Profile, flatten_records, parse_batch, parse_pages, url_records, with_calendar_dates
from grantsieve.contract import fixtures as fx
from grantsieve.functions.fixed_values import TOPIC_RULES
from grantsieve.operators.filters import quarantined_pages
from grantsieve.operators.records import RECORD_FIELDS
from grantsieve.plans.pipelines import catalogue_batch
from grantsieve.sinks.writers import write_catalogue_snapshot
from grantsieve.sources.pages import read_html_folder

PAGE = """<!DOCTYPE html><html><head><title>ignored</title>
<link rel="canonical" href="https://example.org/x"></head><body><nav>Menu</nav><main>
<h1 class="solicitation__title">NSF 24-539: Cell &amp; Quantum Models | NSF</h1>
<a>Skip to main content</a> U.S. National Science Foundation
<ul><li><span class="document-info_label">Posted:</span> February 30, 2024</li></ul>
Full Proposal Deadline(s): May 14, 2026
<h2>II. Program Description</h2>Machine learning for basic research across all of physics.
<h2>III. Award Information</h2>$15M in total, $400,000 to $900,000 each
<h2>IV. Eligibility Information</h2>Who May Submit Proposals: Universities with undergraduate programs only.
<h2>V. Proposal Preparation and Submission Instructions</h2>end</main></body></html>"""


def test_record(spark):
    df = spark.createDataFrame([("a__b", PAGE), ("gone", None)], "file_stem string, html string")
    assert [r.file_stem for r in quarantined_pages(df).collect()] == ["gone"]
    records = parse_pages(df)
    assert tuple(records.columns) == ("file_stem", *RECORD_FIELDS)
    (r,) = records.collect()
    tags = r.semantic_tags.asDict()
    assert list(tags) == list(TOPIC_RULES)
    assert tags["research_domains"] == ["Cellular Biology", "Physics", "Quantum", "Machine Learning"]
    assert tags["methods_approaches"] == ["Modeling", "Machine Learning"]
    assert tags["populations"] == ["Undergraduates"] and tags["sponsor_themes"] == ["Basic Research"]
    assert {c: r[c] for c in RECORD_FIELDS if c != "semantic_tags"} == {
        "foa_id": "NSF 24-539", "title": "Cell & Quantum Models",
        "agency": "National Science Foundation (NSF)", "open_date": "2024-02-30",
        "close_date": "2026-05-14", "dates_raw": "May 14, 2026",
        "eligibility_text": "Universities with undergraduate programs only.",
        "program_description": "Machine learning for basic research across all of physics.",
        "total_award": "$15M", "award_range": "$400,000 - $900,000",
        "source_url": "https://example.org/x", "parser_source": "nsf_html_local",
    }
    dated = with_calendar_dates(records).first()
    assert dated.open_date_d is None and str(dated.close_date_d) == "2026-05-14"


def test_empty_page(spark):
    df = spark.createDataFrame([("a__b", "")], "file_stem string, html string")
    (r,) = parse_pages(df).collect()
    assert (r.title, r.agency, r.open_date, r.close_date) == ("a b", "Unknown", None, None)
    flat = flatten_records(parse_pages(df)).first()
    assert flat.open_date == "" and "parser_source" not in flat.asDict() and len(flat) == 15


def test_profile_is_a_parameter(spark):
    df = spark.createDataFrame(
        [("s", "<body>Intro: a short text on robots. Stop. X</body>")], "file_stem string, html string"
    )
    p = Profile(
        boilerplate=(), description_starts=(r"\bIntro\b:",), description_ends=(r"\bStop\b",),
        description_min=5, rules={"things": {"Robot": [r"\brobots?\b"]}}, parser_source="own",
    )
    (r,) = parse_pages(df, p).collect()
    assert r.program_description == "a short text on robots."
    assert r.semantic_tags.asDict() == {"things": ["Robot"]} and r.parser_source == "own"
    assert flatten_records(parse_pages(df, p), p).first().tags_things == "Robot"


def test_record_invariants(spark, small):
    pages = fx.solicitations(spark, small)
    records = parse_pages(pages, keep=("k",)).cache()
    assert records.count() == pages.count()
    known = {label for labels in TOPIC_RULES.values() for label in labels}
    used = records.select(
        F.explode(F.flatten(F.array(*[F.col("semantic_tags")[c] for c in TOPIC_RULES]))).alias("t")
    ).distinct()
    assert {r.t for r in used.collect()} <= known
    assert records.filter("award_range <> '' AND total_award = ''").count() == 0
    assert records.filter("close_date IS NOT NULL AND dates_raw = ''").count() == 0
    texts = [c for c in RECORD_FIELDS if c not in ("open_date", "close_date", "semantic_tags")]
    assert records.filter(" OR ".join(f"{c} IS NULL" for c in texts)).count() == 0


def test_html_folder(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "deep.html").write_text("no")
    (tmp_path / "b.html").write_bytes(b"<body>caf\xc3\xa9 \xff\xfe ok \xe2\x82</body>")
    (tmp_path / "a b.html").write_bytes("<body>� kept</body>".encode())
    (tmp_path / "a.htm").write_text("no")
    rows = read_html_folder(spark, str(tmp_path)).orderBy("path").collect()
    assert [(r.file_stem, r.html) for r in rows] == [
        ("a b", "<body>� kept</body>"), ("b", "<body>café  ok </body>"),
    ]
    for r in rows:
        raw = (tmp_path / f"{r.file_stem}.html").read_text(encoding="utf-8", errors="ignore")
        assert r.html == raw


def test_single_url(spark, small):
    pages = fx.solicitations(spark, small)
    (r,) = url_records(pages, "example.org/opportunity/4", order=("k",)).collect()
    assert r.file_stem.startswith("https_example.org_opportunity_4__")
    assert url_records(pages, "nowhere.org", order=("k",)).count() == 0


def test_catalogue_batch(spark, small, tmp_path):
    write_catalogue_snapshot(fx.catalogue(spark, small), str(tmp_path / "nsf"))
    pages = fx.table(spark, small, "pages")
    done = catalogue_batch(spark, str(tmp_path / "nsf_*"), pages, 10, str(tmp_path / "out"))
    assert 0 < done.records <= 10
    assert spark.read.json(done.json).count() == done.records


def test_empty_batch_writes_no_exports(spark, tmp_path):
    df = spark.createDataFrame([("x", None)], "file_stem string, html string")
    done = parse_batch(df, str(tmp_path / "out"))
    assert (done.records, done.json, done.csv) == (0, None, None)
    assert not (tmp_path / "out" / "records_json").exists()


def test_text_without_phrases_is_not_searched_for_white_space_again(spark):
    """Cut phrases leave plain spaces only; in front, behind and next to each other."""
    from grantsieve.operators.records import page_texts

    skip, search = "Skip to main content", "National Science Foundation Search"
    bodies = [skip, f"{skip} {search}", f"a\u00a0{skip}\n{skip} <b>{search}</b>\tb", f"<p>{search}</p>x  y", "  a \u2003 b "]
    rows = [(str(i), f"<body>{b}</body>") for i, b in enumerate(bodies)]
    texts = page_texts(spark.createDataFrame(rows, "file_stem string, html string")).select("file_stem", "text")
    assert [r.text for r in texts.orderBy("file_stem").collect()] == ["", "", "a b", "x y", "a b"]
    plan = texts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("IsWhite_Space}\\x1c\\x1d\\x1e\\x1f](?:") == 1
