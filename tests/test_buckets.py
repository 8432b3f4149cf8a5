"""Pages landed in buckets by URL are met by jobs without being moved or sorted."""

from uuid import uuid4

from grantsieve.contract import fixtures as fx
from grantsieve.operators.resolve import first_pages, resolve_landed, resolve_pages
from grantsieve.plans.pipelines import jobs_of
from grantsieve.sinks.buckets import land_bucketed, open_bucketed

JOB = "ord int, url string, title string, program_id string, nsf_pd_num string"
PAGE = "page_id int, url string, html string"


def above_scan(plan: str) -> list[str]:
    """Names of the operators above the scan of page source."""
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if "FileScan" in x and "html" in x)
    depth, above = lines[at].index("FileScan"), []
    for x in reversed(lines[:at]):
        name = x.lstrip(" :+-")
        if len(x) - len(name) < depth:
            depth = len(x) - len(name)
            above.append(name.split()[0])
    return above


def test_page_source_is_neither_moved_nor_sorted(spark, small, tmp_path):
    jobs, pages = jobs_of(fx.catalogue(spark, small)), fx.table(spark, small, "pages")
    name = f"t_{uuid4().hex}"
    landed = land_bucketed(pages, name, str(tmp_path / "b"), 13)
    for threshold in ("10485760", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            found = resolve_landed(jobs, landed)
            above = above_scan(found._jdf.queryExecution().executedPlan().toString())
            assert "ShuffledHashJoin" in above and not {"Exchange", "Sort", "SortAggregate"} & set(above), above
            got = sorted(map(tuple, found.collect()))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert got == sorted(map(tuple, resolve_pages(jobs, pages).collect())) and len(got) > 10


def test_one_page_per_url_and_a_table_opened_anew(spark, tmp_path):
    pages = spark.createDataFrame(
        [(9, "u1", "late"), (4, "u1", "early"), (1, "u1", None), (None, "u2", "x"), (5, "u3", "b"), (5, "u3", "a"), (5, "u3", "a"),
         (1, None, "no url"), (7, "u4", None), (3, "it's", "q")], PAGE,
    ).selectExpr("*", "1 as file_stem")
    path, name = str(tmp_path / "it's"), f"t_{uuid4().hex}"
    want = [("it's", "q"), ("u1", "early"), ("u2", "x"), ("u3", "a")]
    assert sorted(map(tuple, land_bucketed(pages, name, path, 3).collect())) == want
    assert sorted(map(tuple, first_pages(pages).collect())) == want
    again = open_bucketed(spark, f"t_{uuid4().hex}", path, 3)
    jobs = spark.createDataFrame([(0, "u1", "T", None, None), (1, "u9", None, None, None), (2, None, None, None, None)], JOB)
    found = resolve_landed(jobs, again)
    assert [(r["url"], r["html"]) for r in found.collect()] == [("u1", "early")]
    assert "Exchange" not in above_scan(found._jdf.queryExecution().executedPlan().toString())
    # landing again replaces the table, also by nothing
    assert land_bucketed(pages.limit(0), name, path, 3).count() == 0
