"""Solicitation pages, catalogue and fetch attempts derived from the given tables.

The given pages hold no dated or priced text, so one solicitation page per order is
composed by plain concatenation. Each layer is a list of (name, expression) in the SQL
that Spark and DuckDB share; ``{div:a,b}``-like places are filled per engine. Which
variant of a part a page gets depends on the order key, so sizes grow with the data.
"""

from __future__ import annotations

import re

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


Layer = list[tuple[str, str]]

PAGES_A_PART = 25_000  # composed and parsed by one task: some seconds

_MONEY = "cast({n} div 1000 as string) || ',' || lpad(cast({n} % 1000 as string), 3, '0')"


def _case(selector: str, *variants: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(variants[:-1]))
    return f"CASE {selector} {whens} ELSE {variants[-1]} END"


_FILLER = "repeat('Submission guidance follows in this passage. ', 13)"
_FORTY = "Basic research training for nano physics"

SOLICITATION_LAYERS: list[Layer] = [
    [
        ("k", "o_orderkey"),
        ("nation", "n_name"),
        ("seg", "lower(c_mktsegment)"),
        ("day", "o_orderdate"),
        ("amount", "cast(floor(o_totalprice) as bigint)"),
    ],
    [
        ("k", "k"),
        ("nation", "nation"),
        ("seg", "seg"),
        ("due", "DATE_TEXT(day)"),
        ("a", "'$' || " + _MONEY.format(n="amount")),
        ("b", "'$' || " + _MONEY.format(n="(amount * 2 + k % 7)")),
        ("num", "cast(10 + k % 90 as string) || '-' || cast(500 + k % 97 as string)"),
        ("digits", "cast(10 + k % 90 as string) || cast(500 + k % 97 as string)"),
    ],
    [
        ("k", "k"),
        (
            "file_stem",
            _case(
                "k % 4",
                "'page_' || cast(k as string)",
                "'page__' || cast(k as string)",
                "'opp__nsf' || digits || '__' || cast(k as string)",
                "'NSF_' || num || '__plain__' || cast(k as string)",
            ),
        ),
        (
            "head",
            "'<meta charset=\"utf-8\"><style>p{{margin:0}}</style>' || "
            + _case(
                "k % 8",
                "'<title>Opportunities</title>'",
                "'<title>NSF ' || num || ': Grants for ' || seg || ' &amp; more | NSF - U.S. National Science Foundation</title>'",
                "'<title>Grants for ' || seg || ' |nsf site</title>'",
                "'<title>Plain ' || nation || ' call</title>'",
                "'<title></title>'",
                "'<TITLE>nsf' || num || ' : ' || nation || '&nbsp;&mdash; call</TITLE>'",
                "'<title>| NSF only</title>'",
                "''",
            )
            + " || "
            + _case(
                "(k div 4) % 4",
                "CASE WHEN k % 2 = 0 THEN '<link rel=\"canonical\" href=\"https://example.org/p/' || cast(k as string) || '?a=1&amp;b=2\">' "
                "ELSE '<link href=\" https://example.org/q/' || cast(k as string) || ' \" rel=\"shortlink canonical\">' END",
                "'<link rel=\"canonical\" href=\"\"><meta property=\"og:url\" content=\"https://example.org/og/' || cast(k as string) || '\">'",
                "'<meta content=\"https://example.org/m/' || cast(k as string) || '?x=1&lang=en&order=2&copy=2&foo;b&amp;c=3\" property=\"og:url\"/>'",
                "'<link rel=\"alternate\" href=\"https://example.org/none\">'",
            ),
        ),
        (
            "top",
            "CASE WHEN k % 4 = 0 THEN '<h1 class=\"page-title solicitation__title\" id=\"t\">' || chr(10) || 'NSF&nbsp;' || num || ':  <b>' || seg || '</b> cells | nsf 24-1</h1>' "
            "WHEN k % 8 = 7 THEN '<h1 class=\"solicitation__title\"> </h1>' ELSE '<h1>Heading</h1>' END",
        ),
        (
            "agency",
            _case(
                "(k div 9) % 3",
                "'<p>U.S. National Science Foundation</p>'",
                "'<a href=\"#\">National Science Foundation</a> <b>Search</b>'",
                "'<p title=it' || chr(39) || 's>Another <b>it' || chr(39) || 's</b> national science foundation <i>it' || chr(39) || 's</i></p>'",
            ),
        ),
        (
            "posted",
            _case(
                "(k div 3) % 3",
                "'<ul><li>first</li><li class=\"i\"><span class=\"document-info_label\"> Posted: </span>' || chr(10) || due || '</li></ul>'",
                "'<p>Posted : ' || due || '</p>'",
                "'<ul><li><span class=\"x document-info_label\"><b>POSTED:</b></span>To be announced</li></ul><p>Posted: ' || due || '</p>'",
            ),
        ),
        (
            "deadline",
            _case(
                "k % 5",
                "'<p>Full Proposal Deadline(s): ' || due || ' (due by 5 p.m.)</p>'",
                "'<p>Full Proposal Deadline: ' || due || ' or <i>Proposals accepted anytime</i></p>'",
                "'<p>Full Proposal Deadline ' || " + _FILLER + " || 'May 4, 2031 full proposal deadline(s) ' || due || '</p>'",
                "'<p>proposals accepted ANYTIME</p>'",
                "'<p>No deadline, see ' || due || '</p>'",
            ),
        ),
        (
            "description",
            _case(
                "k % 7",
                "'II. Program Description: Quantum ideas for the ' || seg || ' sector, machine learning &amp; open-source tools, K-12 pupils. Overall Approach follows.'",
                "'ii.Program Description ' || due || ' Genetics of caf&eacute; crops for graduate students &#8217;and&#x2019; postdocs in ' || nation || '. '",
                "'II. Program Description " + _FORTY[:39] + " '",
                "'II. Program Description " + _FORTY + " '",
                "'<p>Summary of AI work.</p>'",
                "'II. Program Description: Interdisciplinary workforce education in ' || nation || ' with early-career modelling. '",
                "'II. Program Description III. Award Information IV. Eligibility Information V. Proposal Preparation. II. Program Description: software for ' || seg || '. '",
            ),
        ),
        (
            "award",
            "CASE WHEN k % 7 = 5 THEN '' ELSE '<h2>III. Award Information</h2>' END || '<p>' || "
            + _case(
                "(k div 16) % 8",
                "'Awards vary by year<![CDATA[ > see site]]>.'",
                "'Anticipated funding is ' || a || '.'",
                "'Between ' || b || ' and ' || a || ' per award'",
                "'Total ' || b || ', with awards from ' || a || ', to $90,000'",
                "'Once ' || a || ', again ' || a || ' in total'",
                "'Up to $15M with ' || a || ' each'",
                "'$2.5 million over five years; ' || a || ' yearly and $ 3.25 billion'",
                "'$300,000 maximum, $5 by mail, $0 fee, ' || a || ' kits'",
            )
            + " || '</p>'",
        ),
        (
            "eligibility",
            _case(
                "(k div 5) % 5",
                "'<h2>IV. Eligibility Information:</h2> Preamble. <b>Who May Submit Proposals:</b> Universities of ' || nation || ' and undergraduate partners. <h2>V. Proposal Preparation and Submission Instructions</h2> rest'",
                "'IV.  Eligibility Information Institutions located in ' || nation || ' with broadening participation plans. VI. NSF Proposal Processing rest'",
                "'IV. Eligibility: ' || CASE WHEN k % 2 = 0 THEN 'Who May Submit Proposals: Anyone.' ELSE 'All.' END || ' V. Proposal Preparation and rest. Who may submit proposals : Labs &amp; teams of ' || nation || ' Merit Review Criteria'",
                "'Who May Submit Proposals: Scientists of ' || nation || ' at accredited sites C. Due Dates apply. Merit Review Criteria'",
                "'Who May Submit Proposals: anybody in ' || nation || ' whatsoever &amp;lt;end&gt;'",
            ),
        ),
        ("root", "k % 3"),
    ],
    [
        ("k", "k"),
        ("file_stem", "file_stem"),
        ("url", "'https://example.org/opportunity/' || cast(k as string)"),
        (
            "body",
            "'<!-- II. Program Description: hidden comment --><script>var a=\"<main>\";</script x>' || top || "
            "'<p><a href=\"#c\" title=\"a>b\">Skip to main content</a></p>' || agency || posted || chr(10) || deadline || "
            "'<div>' || description || '</div>' || award || chr(10) || chr(9) || eligibility || '<p>&copy; site</p>'",
        ),
        ("head", "head"),
        ("root", "root"),
    ],
    [
        ("k", "k"),
        ("file_stem", "file_stem"),
        ("url", "url"),
        (
            "html",
            "'<!DOCTYPE html><html><head>' || head || '</head>' || "
            + _case(
                "root",
                "'<body><nav>Menu National Science Foundation</nav><main id=\"m\">' || body || '</main><footer>Foot $9</footer></body>'",
                "'<body class=\"b\">' || body || '<script>var x=\"II. Program Description\";</body>'",
                "body",
            )
            + " || '</html>'",
        ),
    ],
]

# pages of the given table as a catalogue: repeated, quoted, schemeless and blank URLs
CATALOGUE_LAYER: Layer = [
    ("ord", "copy * 1000000000 + page_id"),
    (
        "Solicitation URL",
        "CASE WHEN page_id % 11 = 0 THEN ' ' WHEN page_id % 5 = 0 THEN ' \"' || url || '\" ' "
        "WHEN page_id % 7 = 0 THEN replace(replace(url, 'https://', ''), 'http://', '') ELSE url END",
    ),
    ("Title", "'  Call \"' || cast(page_id as string) || '\", part ' || cast(copy as string) || ' & more  '"),
    ("Program ID", "CASE WHEN page_id % 3 = 0 THEN '  ' ELSE 'P-' || cast(page_id % 13 as string) END"),
    ("NSF/PD Num", "CASE WHEN page_id % 4 = 0 THEN '' ELSE cast(page_id as string) || '/' || cast(copy as string) END"),
]

# order lines as logged fetch attempts
ATTEMPT_LAYER: Layer = [
    ("url", "'https://example.org/o/' || cast(l_orderkey as string)"),
    ("attempt", "cast(l_linenumber - 1 as int)"),
    (
        "status",
        "cast(CASE cast(l_quantity as bigint) % 5 WHEN 0 THEN 200 WHEN 1 THEN NULL WHEN 2 THEN 404 "
        "WHEN 3 THEN 503 ELSE 300 END as int)",
    ),
    (
        "error",
        "CASE WHEN cast(l_quantity as bigint) % 5 = 1 THEN 'ConnectTimeout: part ' || cast(l_partkey as string) END",
    ),
    (
        "body",
        "CASE WHEN cast(l_quantity as bigint) % 5 = 0 THEN 'page of ' || cast(l_partkey as string) || ' from ' || cast(l_suppkey as string) END",
    ),
]


# orders as jobs of these attempts; some were never tried
ORDER_JOB_LAYER: Layer = [
    ("ord", "o_orderkey"),
    (
        "url",
        "CASE WHEN o_orderkey % 50 = 0 THEN 'https://example.org/never/' ELSE 'https://example.org/o/' END "
        "|| cast(o_orderkey as string)",
    ),
    ("title", "CASE WHEN o_orderkey % 3 = 0 THEN 'Order ' || cast(o_orderkey as string) END"),
    ("program_id", "CASE WHEN o_orderkey % 5 = 0 THEN 'P-' || cast(o_orderkey % 13 as string) END"),
    ("nsf_pd_num", "CASE WHEN o_orderkey % 7 = 0 THEN cast(o_orderkey % 97 as string) || '/1' END"),
]


def _spark(expression: str) -> str:
    return re.sub(r"DATE_TEXT\((\w+)\)", r"date_format(\1, 'MMMM d, yyyy')", expression).replace(
        "{{", "{"
    ).replace("}}", "}")


def _duckdb(expression: str) -> str:
    e = re.sub(r"DATE_TEXT\((\w+)\)", r"strftime(\1, '%B %-d, %Y')", expression)
    return e.replace(" div ", " // ").replace("{{", "{").replace("}}", "}")


def _select(df: DataFrame, layer: Layer) -> DataFrame:
    return df.selectExpr(*[f"{_spark(e)} AS `{n}`" for n, e in layer])


def _sql(source: str, layer: Layer) -> str:
    return "SELECT " + ", ".join(f'{_duckdb(e)} AS "{n}"' for n, e in layer) + f" FROM {source}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def solicitations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``k, file_stem, url, html``: one page per order."""
    orders, customer, nation = (table(spark, sf_dir, n) for n in ("orders", "customer", "nation"))
    df = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey
    )
    # Pages are composed from short rows, which cost little to deal out first. Their size says
    # nothing of the work, so the number of parts is stated: a stated one is never coalesced. It
    # stands behind the joins, as one that shuffles would deal the rows out anew, by their size.
    # It follows the orders, which the files' footers count, as well as the cores: a part is then
    # the same work in a table of any size, also where executors are late or the cores few.
    parts = max(4 * spark.sparkContext.defaultParallelism, -(-orders.count() // PAGES_A_PART))
    df = _select(df, SOLICITATION_LAYERS[0]).repartition(parts, "k")
    for layer in SOLICITATION_LAYERS[1:]:
        df = _select(df, layer)
    return df


def solicitation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, each page composed once, for queries that use ``html``.

    A filter on ``html`` would otherwise be taken for one on all that a page is composed of, and
    move in front of the parts dealt out: every page was composed a second time, in the few tasks
    of the joins, by one method too long to be compiled. No filter passes a generated column.
    """
    return solicitations(spark, sf_dir).selectExpr("k", "file_stem", "url", "explode(array(html)) AS html")


def solicitations_sql() -> str:
    source = (
        "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
    )
    sql = _sql(source, SOLICITATION_LAYERS[0])
    for layer in SOLICITATION_LAYERS[1:]:
        sql = _sql(f"({sql})", layer)
    return sql


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue rows with ``ord``; every page is listed twice, with different titles."""
    return catalogue_of(table(spark, sf_dir, "pages"))


def catalogue_of(pages: DataFrame) -> DataFrame:
    """The same from a table or a stream of pages."""
    urls = pages.select("page_id", "url")
    return _select(urls.selectExpr("*", "explode(array(0, 1)) AS copy"), CATALOGUE_LAYER)


def catalogue_sql() -> str:
    return _sql("(SELECT page_id, url, unnest([0, 1]) AS copy FROM pages)", CATALOGUE_LAYER)


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "lineitem"), ATTEMPT_LAYER)


def attempts_sql() -> str:
    return _sql("lineitem", ATTEMPT_LAYER)


def order_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job per order, most of them with attempts."""
    return _select(table(spark, sf_dir, "orders"), ORDER_JOB_LAYER)


def order_jobs_sql() -> str:
    return _sql("orders", ORDER_JOB_LAYER)


def keyed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given pages with a file stem."""
    pages = table(spark, sf_dir, "pages")
    return pages.selectExpr("page_id", "'page_' || cast(page_id as string) AS file_stem", "url", "html")


def write_page_files(pages: DataFrame, out: str) -> None:
    """One text file ``part=<task>/file_stem=<stem>.txt`` per page of ``file_stem, html``, a line end behind it.

    Rows of one stem share a file where one task holds them. Spark's own writer makes a folder per
    page, lets the driver move them one by one, and sets the rights of each file, its checksum
    and its folder, on a local disk by a process each. A task that runs again writes the same files.
    """

    def write(batches):
        # self-contained, as executors need not have this package
        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(out)
        folder = f"{top}/part={TaskContext.get().partitionId()}"
        store.create_dir(folder, recursive=True)
        last, file = None, None
        for batch in batches:
            for stem, html in zip(batch["stem"].to_pylist(), batch["html"], strict=True):
                if stem != last:
                    if file:
                        file.close()
                    last, file = stem, store.open_output_stream(f"{folder}/file_stem={stem}.txt")
                file.write((html.as_py() or b"") + b"\n")
        if file:
            file.close()
        yield from ()

    # the bytes as they are, UTF-8 or not
    stem = F.coalesce("file_stem", F.lit("__HIVE_DEFAULT_PARTITION__")).alias("stem")
    rows = pages.select(stem, F.col("html").cast("binary").alias("html")).sortWithinPartitions("stem")
    rows.mapInArrow(write, "none int").write.format("noop").mode("overwrite").save()
