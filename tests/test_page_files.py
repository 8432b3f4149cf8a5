import hashlib
from pathlib import Path

from grantsieve.contract import queries as Q


def test_page_files_are_written_by_tasks_without_a_folder_each(spark, tmp_path, monkeypatch):
    """Pages of any key and bytes come back, from one folder per task."""
    rows = [(i, f"<p>caf\u00e9 {i}</p>\n") for i in range(60)] + [(60, None), (None, "x"), (7, "<p>caf\u00e9 7</p>\n")]
    pages = spark.createDataFrame(rows, "page_id bigint, html string").selectExpr("page_id", "'' AS url", "html")
    pages.coalesce(1).write.parquet(f"{tmp_path}/in/pages.parquet")
    monkeypatch.setattr(Q, "shared_folder", lambda spark, purpose: f"{tmp_path}/{purpose}")
    found = sorted(tuple(r) for r in Q.s3_html_folder(spark, f"{tmp_path}/in").collect())

    def sha1(text):
        return hashlib.sha1(text.encode()).hexdigest()

    wanted = [(f"page_{i}", sha1(f"{html}\n" * (2 if i == 7 else 1))) for i, html in rows[:60]]
    wanted += [("page_60", sha1("\n")), ("__HIVE_DEFAULT_PARTITION__", sha1("x\n"))]
    assert found == sorted(wanted)
    assert [p.name for p in Path(tmp_path, "files").iterdir()] == ["part=0"]


def test_bytes_of_pages_are_written_as_they_are(spark, tmp_path):
    from grantsieve.contract.fixtures import write_page_files

    pages = spark.range(1).selectExpr("'a' AS file_stem", "cast(X'41FF42' AS string) AS html")
    write_page_files(pages, f"file://{tmp_path}/out")
    assert [p.read_bytes() for p in Path(tmp_path, "out").glob("part=*/file_stem=a.txt")] == [b"A\xffB\n"]


def test_a_task_reads_many_small_page_files(spark, tmp_path):
    from grantsieve.sources.pages import read_html_folder

    for i in range(4 * spark.sparkContext.defaultParallelism + 8):
        Path(tmp_path, f"p{i}.html").write_text(f"<p>{i}</p>")
    cost = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(cost)
    spark.conf.set(cost, "128m")  # a split for each file
    try:
        pages = read_html_folder(spark, str(tmp_path))
        assert pages.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
        rows = {(r.file_stem, r.html) for r in pages.collect()}
    finally:
        spark.conf.set(cost, before)
    assert rows == {(f"p{i}", f"<p>{i}</p>") for i in range(4 * spark.sparkContext.defaultParallelism + 8)}
