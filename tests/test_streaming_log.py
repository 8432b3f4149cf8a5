"""The outcome log of a stream of jobs holds each outcome once, whatever fails."""

import pytest

from grantsieve.streaming.log import log_stream

JOBS = "ord bigint, url string, title string, program_id string, nsf_pd_num string"


def test_batches_that_run_again_replace_themselves(spark, tmp_path):
    pages = spark.createDataFrame(
        [(i, f"https://a.org/{i}", f"<p>{i}</p>") for i in range(0, 30, 2)], "page_id bigint, url string, html string"
    )
    for n in range(3):
        rows = [(i, f"https://a.org/{i}", f"T{i}", None, None) for i in range(10 * n, 10 * n + 10)]
        spark.createDataFrame(rows, JOBS).coalesce(1).write.mode("append").parquet(str(tmp_path / "jobs"))
    jobs = spark.readStream.schema(JOBS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "jobs"))
    written = []

    def fail_once(number):
        written.append(number)
        if written.count(1) == 1 and number == 1:
            raise RuntimeError("lost between writing and noting")

    with pytest.raises(Exception, match="lost between"):
        log_stream(jobs, pages, str(tmp_path / "log"), "landed", on_written=fail_once).awaitTermination()
    log_stream(jobs, pages, str(tmp_path / "log"), "landed", on_written=fail_once).awaitTermination()
    assert written == [0, 1, 1, 2]
    log = spark.read.json(str(tmp_path / "log")).collect()
    assert sorted((r["ord"], r["url"], r["ok"]) for r in log) == [(i, f"https://a.org/{i}", i % 2 == 0) for i in range(30)]
    assert all(r["saved_path"].startswith("landed/") for r in log if r["ok"])
    log_stream(jobs, pages, str(tmp_path / "log"), "landed", on_written=fail_once).awaitTermination()
    assert written == [0, 1, 1, 2]
