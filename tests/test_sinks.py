import json

from pyspark.sql import functions as F

from grantsieve import flatten_records, parse_batch, parse_pages
from grantsieve.contract import fixtures as fx
from grantsieve.operators.records import RECORD_FIELDS
from grantsieve.sinks.writers import land_pages, write_flat_csv, write_json, write_json_per_record
from grantsieve.streaming.pages import parse_stream, stream_pages


def odd_records(spark):
    pages = [
        ("b", '<title>He said "x", \\ and &#10; more</title>'),
        ("a b", "<title>café 中</title>"),
        ("a", "<title> </title><body>ai</body>"),
    ]
    return parse_pages(spark.createDataFrame(pages, "file_stem string, html string"))


def part_lines(folder):
    return [
        line for part in sorted(folder.glob("part-*"))
        for line in part.read_text(encoding="utf-8").splitlines()
    ]


def test_json_keeps_nulls_characters_and_order(spark, tmp_path):
    write_json(odd_records(spark), str(tmp_path / "j"))
    rows = [json.loads(line) for line in part_lines(tmp_path / "j")]
    # "a b.html" sorts before "a.html"
    assert [r["title"] for r in rows] == ["café 中", "a", 'He said "x", \\ and more']
    assert all(list(r) == list(RECORD_FIELDS) and r["open_date"] is None for r in rows)
    assert list(rows[0]["semantic_tags"].values()) == [[], [], [], []]


def test_csv_round_trip(spark, tmp_path):
    records = odd_records(spark).withColumn("eligibility_text", F.lit(' lead "q" \n, trail '))
    write_flat_csv(records, str(tmp_path / "c"))
    text = "\n".join(part_lines(tmp_path / "c"))
    assert '""x""' in text and "\\\"" not in text
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(
        str(tmp_path / "c")
    ).na.fill("")
    want = flatten_records(records)
    assert back.columns == want.columns
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, want.collect()))


def test_json_per_record(spark, tmp_path):
    write_json_per_record(odd_records(spark), str(tmp_path / "p"))
    assert {f.name for f in (tmp_path / "p").iterdir() if f.is_dir()} == {
        "file_stem=a", "file_stem=a b", "file_stem=b",
    }


def test_batch_writes_every_export_once(spark, small, tmp_path):
    pages = fx.solicitations(spark, small).drop("k")
    done = parse_batch(pages, str(tmp_path / "out"))
    assert done.records == pages.count()
    stems = [json.loads(x)["title"] for x in part_lines(tmp_path / "out" / "records_json")]
    assert len(stems) == done.records
    csv = spark.read.option("header", True).option("escape", '"').csv(done.csv).na.fill("")
    stored = flatten_records(spark.read.parquet(done.table))
    assert sorted(map(tuple, csv.collect())) == sorted(map(tuple, stored.collect()))


def test_both_exports_take_the_same_sorted_parts(spark, small, tmp_path, monkeypatch):
    from grantsieve.plans import pipelines

    plans = []
    for name in ("write_json", "write_flat_csv"):
        real = getattr(pipelines, name)

        def spied(records, *args, real=real, **kw):
            plans.append(records._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0])
            return real(records, *args, **kw)

        monkeypatch.setattr(pipelines, name, spied)
    pages = fx.keyed_pages(spark, small).repartition(5)
    done = parse_batch(pages, str(tmp_path / "out"))
    assert len(plans) == 2 and not any("Exchange" in p or "Sort" in p for p in plans)
    titles = [json.loads(x)["title"] for x in part_lines(tmp_path / "out" / "records_json")]
    want = spark.read.parquet(done.table).orderBy(F.concat("file_stem", F.lit(".html"))).select("title").collect()
    assert titles == [r["title"] for r in want]
    read = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(done.csv)
    assert sorted(r["title"] or "" for r in read.collect()) == sorted(t or "" for t in titles)


def test_stream_equals_batch_and_resumes(spark, small, tmp_path):
    pages = fx.keyed_pages(spark, small).select("file_stem", "url", "html")
    landed, out, mark = (str(tmp_path / n) for n in ("landed", "out", "mark"))
    land_pages(pages, landed)
    for _ in range(2):  # the second run finds nothing new
        q = parse_stream(stream_pages(spark, landed, max_files_per_trigger=2), out, mark)
        q.awaitTermination()
    want = parse_pages(pages)
    got = spark.read.parquet(out)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_stream_runs_continue_without_a_named_checkpoint(spark, tmp_path):
    landed, out = str(tmp_path / "landed"), str(tmp_path / "records")
    for i in range(3):
        page = spark.createDataFrame([(f"p{i}", "u", "<p>x</p>")], "file_stem string, url string, html string")
        land_pages(page, landed, batch=str(i))
        stream = spark.readStream.schema("file_stem string, url string, html string").parquet(f"{landed}/batch=*")
        parse_stream(stream, out).awaitTermination()
    assert sorted(r.file_stem for r in spark.read.parquet(out).collect()) == ["p0", "p1", "p2"]
    land_pages(page, landed, batch="2")
    assert spark.read.parquet(landed).count() == 3
