from grantsieve import parse_pages
from grantsieve.contract import fixtures as fx
from grantsieve.contract.queries import QUERIES


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_text_is_built_once(spark, small):
    plan = plan_of(parse_pages(fx.table(spark, small, "pages").selectExpr("url AS file_stem", "html")))
    # one evaluation of the fragment array, of the page markup and of the rule snippets
    assert plan.count("AS _parts#") == plan.count("AS _raw#") == 1 and plan.count("AS _visible#") == 1
    assert plan.count("script|style|template") == 1
    assert plan.count("AS _tag_snippets#") == 1


def test_parsing_is_a_projection_over_two_columns(spark, small):
    plan = plan_of(parse_pages(fx.table(spark, small, "pages").withColumnRenamed("url", "file_stem")))
    assert "Exchange" not in plan and "Python" not in plan and "Window" not in plan
    assert "PushedFilters: [IsNotNull(html)]" in plan
    assert "ReadSchema: struct<url:string,html:string>" in plan


def test_no_query_uses_python_workers_cross_joins_or_global_windows(spark, small):
    for name, query in QUERIES.items():
        if name[:2] in ("k1", "k4", "k5", "l1", "l4") or "round_trip" in name:
            continue  # these write; their reading side is a plain scan
        plan = plan_of(query(spark, small))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "InPandas"):
            assert bad not in plan, (name, bad)


def test_url_filter_reaches_the_scan(spark, small):
    from grantsieve import url_records

    plan = plan_of(url_records(fx.table(spark, small, "pages"), "https://a.org"))
    assert "EqualTo(url,https://a.org)" in plan


def only_ties_are_sorted(df, column):
    """No sort or sort aggregate outside the branch of rows that share their place."""
    plan = plan_of(df).partition("== Initial Plan ==")[0]
    alone, sort, shared = plan.partition("SortAggregate(")
    assert column in alone and " Sort [" not in alone and sort
    assert shared.count("> 1)") >= 1 and f"min({column}#" in shared


def test_page_source_is_not_sorted_but_for_ties(spark, small):
    from grantsieve.operators.resolve import first_pages, resolve_pages

    pages = fx.table(spark, small, "pages").select("page_id", "url", "html")
    only_ties_are_sorted(resolve_pages(QUERIES["d2_first_n"](spark, small), pages), "html")
    only_ties_are_sorted(first_pages(pages), "html")


def test_page_index_aggregates_by_hash(spark, small):
    from grantsieve.operators.resolve import _first_places, _places

    pages = fx.table(spark, small, "pages")
    plan = plan_of(_first_places(_places(pages, ("page_id",)), ("_url",), ["_at_page_id"]))
    assert "HashAggregate" in plan and "Sort" not in plan and "html" not in plan


def test_bodies_of_attempts_are_not_sorted_to_settle_ties(spark, small):
    from grantsieve.operators.resolve import resolve_attempts

    plan = plan_of(resolve_attempts(fx.attempts(spark, small)))
    sorted_bodies = [x for x in plan.splitlines() if "SortAggregate" in x and "min(body#" in x]
    assert len(sorted_bodies) in (1, 2)  # partial and final, of the branch of ties alone
    assert plan.count("min(body#") == len(sorted_bodies) and "> 1)" in plan


def test_first_n_has_no_merging_task(spark, small):
    plan = plan_of(QUERIES["d2_first_n"](spark, small))
    for bad in ("TakeOrderedAndProject", "SinglePartition", "Exchange", "GlobalLimit"):
        assert bad not in plan


def test_a_page_is_composed_once_behind_the_parts_dealt_out(spark, small):
    for name in ("h2_solicitation_text", "r2_flat_records", "t2_tag_text", "e9_award"):
        plan = plan_of(QUERIES[name](spark, small))
        before, dealt, behind = plan.partition("REPARTITION_BY_NUM")
        assert dealt and before.count("<!DOCTYPE html>") == 1, name
        assert "<!DOCTYPE html>" not in behind and "Full Proposal Deadline" not in behind, name
        assert "isnotnull(html#" in before, name


def test_a_page_is_not_composed_where_its_source_is_not_used(spark, small):
    for name in ("d4_page_order", "s5_file_stem"):
        assert "<!DOCTYPE html>" not in plan_of(QUERIES[name](spark, small)), name


def test_parts_follow_the_orders(spark, small, tmp_path):
    """Ten times the pages are ten times the parts: no task grows with the table."""
    import re

    orders = fx.table(spark, small, "orders").limit(1).drop("o_orderkey")
    customers, nations = fx.table(spark, small, "customer"), fx.table(spark, small, "nation")
    parts = []
    for n in (500_000, 5_000_000):
        sf_dir = f"{tmp_path}/{n}"
        spark.range(n).withColumnRenamed("id", "o_orderkey").join(orders.hint("broadcast")).write.parquet(f"{sf_dir}/orders.parquet")
        customers.write.parquet(f"{sf_dir}/customer.parquet")
        nations.write.parquet(f"{sf_dir}/nation.parquet")
        plan = plan_of(QUERIES["x4_date_as_written"](spark, sf_dir))
        parts.append(int(re.search(r"(\d+)\), REPARTITION_BY_NUM", plan)[1]))
    cores = 4 * spark.sparkContext.defaultParallelism
    assert parts == [max(cores, 20), max(cores, 200)] and parts[1] > cores
