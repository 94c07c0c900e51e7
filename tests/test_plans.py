"""Shapes of physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from sluice.operators import filters
from sluice.plans import roles
from sluice.plans.catalog import ORACLES, QUERIES
from sluice.sources import records


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["status_filter"](spark, sf_dir))
    assert "PushedFilters: [In(o_orderstatus, [O,P])]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text


def test_size_filter_runs_before_partitioning(spark, sf_dir):
    text = plan(QUERIES["flagship_ingest"](spark, sf_dir))
    explode = text.index("Generate posexplode(filter(")
    assert "Filter" in text[explode:]


@pytest.mark.parametrize("name", ["cap_per_group", "channel_to_text", "wiki_pages_to_html"])
def test_rank_limits_run_before_the_shuffle(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    limits = [m.start() for m in re.finditer("WindowGroupLimit", text)]
    assert len(limits) >= 2 and text.index("Exchange", limits[0]) < limits[-1]


@pytest.mark.parametrize(
    "name",
    ["stage_sql", "stage_elasticsearch", "assign_hash_ids", "acl_drive", "messages_daily_packages",
     "graph_structure_edges", "incremental_changed", "extract_links", "tickets_to_text"],
)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for word in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoop",
                 "MapInArrow", "FlatMapGroups"):
        assert word not in text


def test_hot_groups_are_aggregated_before_the_shuffle(spark, sf_dir):
    text = plan(QUERIES["messages_daily_packages"](spark, sf_dir))
    assert "partial_max" in text
    text = plan(QUERIES["first_seen_wins"](spark, sf_dir))
    assert "partial_min_by" in text


def test_packing_ships_narrow_columns_only(spark, sf_dir):
    from sluice.operators.chunk import assign_chunks

    text = plan(assign_chunks(roles.parts(spark, sf_dir), "basic", 500, bounded=True))
    call = re.search(r"ArrowEvalPython \[run\(([^)]*)\)", text).group(1)
    assert "text#" not in call and "metadata#" not in call
    # One shuffle for the scan spread and one for all windows of the record.
    assert text.count("Exchange hashpartitioning") == 1


def test_sequence_windows_use_blocks(spark, sf_dir):
    from sluice.operators.sequence import seq_on_page

    rows = roles.parts(spark, sf_dir).select(
        "record_id", "pos", F.col("metadata.page_number").alias("page")
    )
    text = plan(seq_on_page(rows, "page"))
    assert re.search(r"hashpartitioning\(record_id#\d+, _block#\d+L", text)


def test_positions_need_no_single_task_over_rows(spark, sf_dir):
    from sluice.operators.batching import global_position

    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    text = plan(global_position(rows, ["l_orderkey", "l_linenumber"]))
    # The only single-task exchange carries one row per partition.
    single = [m.start() for m in re.finditer("Exchange SinglePartition", text)]
    assert len(single) == 1 and "HashAggregate" in text[single[0] : single[0] + 400]


def test_every_query_is_listed_once():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) > 170


def test_ids_and_dates_reach_the_scan(spark, sf_dir):
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    batches = records.index_batches(customers, "customer", "c_custkey", 10).filter("batch_no = 2")
    text = plan(records.fetch_records(customers, batches, "c_custkey"))
    assert "GreaterThanOrEqual(c_custkey,20)" in text and "LessThanOrEqual(c_custkey,29)" in text
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = plan(filters.between_dates(events, "ts", 1704500000, 1705500000))
    assert "GreaterThanOrEqual(ts," in text and "LessThanOrEqual(ts," in text


def test_chunks_before_are_found_by_their_last_characters(spark, sf_dir):
    text = plan(QUERIES["chunk_overlap_all"](spark, sf_dir))
    assert "lag(_ending" in text and "lag(text" not in text


def test_large_documents_are_not_the_null_side_of_an_outer_join(spark):
    """Spark splits a large key of an inner join, but not on the side that may be null."""
    from sluice.sources.parts import assembled

    texts = spark.createDataFrame([(1, 0, "a"), (1, 1, "b")], "k int, part long, text string")
    heads = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, head string")
    found = assembled(texts, ["k"], heads, opening=F.col("head"))
    assert "LeftOuter" not in plan(found)
    rows = sorted((r["k"] or 0, r["part"], r["body"]) for r in found.collect())
    assert rows == [(0, 0, "z"), (1, 0, "xa"), (1, 1, "b"), (2, 0, "y")]
