"""What the physical plans must and must not contain."""

import re
from dataclasses import replace

import pytest

from tallylake.operators import constraints, flat, profile, reload, star, validity
from tallylake.plans import marts
from tallylake.schema import BUSINESS_KEY, Tables
from tallylake.sources import bucketed
from testbed import fixtures
from testbed.queries import QUERIES

WRITES = {
    "scan_interactions",
    "parquet_roundtrip",
    "csv_roundtrip",
    "report_scan",
    "star_roundtrip",
    "dashboard_sample",
    "quality_history",
    "check_all_by_load",
    "merge_touched_buckets",
    "dedup_by_load",
    "quality_report_by_load",
    "flat_view_bucketed",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake(spark, sf_dir, tmp_path_factory):
    """The sources as plain Parquet tables."""
    folder = tmp_path_factory.mktemp("lake")
    paths = {}
    for name, df in fixtures.load(spark, sf_dir).by_name().items():
        paths[name] = str(folder / name)
        df.write.parquet(paths[name])
    return Tables(*[spark.read.parquet(p) for p in paths.values()])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for node in ("Python", "InPandas", "CartesianProduct", "NestedLoop", "Window"):
        assert node not in plan


def test_profile_scans_and_shuffles_once(spark, lake):
    plan = plan_of(profile.measure(lake.movements, BUSINESS_KEY).counts)
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan


def test_null_counts_need_no_key_shuffle(spark, lake):
    plan = plan_of(profile.null_counts(lake.movements).counts)
    assert plan.count("FileScan") == 1
    assert "Exchange hashpartitioning" not in plan


def test_validity_filter_reaches_the_files(spark, lake):
    plan = plan_of(validity.valid_rows(lake.movements).select("id_cartao"))
    assert "GreaterThan(vlr_transacao,0.00)" in plan
    assert re.search(r"ReadSchema: struct<vlr_transacao:decimal\(15,2\),id_cartao:bigint>", plan)


def test_transactions_move_once_in_the_flat_view(spark, lake, confs):
    confs(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(flat.build(lake))
    assert plan.count("Exchange hashpartitioning(id_cartao") == 1
    scans = [line for line in plan.splitlines() if "FileScan" in line and "des_transacao" in line]
    assert len(scans) == 1
    # the transactions' join is the last one: nothing is joined above it
    assert plan.index("SortMergeJoin [id_cartao") < plan.index("SortMergeJoin [card_account")


def test_flat_reads_only_the_columns_it_shows(spark, lake):
    plan = plan_of(flat.build(lake))
    assert "email" not in plan
    assert "canal" not in plan


def test_dimensions_are_not_forced_to_broadcast(spark, lake, confs):
    confs(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(flat.build(lake))
    forced = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert all("heavy_key" in line for line in forced)
    assert "Broadcast" not in plan_of(star.build(lake)["fato_movimentacao"])


def test_totals_are_combined_before_the_join(spark, lake, confs):
    confs(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(marts.card_totals(lake))
    # printed from the last step down: the join, below it the sums
    assert plan.index("SortMergeJoin [id_cartao") < plan.index("partial_sum(vlr_transacao")
    # the interaction log has no part in the totals and is not read
    assert "associado_id" not in plan_of(marts.brand_mart(lake))


def test_sample_keeps_the_best_rows_per_task(spark, lake):
    plan = plan_of(marts.sample_rows(flat.build(lake)))
    assert "TakeOrderedAndProject(limit=8" in plan


def test_dedup_with_integer_ids_hashes(spark, lake):
    numbered = lake.movements.selectExpr(
        "cast(hash(id) as int) as id",
        "vlr_transacao",
        "des_transacao",
        "data_movimentacao",
        "id_cartao",
    )
    plan = plan_of(reload.first_per_key(numbered, BUSINESS_KEY))
    assert "SortAggregate" not in plan
    assert plan.count("Exchange") == 1


def test_all_rules_read_each_table_once(spark, lake, confs):
    confs(spark__sql__autoBroadcastJoinThreshold="-1")
    log = lake.interactions.selectExpr("*", "'x' as tipo_interacao", "'x' as mensagem")
    plan = plan_of(constraints.summary(replace(lake, interactions=log)))
    assert plan.count("FileScan") == 5
    assert "Join" not in plan and "Sort" not in plan
    # keys, the figures of each key space, and the one row they end in
    assert plan.count("Exchange") == 3


@pytest.mark.parametrize("name", ["kpi_summary", "kpi_summary_from_flat"])
def test_distinct_counts_without_expand(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "Expand" not in plan and "bitmap_construct_agg" in plan
    # no column of the stored rows is read by both scans, but for the totals per card
    scans = re.findall(r"ReadSchema: struct<(.*?)>", plan)
    assert len(scans) == 2 and not set(scans[0].split(",")) & set(scans[1].split(","))


def test_bucketed_transactions_are_joined_where_they_lie(spark, lake, tmp_path, confs):
    confs(spark__sql__autoBroadcastJoinThreshold="-1")
    path = str(tmp_path / "movements")
    bucketed.write(lake.movements, path, "id_cartao", 8)
    plan = plan_of(flat.build_bucketed(bucketed.read(spark, path), lake))
    assert "hashpartitioning(id_cartao" not in plan and "Bucketed: true" in plan
    light = [line for line in plan.splitlines() if "Bucketed: true" in line]
    assert len(light) == 1 and "SelectedBucketsCount: 8 out of 8" in light[0]
