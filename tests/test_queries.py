"""Every registered query against its comparison SQL."""

from __future__ import annotations

import pytest
from conftest import SMALL, spark_table, table_of

import __spark_entry__ as entry_point
from ledgerloom.plans import load_all
from ledgerloom.plans.registry import QUERIES, SQL
from ledgerloom.session import job_scratch

load_all()

#: Queries whose operators choose another way for large inputs.
SPLIT = [
    n
    for n in QUERIES
    if n.startswith(("join_", "win_", "dml_", "cmp_", "agg_array", "recon"))
    or n in {
        "src_multi_segment_file", "app_points_by_period", "app_feature_timeseries", "app_merge_survivor_history",
        "app_cumulative_flow", "app_statement_sequence", "app_changelog_initial", "app_eod_balance_snapshot", "udf_lookup",
    }
]


def expected(duck, name):
    cursor = duck.execute(SQL[name])
    return table_of([c[0] for c in cursor.description], cursor.fetchall())


def test_every_query_has_comparison_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert spark_table(QUERIES[name](spark, SMALL)) == expected(duck, name)


@pytest.mark.parametrize("name", sorted(SPLIT))
def test_query_on_large_input(spark, duck, large, name):
    assert spark_table(QUERIES[name](spark, SMALL)) == expected(duck, name)


#: Queries that write steps to the folder which driver and executors share.
SHARED = [
    "app_cri_evaluation",
    "app_eod_balance_snapshot",
    "app_cumulative_flow",
    "app_merge_survivor_history",
    "app_points_by_period",
    "app_statement_sequence",
    "cmp_column_expressions",
    "cmp_compare_columns",
    "cmp_counts",
    "cmp_row_diff",
    "cmp_snapshot_delta",
    "dml_backup_copy",
    "dml_delete_filter",
    "dml_current_history_roll",
    "dml_merge_additive",
    "dml_partition_int_range",
    "dml_merge_upsert",
    "dml_merge_conditional",
    "dml_rebuild_partitioned",
    "dml_recluster",
    "join_recursive_chain",
    "join_fallback_cascade",
]


@pytest.mark.parametrize("name", SHARED)
def test_query_in_a_cluster_whose_shared_folder_is_a_file_path(spark, duck, large, monkeypatch, name):
    """Such a folder, which can be a mount, is tried and then used."""
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    with job_scratch(spark):
        assert spark_table(QUERIES[name](spark, SMALL)) == expected(duck, name)


@pytest.mark.parametrize("missing", ["ledgerloom.llm", "ledgerloom.llm.queries", "corpus_pipeline", "numpy"])
def test_table_queries_do_without_the_optional_parts(monkeypatch, missing):
    """With a part or one of its packages absent, the other queries stay."""
    load = entry_point.import_module

    def found(name):
        if name == missing or missing == "ledgerloom.llm" or (missing == "numpy" and name == "ledgerloom.llm.queries"):
            raise ModuleNotFoundError(f"No module named {missing!r}", name=missing)
        return load(name)

    monkeypatch.setattr(entry_point, "import_module", found)
    if missing == "numpy":
        with pytest.warns(UserWarning, match="left out"):
            names = set(entry_point.queries())
    names = set(entry_point.queries())
    assert set(QUERIES) <= names and set(SQL) <= set(entry_point.oracle_sql())
    if missing == "corpus_pipeline":
        assert "pipeline" not in names


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["wallet_id", "tier", "month", "points"]
    assert df.count() > 0
