from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from demandloom.plans.reports import QUERIES

SF = "/root/testdata/sf0.001"
CHECKED = (
    "retail_mix", "forecast_features", "residual_calibration", "hierarchical_wrmsse", "wape_by_granularity",
    "future_blind_audit", "weekly_prices", "recommendations", "attribution_summary", "unbiased_scale_grid",
)


# Results of fitted models, whose digits follow the learner's arithmetic; tests/test_boosting.py holds them to plain forms.
FITTED = {
    "learned_fold_forecasts", "learned_fold_errors", "boosting_losses", "tree_attribution", "tree_attribution_summary",
    "halving_rungs", "grid_search_errors", "hurdle_points", "objective_errors", "blend_on_evaluation", "learned_final_rows",
    "glm_attribution_rows",
}


def test_every_query_has_sql():
    assert set(QUERIES) - FITTED <= set(entry.oracle_sql()) and not FITTED & set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["model_name", "granularity", "mae", "rmse", "wape", "bias"] and frame.count() == 14


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for table in ("lineitem", "part", "supplier", "nation", "region"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, database, name):
    from scripts.check_oracles import canonical

    got = canonical(entry.queries()[name](spark, SF).toPandas())
    want = canonical(database.execute(entry.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns)
    assert got.equals(want)
