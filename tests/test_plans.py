"""Plans: filters and columns reach the scan, the hot path stays out of Python."""

import contextlib
import io

import pytest

from yardline.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["filtered_scan"](spark, FOLDER))
    assert "GreaterThanOrEqual(o_totalprice" in text and "EqualTo(o_orderstatus,F)" in text
    schema = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "o_orderdate" not in schema and "o_orderpriority" not in schema


def test_game_stats_is_one_scan_and_a_hash_aggregate(spark):
    text = plan(QUERIES["game_stats"](spark, FOLDER))
    assert text.count("PushedFilters") <= 1 and text.count("Location: ") == 1 and "SortAggregate" not in text and "HashAggregate" in text
    assert "l_extendedprice" not in text.split("ReadSchema: ")[1].split("\n")[0]


@pytest.mark.parametrize("name", ["rushing", "receiving", "drive_stats", "ewm_mean", "rolling_slope", "avg_rank",
                                  "quantiles", "travel_distance", "home_away_unpivot"])
def test_no_python_in_the_plan(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "EvalPython" not in text and "InPandas" not in text


@pytest.mark.parametrize("name", ["ewm_mean", "rolling_mean_full"])
def test_features_share_one_shuffle(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert text.count("Arguments: hashpartitioning") == 1
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
