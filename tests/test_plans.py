"""Plan-shape checks: no cartesian products, pruned scans, narrow scoring."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from canopy.plans.checks import CHECKS
from canopy.plans.large import LARGE
from canopy.plans.queries import QUERIES
from conftest import SF_SMALL

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan_of(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES | CHECKS | LARGE))
def test_no_cartesian_products(spark, name):
    plan = plan_of(E.queries()[name](spark, SF_SMALL))
    assert not any(b in plan for b in BAD), plan


def test_scoring_is_one_codegen_stage_with_pruned_scan(spark):
    plan = plan_of(E.queries()["score_forest_r"](spark, SF_SMALL))
    assert "Exchange" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    read = [line for line in plan.splitlines() if "ReadSchema" in line][0]
    # only the keys and the four feature sources are read; the unused label is pruned
    for col in ("l_shipdate", "l_linestatus", "l_returnflag"):
        assert col not in read
    assert "l_extendedprice" in read and "l_quantity" in read


def test_split_scan_aggregates_map_side(spark):
    from canopy.operators.binning import add_bins
    from canopy.operators.splitscan import collapsed
    from canopy.plans.inputs import FEATURES, lineitem_binary
    bins = ["b0", "b1", "b2"]
    rows = add_bins(lineitem_binary(spark, SF_SMALL), FEATURES, [[10.5], [0.05], [0.04]], bins, ["label"])
    plan = plan_of(collapsed(rows, bins, "classification", {"all": None}), "simple")
    # partial aggregate below the exchange: only per-partition sums are shuffled
    assert plan.index("partial_sum") > plan.index("Exchange")


@pytest.mark.parametrize("name", ["pooled_error", "score_forest_r", "error_rate", "subspace_report"])
def test_reports_read_their_table_once(spark, name):
    """However many trees report, the table is scanned once."""
    plan = plan_of(E.queries()[name](spark, SF_SMALL), "simple")
    assert plan.count("FileScan") == 1


def test_metrics_one_pass(spark):
    plan = plan_of(E.queries()["regression_metrics"](spark, SF_SMALL), "simple")
    assert "BroadcastNestedLoopJoin" not in plan and "SortMergeJoin" not in plan
