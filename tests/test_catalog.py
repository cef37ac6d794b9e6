"""Catalog queries against their SQL on the smallest tables, and contract checks."""

import pytest

from loanframe.plans import catalog, oracle
from tests.compare import compare, connect
from tests.conftest import SMALL

CHECKED = [
    "scan_profile", "issue_month_counts", "label_summary", "credit_limits", "scene_labels", "maturity_impact", "temporal_split_rows",
    "bootstrap_split", "time_fold_rows", "purified_rows", "strata_quota", "stratified_sample", "purified_splits", "imputed_rows",
    "one_hot", "target_encoding", "scaled_rows", "correlation_drop", "oversample_targets", "threshold_curve", "best_threshold",
    "loss_threshold_scan", "rule_override", "limit_caps", "class_report", "ovr_auc", "ovo_auc", "bad_capture", "residual_histogram",
    "score_records", "scenario_text", "review_responses",
]


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, name):
    assert compare(catalog.queries()[name](spark, SMALL), con, oracle.oracle_sql()[name]) is None


def test_every_oracle_has_a_query():
    assert set(oracle.oracle_sql()) <= set(catalog.queries())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 12
