"""Registered queries against their SQL on the smallest tables.

The fits at their published settings take minutes each and are compared by
`tests/compare.py`; `test_evaluation.py` runs the same code with small settings.
"""

import pytest

import __spark_entry__ as driver
from tests.compare import compare, duck

LONG_FITS = {
    "cv_random_forest",
    "cv_gbt",
    "cv_rbf_svm",
    "cv_mlp",
    "gbt_importance",
    "results_written",
    "planted_auc",
    "planted_forest",
    "planted_boosted",
    "planted_network",
}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(set(driver.oracle_sql()) - LONG_FITS))
def test_query_equals_sql(spark, connection, sf_dir, name):
    difference = compare(
        spark, connection, driver.queries()[name], driver.oracle_sql()[name], sf_dir
    )
    assert difference is None


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_gives_rows(spark):
    frame = driver.entry(spark)
    assert frame.columns[-3:] == ["ucla_total_score", "loneliness_label", "loneliness_label_binary"]
    assert frame.count() > 0
