"""Every registered query against its SQL, or for rows where SQL cannot state it."""

import __spark_entry__ as contract
import oracle
import pytest
from conftest import TESTDATA

QUERIES, SQL = dict(contract.REGISTRY), contract.oracles.sql()
SF = f"{TESTDATA}/sf0.01"

# Learned from a forest; everything else has SQL.
LEARNED = {
    "irrigation_predictions", "classifier_metrics", "regressor_metrics", "feature_importance",
    "feature_importance_top5", "moisture_predictions", "predictions_preview", "training_summary",
    "moisture_training_summary",
}


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


def test_sql_belongs_to_queries():
    assert set(QUERIES) - set(SQL) == LEARNED and not set(SQL) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    assert oracle.difference(duck, SQL[name], QUERIES[name](spark, SF)) is None


@pytest.mark.parametrize("name", sorted(LEARNED))
def test_learned_queries_give_rows(spark, name):
    result = QUERIES[name](spark, SF)
    assert len(set(result.columns)) == len(result.columns) and result.count() > 0


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() > 0 and "irrigation_required" in result.columns


def test_comparison_sees_differences(spark, duck):
    """The check itself must fail on a wrong value, type, name and row count."""
    query = "SELECT 1 AS a, 2.0e0 AS b"
    same = spark.sql("SELECT 1 AS a, 2.0D AS b")
    assert oracle.difference(duck, query, same) is None
    for wrong in ("SELECT 1 AS a, 2.5D AS b", "SELECT '1' AS a, 2.0D AS b", "SELECT 1 AS c, 2.0D AS b",
                  "SELECT 1 AS a, 2.0D AS b UNION ALL SELECT 1, 2.0D"):
        assert oracle.difference(duck, query, spark.sql(wrong)) is not None
