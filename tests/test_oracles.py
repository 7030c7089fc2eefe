"""Every query with SQL must equal that SQL; the others must at least give rows."""

import pytest

import __spark_entry__ as contract
from earshot.checks.compare import differences, duck
from earshot.checks.oracles import ORACLES
from earshot.checks.queries import QUERIES

MODELS = {
    "sentiment_logreg", "sentiment_svm", "sentiment_champion",
    "topics_nmf", "topics_lda", "lsa_embedding", "topic_top_terms", "topics_champion", "topics_kmeans",
}


@pytest.fixture(scope="module")
def sf_dir():
    return "/root/testdata/sf0.01"  # the smallest one is too thin for some thresholds


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_only_models_lack_sql():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == MODELS


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []


def test_the_contract_names_them_all():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship_runs(spark):
    result = contract.entry(spark)
    assert result.count() == 1500
    assert "priority_score" in result.columns
