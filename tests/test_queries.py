import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from cauce.operators import cleaning, enrichment
from cauce.schemas import LANDING
from checks.compare import connect, difference
from checks.fixtures import dimensions, facts
from checks.oracle import oracle
from checks.queries import QUERIES
from helpers import metrics

SQL = contract.oracle_sql()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(oracle())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), SQL[name]) is None


def test_entry(spark):
    enriched = contract.entry(spark)
    assert len(enriched.columns) == 16
    assert enriched.count() > 0


def test_figures_on_record(spark):
    """The figures that FIXTURES.md gives for the planted dirt at sf0.01."""
    sf_dir = "/root/testdata/sf0.01"
    audit = metrics(cleaning.clean_audit(facts(spark, sf_dir)))
    assert audit["initial_rows"] == 11000
    assert audit["duplicate_rows"] == 1018
    assert audit["removed_undated"] == 1592
    assert audit["final_rows"] == 8390
    assert [audit[f"nulls_{c}"] for c in LANDING.fieldNames()] == [0, 1001, 580, 1572, 479, 648, 3000]
    clean = cleaning.clean(facts(spark, sf_dir))
    assert clean.agg(F.sum("cantidad")).first()[0] == 329754
    matches = metrics(enrichment.match_counts(clean, dimensions(spark, sf_dir)))
    assert list(matches.values()) == [8390, 8390, 6643, 6388, 6643, 5337, 6643]
    rated = enrichment.enrich(clean, dimensions(spark, sf_dir)).agg(F.count("hurtos_por_100k"))
    assert rated.first()[0] == 6360
