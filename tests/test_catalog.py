"""Every registered query against its SQL oracle, and the driver contract."""

import pytest
from compare import connect, differences

import __spark_entry__ as contract
from ordermill.plans import catalog, oracle

ORACLES = oracle.statements()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, small, con, name):
    assert differences(contract.queries()[name](spark, small), con, ORACLES[name]) == []


def test_every_oracle_has_a_query_and_only_hash_placement_lacks_one():
    assert set(ORACLES) <= set(catalog.QUERIES)
    assert set(catalog.QUERIES) - set(ORACLES) == {"partition_profile"}


def test_partition_profile_covers_all_rows(spark, small):
    counts = contract.queries()["partition_profile"](spark, small).collect()
    assert sum(r["rows"] for r in counts) == spark.read.parquet(f"{small}/orders.parquet").count()
    assert 1 <= len(counts) <= 3  # three statuses fill at most three partitions


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_audits_find_something(spark, small):
    """The derived defects make the rules fire, so agreement with the oracle means something."""
    for name in ("negative_value_check", "date_order_check", "range_check", "recompute_seller_metrics", "row_count_check"):
        findings = contract.queries()[name](spark, small)
        assert findings.filter("failures > 0").count() > 0, name


def test_every_check_of_the_suite_can_fail(spark, small):
    found = contract.queries()["gold_validation_suite_defects"](spark, small).collect()
    assert len(found) == 59 and [r for r in found if r["failures"] == 0] == []
    assert contract.queries()["invalid_metric_check"](spark, small).filter("failures = 0").count() == 0


def test_suite_has_59_checks(spark, small):
    assert contract.queries()["gold_validation_suite"](spark, small).count() == 59
