"""Every registered query against its oracle, on whole tables."""

import pytest
from comparing import FOLDER, differences

from __spark_entry__ import entry, oracle_sql, queries

SMALLEST, MIDDLE = str(FOLDER / "sf0.001"), str(FOLDER / "sf0.01")
ORACLES = oracle_sql()

# What the feed derived from the smallest table is known to hold.
ALERTS = {
    "SQUAWK_HIJACK": 16,
    "SQUAWK_RADIO_FAIL": 16,
    "SQUAWK_EMERGENCY": 15,
    "ALT_OUTLIER": 16,
    "SPEED_OUTLIER": 13,
    "VS_OUTLIER": 11,
    "GEOFENCE_ENTER": 12,
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, name):
    assert differences(queries()[name](spark, MIDDLE), ORACLES[name], MIDDLE) is None


def test_every_query_has_an_oracle():
    from skyledger.plans.queries import all_queries

    assert set(all_queries()) <= set(ORACLES)


def test_known_counts(spark):
    by_type = {r.alert_type: r.alerts for r in queries()["rule_alerts_by_type"](spark, SMALLEST).collect()}
    assert by_type == ALERTS
    balance = queries()["class_balance"](spark, SMALLEST).first()
    assert (balance.n_pos, balance.n_neg) == (79, 737 - 79)
    assert queries()["normalize_objects"](spark, SMALLEST).count() == 952
    assert queries()["area_disc"](spark, SMALLEST).count() == 427


def test_entry(spark):
    assert entry(spark).count() == sum(ALERTS.values())
