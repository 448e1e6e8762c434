"""Every registered query equals its DuckDB oracle at sf0.01 (and sf0.001)."""

import pytest

import __spark_entry__ as entry_mod
from conftest import SF001, SF01
from eventide.plans import registry
from oracle_compare import compare, duck

KEYS = sorted(entry_mod.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = entry_mod.queries()[key](spark, SF01)
    problems, n = compare(df, con, entry_mod.oracle_sql()[key])
    assert not problems, f"{key}: {problems}"


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 6
    assert df.columns == ["user_id", "window_start", "window_end", "event_count", "z_score", "severity",
                          "user_name", "region"]
    problems, _ = compare(df, duck(SF001), entry_mod.oracle_sql()["enriched_anomalies_1min"])
    assert not problems, problems


@pytest.fixture(scope="module")
def con_small():
    return duck(SF001)


@pytest.mark.parametrize("key", [k for k in KEYS if not k.startswith("stream_")])
def test_query_matches_oracle_sf0001(spark, con_small, key):
    df = entry_mod.queries()[key](spark, SF001)
    problems, _ = compare(df, con_small, entry_mod.oracle_sql()[key])
    assert not problems, f"{key}: {problems}"
