"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

from sparkdesk.plans import registry
from tests.conftest import SF001

registry.load_all()


@pytest.fixture(scope="module")
def duck():
    import importlib.util
    import os

    spec = importlib.util.spec_from_file_location(
        "oracle_check", os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools", "oracle_check.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


@pytest.mark.parametrize("key", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, duck, key):
    res = duck.compare(spark, duck.duck(SF001), key, SF001)
    if key in registry.ORACLES:
        assert res.get("match"), res
    else:
        assert res["rows"] >= 0


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() >= 0
    assert set(e.oracle_sql()) <= set(e.queries())
