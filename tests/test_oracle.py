"""Every registered query against its DuckDB oracle (sf0.001), rows-only otherwise."""

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

from lapengine.plans import registry

# minutes of fitting; their settings and parts are tested in test_ml
HEAVY = {f"{n}{x}" for n in ("f10_random_forest", "f11_gradient_boosting", "f13_boosted_xgb", "f14_boosted_lgbm") for x in ("", "_folds")} \
    | {"f10_f14_model_zoo", "f22_permutation_importance"}

registry.load_all()
_Q = registry.QUERIES
_S = registry.ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(n for n in _Q if n in _S and n not in HEAVY))
def test_matches_oracle(spark, con, name):
    r = compare(spark, con, SF_SMALL, name, _Q[name], _S[name])
    assert r["cols_ok"], r
    assert r["rows"] == r["oracle_rows"], r
    assert r["exact"] or r["close"], r


@pytest.mark.parametrize("name", sorted(n for n in _Q if n not in _S and n not in HEAVY))
def test_without_oracle_has_rows_and_no_empty_column(spark, name):
    df = _Q[name](spark, SF_SMALL)
    rows = df.collect()
    assert rows and len(set(rows)) == len(rows) if not any("array" in t for _, t in df.dtypes) else rows
    for c in df.columns:
        assert any(r[c] is not None for r in rows), c


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert "Energy_Index" in df.columns
