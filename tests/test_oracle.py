"""Every registered query with an oracle equals its independent DuckDB SQL."""

import hashlib

import pandas as pd
import pytest

from opsledger.plans import registry

registry.load_all()


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].astype("datetime64[us]")
        elif pd.api.types.is_numeric_dtype(df[c]) and not pd.api.types.is_bool_dtype(df[c]):
            df[c] = df[c].astype("float64")
    out = df.astype(str).replace({"NaT": "None", "nan": "None", "<NA>": "None"})
    return out.sort_values(list(out.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_matches_oracle(name, spark, duck):
    from conftest import SF

    got = _norm(registry.QUERIES[name](spark, SF).toPandas())
    want = _norm(duck.execute(registry.ORACLE[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want)
    pd.testing.assert_frame_equal(got, want)


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
