"""Every registered query runs on the smallest data; those with SQL equal DuckDB's result."""

import glob
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from barloom.plans import registry
from tests.conftest import SF


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def ordered(df):
    df = df[sorted(df.columns)]
    return df.sort_values(sorted(df.columns, key=lambda c: df[c].dtype.kind in "fc"), ignore_index=True)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_equals_sql(spark, db, name):
    got, want = ordered(registry.QUERIES[name](spark, SF).toPandas()), ordered(db.sql(registry.ORACLES[name]).df())
    assert list(got.columns) == list(want.columns) and len(got) == len(want) > 0
    for c in got.columns:
        if pd.api.types.is_numeric_dtype(want[c]) or got[c].dtype.kind in "fi":
            assert np.allclose(pd.to_numeric(got[c]).to_numpy(float, na_value=np.nan), pd.to_numeric(want[c]).to_numpy(float, na_value=np.nan), atol=1e-9, rtol=0, equal_nan=True), c
        else:
            assert (got[c].fillna("") == want[c].fillna("")).all(), c


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, name):
    df = registry.QUERIES[name](spark, SF)
    assert df.count() > 0 and not any(t == "void" for _, t in df.dtypes)


def test_the_core_is_there_if_texts_cannot_be_imported(monkeypatch):
    import importlib

    import __spark_entry__ as e

    real = importlib.import_module
    monkeypatch.setattr(e.importlib, "import_module", lambda name: (_ for _ in ()).throw(ImportError("ahocorasick")) if name == "barloom.llm.queries" else real(name))
    assert set(e.queries()) == set(registry.QUERIES) and set(e.oracle_sql()) == set(registry.ORACLES)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
