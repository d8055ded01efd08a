"""The driver contract, and every SQL-checkable query against its DuckDB
twin on the smallest scale factor."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "scripts"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import TABLES, _type_ok, canon, rows_key  # noqa: E402

from cardspark.plans.features import LeakageError, check_leakage, clean_name  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["category", "mcc_id", "total_spend", "n_txn"]


def test_oracle_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_leakage_gate_and_names():
    check_leakage(["amount", "card_brand_Visa"])
    with pytest.raises(LeakageError):
        check_leakage(["amount", "is_error"])
    assert clean_name("age_group_<25") == "age_group_lt25"
    assert clean_name("a[1]") == "a(1)"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF)
    srows = [tuple(canon(x) for x in r) for r in sdf.collect()]
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    otypes = [str(d[1]) for d in res.description]
    assert sorted(sdf.columns) == sorted(ocols)
    order = [ocols.index(c) for c in sdf.columns]
    for f, i in zip(sdf.schema.fields, order):
        assert _type_ok(f.dataType.simpleString(), otypes[i]), (f.name, otypes[i])
    orows = [tuple(canon(r[i]) for i in order) for r in res.fetchall()]
    assert len(srows) == len(orows)
    assert rows_key(srows) == rows_key(orows)


@pytest.mark.parametrize("name", ["dim_geography", "dim_customer", "impute_numeric", "one_hot",
                                  "average_precision", "recall_at_k", "scd2_card"])
def test_large_input_paths_match_the_same_oracle(spark, con, name, monkeypatch):
    """The distributed numbering and running totals, forced on small data."""
    from cardspark.operators import keys, prefix
    from cardspark.plans import metrics, warehouse
    monkeypatch.setattr(keys, "SMALL_ROWS", 0)
    monkeypatch.setattr(prefix, "SMALL_ROWS", 0)
    monkeypatch.setattr(warehouse.Warehouse, "_cache", {})
    monkeypatch.setattr(metrics, "_CURVES", {})
    test_query_matches_oracle(spark, con, name)


@pytest.fixture(scope="module")
def wide_keys(spark, tmp_path_factory):
    """The smallest tables with every key moved beyond 2 ** 31."""
    from pyspark.sql import functions as F
    far = 3_000_000_000
    root = str(tmp_path_factory.mktemp("wide"))
    keys = {"customer": ["c_custkey"], "orders": ["o_orderkey", "o_custkey"], "part": ["p_partkey"],
            "lineitem": ["l_orderkey", "l_partkey", "l_suppkey"]}
    for t, cols in keys.items():
        d = spark.read.parquet(f"{SF}/{t}.parquet")
        d.withColumns({c: F.col(c).cast("long") + far for c in cols}).write.parquet(f"{root}/{t}.parquet")
    c = duckdb.connect()
    for t in keys:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet/*.parquet')")
    return root, c


@pytest.mark.parametrize("name", ["txn_with_mcc", "top_spenders_month", "top_spenders_month_fanout",
                                  "fanout_proof", "spend_direct_vs_indirect", "fact_transaction",
                                  "fact_asof_scd2", "velocity_windows", "utilization_30d"])
def test_keys_beyond_an_int(spark, wide_keys, name, monkeypatch):
    root, c = wide_keys
    monkeypatch.setattr(sys.modules[__name__], "SF", root)
    test_query_matches_oracle(spark, c, name)
