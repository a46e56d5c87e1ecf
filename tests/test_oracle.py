"""A sample of registered queries against their DuckDB SQL on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"
NAMES = ["c2_vwap_dedup_1h", "d_time_features", "e_rolling_features", "f_macro_stream", "g7_feature_store",
         "i1_walk_forward_folds", "l2_trading_metrics", "l14_l15_equity_curve", "l23_durbin_watson"]


@pytest.mark.skipif(not os.path.exists(SF), reason="test data missing")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    import __spark_entry__ as e
    from oracle_check import _rows
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in ("events", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sc, sr = _rows(e.queries()[name](spark, SF).toPandas())
    dc, dr = _rows(con.sql(e.oracle_sql()[name]).df())
    assert sc == dc
    assert sr == dr
