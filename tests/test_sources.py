import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quantspark.sources.tables import (initialize_schema, read_macro_csv, read_table, read_trades_csv, row_count,
                                       sql, table_exists, write_table)


def test_read_trades_csv_mixed_formats(spark):
    d = tempfile.mkdtemp(prefix="qs-csv-", dir="/tmp")
    with open(f"{d}/t.csv", "w") as f:
        f.write("id,timestamp,account,direction,quantity,price,pnl,permutation_id,holding_time,threshold\n")
        f.write("1,2024-01-01 10:00:00.100,ACC_1,BUY,10,100,5,P1,1,0.1\n")
        f.write("2,2024-01-01 10:00:01,ACC_1,SELL,20,103,10,P1,1,0.1\n")
    rows = read_trades_csv(spark, f"{d}/t.csv").orderBy("id").collect()
    assert rows[0]["timestamp"] == dt.datetime(2024, 1, 1, 10, 0, 0, 100000)
    assert rows[1]["timestamp"] == dt.datetime(2024, 1, 1, 10, 0, 1) and rows[1]["quantity"] == 20.0


def test_read_macro_csv_dot_is_missing(spark):
    d = tempfile.mkdtemp(prefix="qs-macro-", dir="/tmp")
    with open(f"{d}/UNRATE.csv", "w") as f:
        f.write("observation_date,UNRATE\n2024-01-01,3.7\n2024-02-01,.\n2024-03-01,3.9\n2025-01-01,4.0\n")
    rows = read_macro_csv(spark, d, start="2024-01-01", end="2024-12-31").orderBy("date").collect()
    assert [r["value"] for r in rows] == [3.7, 3.9]
    assert rows[0]["series_id"] == "UNRATE"
    assert rows[0]["release_date"] == dt.datetime(2024, 1, 31, 8, 30)


def test_table_round_trip_and_sql(spark):
    root = tempfile.mkdtemp(prefix="qs-wh-", dir="/tmp")
    initialize_schema(spark, root)
    assert table_exists(spark, root, "macro_events") and row_count(spark, root, "trades") == 0
    ev = spark.createDataFrame([(dt.datetime(2024, 1, 1), "CPI", "US", "high", 1.0, None, None, None, "x", "2", None),
                                (dt.datetime(2024, 2, 1), "CPI", "US", "high", 2.0, None, 1.0, None, "x", "2", None)],
                               read_table(spark, root, "macro_events").schema)
    write_table(ev, root, "macro_events", "append")
    out = sql(spark, "SELECT count(*) AS c FROM ev WHERE event_name = :name",
              {"ev": read_table(spark, root, "macro_events")}, name="CPI").first()
    assert out["c"] == 2


def _trades(spark, ids):
    from quantspark.schemas import TRADES
    return spark.createDataFrame([(i, dt.datetime(2024, 1, 1, 0, 0, i), "A", "BUY", 1.0, 2.0, float(i), "P", 1.0, 0.5)
                                  for i in ids], TRADES)


def test_refresh_from_itself(spark):
    root = tempfile.mkdtemp(prefix="qs-wh-", dir="/tmp")
    write_table(_trades(spark, range(6)), root, "trades", "overwrite")
    before = read_table(spark, root, "trades")
    for least in (2, 4):
        write_table(read_table(spark, root, "trades").filter(F.col("id") >= least), root, "trades", "overwrite")
        if least == 2:
            assert before.count() == 6                     # a reader of the snapshot before keeps its rows
    assert sorted(r["id"] for r in read_table(spark, root, "trades").collect()) == [4, 5]
    write_table(_trades(spark, [9]), root, "trades", "append")
    assert row_count(spark, root, "trades") == 3
    assert len([x for x in os.listdir(f"{root}/trades") if x.startswith("snapshot-")]) == 2


def test_failing_refresh_leaves_the_old_rows(spark):
    root = tempfile.mkdtemp(prefix="qs-wh-", dir="/tmp")
    write_table(_trades(spark, range(3)), root, "trades", "overwrite")
    bad = read_table(spark, root, "trades").withColumn("pnl", F.raise_error(F.lit("no")).cast("double"))
    with pytest.raises(Exception, match="no"):
        write_table(bad, root, "trades", "overwrite")
    assert row_count(spark, root, "trades") == 3
    with pytest.raises(ValueError):
        write_table(_trades(spark, [7]), root, "trades", "fail")


def test_update_delete_fetch(spark):
    from quantspark.sources.tables import fetch, rewrite_rows
    root = tempfile.mkdtemp(prefix="qs-wh-", dir="/tmp")
    write_table(_trades(spark, range(4)), root, "trades", "overwrite")
    rewrite_rows(spark, root, "trades", F.col("id") == 1, {"pnl": F.lit(50)})
    rewrite_rows(spark, root, "trades", F.col("id") == 2)
    rewrite_rows(spark, root, "trades", F.lit(None).cast("boolean"))
    rows = read_table(spark, root, "trades").select("id", "pnl").orderBy("id")
    assert fetch(rows, 10) == [(0, 0.0), (1, 50.0), (3, 3.0)] and fetch(rows, 1) == [(0, 0.0)]


def test_files_of_other_column_order(spark):
    d = tempfile.mkdtemp(prefix="qs-csv-", dir="/tmp")
    with open(f"{d}/a.csv", "w") as f:
        f.write("id,timestamp,price,quantity\n1,2024-01-01 10:00:00,100,7\n")
    with open(f"{d}/b.csv", "w") as f:
        f.write('"id",timestamp, quantity,price\n2,2024-01-01 10:00:00,8,200\n')
    with pytest.raises(Exception, match="CSV header does not conform|header"):
        read_trades_csv(spark, d).collect()
    rows = read_trades_csv(spark, d, mixed_headers=True).orderBy("id").collect()
    assert [(r["price"], r["quantity"]) for r in rows] == [(100.0, 7.0), (200.0, 8.0)]
