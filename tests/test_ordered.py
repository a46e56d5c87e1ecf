"""Property checks of the ordered operators against plain single-partition windows / DuckDB."""

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quantspark.operators.asof import asof_join
from quantspark.operators.ordered import halo_window, running_aggs, running_sum_max, with_position


def _data(spark, n, seed, groups=3):
    rnd = random.Random(seed)
    rows = [(i, rnd.randint(0, n // 3), f"g{rnd.randint(0, groups - 1)}", rnd.choice([None, rnd.uniform(-5, 5)])
             if rnd.random() < 0.1 else rnd.uniform(-5, 5)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, t long, g string, x double")


@pytest.mark.parametrize("blocks", [1, 3, 7])
def test_position_is_exact(spark, blocks):
    df = _data(spark, 500, blocks)
    got = with_position(df, ["t", "id"], num_blocks=blocks).select("id", "_pos").toPandas()
    exp = df.toPandas().sort_values(["t", "id"]).reset_index(drop=True)
    exp["_pos"] = range(len(exp))
    m = got.merge(exp[["id", "_pos"]], on="id", suffixes=("", "_e"))
    assert len(m) == 500 and (m["_pos"] == m["_pos_e"]).all()


@pytest.mark.parametrize("blocks", [1, 4, 9])
def test_running_aggs_equal_global_window(spark, blocks):
    df = _data(spark, 400, 10 + blocks)
    got = running_aggs(df, {"s": ("sum", F.col("x")), "mx": ("max", F.col("x")),
                            "last": ("max", F.when(F.col("g") == "g1", F.struct("t", "id", "x")))},
                       order=["t", "id"], num_blocks=blocks)
    w = Window.orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("id", F.coalesce(F.sum("x").over(w), F.lit(0.0)).alias("s_e"), F.max("x").over(w).alias("mx_e"),
                    F.max(F.when(F.col("g") == "g1", F.struct("t", "id", "x"))).over(w).alias("last_e"))
    j = got.join(exp, "id").collect()
    assert len(j) == 400
    for r in j:
        assert abs(r["s"] - r["s_e"]) < 1e-9
        assert r["mx"] == r["mx_e"] and r["last"] == r["last_e"]


@pytest.mark.parametrize("blocks", [1, 5])
def test_running_sum_max(spark, blocks):
    df = _data(spark, 300, 40 + blocks)
    got = running_sum_max(df, F.col("x"), ["t", "id"], num_blocks=blocks).toPandas().sort_values(["t", "id"])
    x = got["x"].fillna(0.0).cumsum()
    assert (abs(got["cum"].to_numpy() - x.to_numpy()) < 1e-9).all()
    assert (abs(got["runmax"].to_numpy() - x.cummax().to_numpy()) < 1e-9).all()


@pytest.mark.parametrize("block_rows,groups", [(7, 1), (16, 3), (1000, 2)])
def test_halo_window_equals_partitioned_window(spark, block_rows, groups):
    df = _data(spark, 300, block_rows, groups)

    def build(w):
        return {"lag3": F.lag("x", 3).over(w), "avg5": F.avg("x").over(w.rowsBetween(-5, -1)),
                "cnt": F.count(F.lit(1)).over(w.rowsBetween(-4, 0))}

    got = halo_window(df, 5, build, order=["t", "id"], group=["g"], block_rows=block_rows, num_blocks=3)
    w = Window.partitionBy("g").orderBy("t", "id")
    exp = df.select("id", *[c.alias(k + "_e") for k, c in build(w).items()])
    j = got.join(exp, "id").collect()
    assert len(j) == 300
    for r in j:
        for k in ("lag3", "avg5", "cnt"):
            a, b = r[k], r[k + "_e"]
            assert (a is None and b is None) or abs(a - b) < 1e-9


def test_asof_join_matches_duckdb(spark):
    rnd = random.Random(7)
    ev = sorted({rnd.randint(0, 200) * 3600 for _ in range(60)})
    events = pd.DataFrame({"r": pd.to_datetime(ev, unit="s"), "v": [float(i) for i in range(len(ev))]})
    events["nxt"] = events["r"].shift(-1)
    left = pd.DataFrame({"id": range(300), "t": pd.to_datetime([rnd.randint(-50, 800000) for _ in range(300)],
                                                                unit="s")})
    left.loc[0, "t"] = events["r"].iloc[3]  # exact tie: strictly-before rule
    sl = spark.createDataFrame(left).withColumn("t", F.col("t").cast("timestamp"))
    se = spark.createDataFrame(events).select(F.col("r").cast("timestamp"), "v", F.col("nxt").cast("timestamp"))
    got = asof_join(sl, "t", se, "r", "nxt", ["v"], bucket_seconds=7200).select(
        "id", "v", "_asof_next").toPandas().sort_values("id").reset_index(drop=True)
    con = duckdb.connect()
    con.register("l", left)
    con.register("e", events)
    exp = con.sql("SELECT l.id, e.v, coalesce(e.nxt, CASE WHEN e.r IS NULL THEN (SELECT min(r) FROM e) END) AS nx "
                  "FROM l ASOF LEFT JOIN e ON l.t > e.r ORDER BY l.id").df()
    assert got["v"].fillna(-1).tolist() == exp["v"].fillna(-1).tolist()
    assert got["_asof_next"].astype(str).tolist() == pd.to_datetime(exp["nx"]).astype(str).tolist()
