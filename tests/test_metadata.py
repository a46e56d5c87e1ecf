from quantspark.config import Params
from quantspark.plans.features import lineage
from quantspark.plans.model import experiment_record
from quantspark.schemas import FEATURE_COLUMNS


def test_lineage_covers_every_feature(spark):
    rows = {r["feature"]: r for r in lineage(spark).collect()}
    assert len(rows) == len(FEATURE_COLUMNS) - 5  # ids, versions, timestamp and target excluded
    assert rows["rolling_pnl_5"]["source"] == "trades"
    assert rows["lag_12"]["source"] == "macro_series"
    assert rows["hour_of_day"]["dependencies"] == "timestamp"


def test_experiment_record(spark):
    r = experiment_record(spark, "exp1", ["ridge", "lasso"], ["a", "b"], Params(), ["CPIAUCSL"]).first()
    assert r["experiment_id"] == "exp1" and r["feature_count"] == 2 and r["random_seed"] == 42
    assert r["parameters"]["tuner"] == "gridsearch" and r["series_used"] == ["CPIAUCSL"]
