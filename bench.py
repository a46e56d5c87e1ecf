"""Headline-query benchmark: prints one JSON line.

equity curve + trading metrics (L14 + L16) and the recommendation grid
(K1-K7).  Each runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``; one warm-up, then the median of ``$BENCH_REPEATS``
(default 3) runs.  A run materialises the whole result (noop sink).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    from quantspark.session import get_spark
    spark = get_spark(f"local[{cpus}]", app="quantspark-bench", shuffle_partitions=int(cpus) * 2)

    from quantspark import catalog
    from quantspark.catalog_eval import BASELINE_PERM
    from quantspark.plans import evaluate as ev
    from quantspark.plans import model as mdl
    from quantspark.plans import recommend as rec
    from quantspark.sources import fixtures as fx

    def feature_store():
        return catalog.QUERIES["g7_feature_store"](spark, sf_dir)

    def equity_and_metrics():
        t = fx.trades_from_events(spark, sf_dir)
        p = fx.predictions_from_trades(t)
        return list(ev.equity_report(p, t, BASELINE_PERM))

    def recommendation():
        t = fx.trades_from_events(spark, sf_dir)
        f = catalog.features.build_features(t, fx.macro_from_orders(spark, sf_dir),
                                            feature_timestamp=catalog.RUN_STAMP)
        m = mdl.prepare(f, t).persist()
        feats = mdl.feature_columns(m)
        model = mdl.fit_linear("linear_regression", {}, m, feats)
        best = rec.best_per_slot(rec.score_grid(rec.profiles(m, feats), model.transform))
        out = rec.recommendation_matrix(best)
        out.write.format("noop").mode("overwrite").save()
        m.unpersist()
        return []

    queries = {"g7_feature_store": feature_store, "l14_l16_equity_metrics": equity_and_metrics,
               "k1_k7_recommendation": recommendation}
    times = {}
    for name, build in queries.items():
        runs = []
        for i in range(repeats + 1):
            t0 = time.time()
            out = build()
            for df in (out if isinstance(out, list) else [out]):
                df.write.format("noop").mode("overwrite").save()
            if i > 0:
                runs.append(time.time() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
