"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully executed through the ``noop`` sink (every row produced,
nothing collected); the best of $BENCH_REPEAT runs is reported. Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rankforge.plans import registry  # noqa: E402
from rankforge.session import build_session  # noqa: E402

HEADLINE = ["wide_eval_by_day", "fit_all_features", "embed_bag_sum", "score_fm", "auc_exact",
            "trailing_ctr_user", "topk_retrieval", "score_deepfm", "score_mmoe", "grad_step_lr"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8))
    # warm-up: JIT and first-touch of the files, not timed
    registry.QUERIES["scan_days"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in only:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    n_samples = spark.read.parquet(os.path.join(sf_dir, "lineitem.parquet")).count()
    total = round(sum(times.values()), 3)
    # training throughput (the reference publishes only training rates): data-parallel
    # Adam steps on the DNN tower, every step a full pass over the samples
    train = None
    if os.environ.get("BENCH_TRAIN", "1") == "1":
        from pyspark.sql import functions as F
        from rankforge.operators import training as TR
        from rankforge.plans import queries_models as QM
        x = QM._sp(spark, sf_dir).select(QM._x().alias("x"), "y_ctr", "wt").persist()
        x.count()
        steps = 3
        t0 = time.perf_counter()
        TR.train_deep(x, "x", QM.WIDTH, QM.HIDDEN, steps=steps, lr=0.01)
        dt = time.perf_counter() - t0
        x.unpersist()
        train = {"train_deep_sec_per_step": round(dt / steps, 3),
                 "train_samples_per_sec": round(n_samples * steps / dt, 1)}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "samples": n_samples, "samples_per_sec_wide_eval": round(n_samples / times.get(
                          "wide_eval_by_day", total), 1) if times else None, "cpus": cpus,
                      **(train or {})}))
    spark.stop()


if __name__ == "__main__":
    main()
