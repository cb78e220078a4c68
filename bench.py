"""Time the headline queries and print one JSON line.

The encounters derived from the test tables are stored once, as the raw file a user
starts from; every timed query then reads that stored table.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from checks import fixtures  # noqa: E402
from checks.queries import KEY, QUERIES, Inputs  # noqa: E402
from riskloom.operators import attribution, encoding, splits  # noqa: E402
from riskloom.plans import models, scoring  # noqa: E402
from riskloom.session import scratch_path, settle, tune  # noqa: E402


class StoredInputs(Inputs):
    """Inputs whose encounters are read from a stored table."""

    path = ""

    def encounters(self) -> DataFrame:
        return self.spark.read.parquet(self.path)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shared-"))
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def run(df: DataFrame) -> None:
    """Execute a plan completely without moving its rows to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = session(cpus)
    inputs = StoredInputs(spark, sf_dir)
    inputs.path = scratch_path(spark, "bench-encounters")

    start = time.time()
    fixtures.encounters(spark, sf_dir).repartition(int(cpus)).write.parquet(inputs.path)
    setup = time.time() - start

    names = [
        "readmission_by_diagnosis", "first_encounters", "feature_chain", "null_report", "describe",
        "group_rates", "histogram", "correlations", "all_metrics", "optimal_threshold",
        "calibration_curve", "fairness_report", "stratified_split", "scaling", "psi",
        "drift_report", "top_reasons", "contract_errors",
    ]
    jobs = {name: (lambda name=name: run(QUERIES[name](inputs))) for name in names}

    encoder = encoding.TabularEncoder()
    rows = settle(inputs.model_rows())
    fitted = encoder.fit(rows)
    encoded = settle(encoding.encode(fitted, splits.assign_splits(rows, KEY), [KEY, "readmitted", "split"]))
    train = encoded.filter("split = 'train'")
    logistic = models.Candidate("logistic_regression", {"max_iter": 100})
    model = logistic.fit(train)
    scorer = scoring.Scorer(fitted, model, model, 0.5, "bench", attribution.feature_means(train))
    jobs["fit_encoder"] = lambda: encoder.fit(rows)
    jobs["train_logistic"] = lambda: logistic.fit(train)
    jobs["batch_scores"] = lambda: run(scorer.score(rows, [KEY]))

    seconds = {}
    for name, job in jobs.items():
        job()  # warm-up
        times = []
        for _ in range(repeats):
            start = time.time()
            job()
            times.append(time.time() - start)
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries (median of warm runs)",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "setup": round(setup, 3),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
