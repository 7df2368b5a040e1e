"""Measure NULL-key skew in the shuffle fact join, with and without the
salt, from Spark's event log (written to a fresh scratch folder).

    python tools/skew_check.py [rows] [--hot]

Builds ``rows`` fact rows: a third with every flag NULL, the rest spread
over 1,000 flag combinations, joins them to
their flag-combination dimension as a shuffle join (broadcast off), and
prints, per variant, the largest number of shuffle records any one task of
the join read, next to the mean.  ``--hot`` instead puts a third of the
rows on one non-NULL combination and compares AQE off with AQE's skew join.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from starbuild.operators import dims as D  # noqa: E402
from starbuild.operators import facts as FT  # noqa: E402


def _shuffle_reads(files: list[str]) -> dict[tuple[str | None, int], list[int]]:
    stage_group: dict[int, str | None] = {}
    reads: dict[tuple[str | None, int], list[int]] = {}
    for log_file in files:
        with open(log_file) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for st in ev.get("Stage IDs", []):
                        stage_group[st] = group
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    recs = m.get("Total Records Read", 0)
                    if recs:
                        key = (stage_group.get(ev["Stage ID"]), ev["Stage ID"])
                        reads.setdefault(key, []).append(recs)
    return reads


def _session(log_dir: str, aqe: bool) -> SparkSession:
    b = (SparkSession.builder.master("local[8]").appName("skew-check")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.compress", "false")
         .config("spark.eventLog.dir", log_dir)
         .config("spark.sql.shuffle.partitions", "16")
         .config("spark.sql.autoBroadcastJoinThreshold", "-1")
         .config("spark.sql.adaptive.enabled", str(aqe).lower()))
    if aqe:
        # Local data is far below the default skew thresholds (256 MB).
        b = (b.config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
             .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "256k")
             .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starbuild-ckpt-"))
    return spark


def _report(log_dir: str, labels) -> None:
    files = sorted(f for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
                   if os.path.isfile(f))
    reads = _shuffle_reads(files)
    for label in labels:
        stages = {k: v for k, v in reads.items() if k[0] == label}
        # The join stage reads the fact shuffle: the stage with most records.
        (_, st), vals = max(stages.items(), key=lambda kv: sum(kv[1]))
        print(json.dumps({"variant": label, "tasks": len(vals), "max_records": max(vals),
                          "mean_records": round(sum(vals) / len(vals)),
                          "max_over_mean": round(max(vals) / (sum(vals) / len(vals)), 2)}))


def main(rows: int, hot: bool) -> None:
    if not hot:
        # A third of the rows with every flag NULL; the rest over 1,000
        # combinations.  AQE off so the raw partitioning shows.
        log_dir = tempfile.mkdtemp(prefix="starbuild-eventlog-")
        spark = _session(log_dir, aqe=False)
        nulls = F.col("id") % 3 == 1
        base = spark.range(0, rows).select(
            "id",
            F.when(nulls, F.lit(None).cast("string"))
             .otherwise((F.col("id") % 1000).cast("string")).alias("a"),
            F.when(nulls, F.lit(None).cast("string")).otherwise(F.lit("x")).alias("b"))
        dim = D.combination_dimension(base, ["a", "b"], "k").checkpoint(eager=True)
        labels = ("plain", "salted")
        for label, buckets in zip(labels, (1, None)):
            spark.sparkContext.setJobGroup(label, label)
            FT.attach_dimension_key(base, dim, ["a", "b"], "k", salt_by=["id"], salt_buckets=buckets) \
                .write.format("noop").mode("overwrite").save()
        spark.stop()
        _report(log_dir, labels)
        return
    # A third of the rows on one hot non-NULL combination, the rest over
    # 1,000: the salted join with AQE off, then with AQE's skew join.
    for label, aqe in (("hot_no_aqe", False), ("hot_aqe_skew_join", True)):
        log_dir = tempfile.mkdtemp(prefix="starbuild-eventlog-")
        spark = _session(log_dir, aqe=aqe)
        hot_rows = F.col("id") % 3 == 0
        base = spark.range(0, rows).select(
            "id",
            F.when(hot_rows, F.lit("HOT")).otherwise((F.col("id") % 1000).cast("string"))
            .alias("a"), F.lit("x").alias("b"))
        dim = D.combination_dimension(base, ["a", "b"], "k").checkpoint(eager=True)
        spark.sparkContext.setJobGroup(label, label)
        FT.attach_dimension_key(base, dim, ["a", "b"], "k", salt_by=["id"]) \
            .write.format("noop").mode("overwrite").save()
        spark.stop()
        _report(log_dir, (label,))


if __name__ == "__main__":
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    main(int(args[0]) if args else 1_200_000, "--hot" in sys.argv)
