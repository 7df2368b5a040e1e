"""Shuffle bytes written by the exact duplicate finder: grouping on the
full text vs the hash-first form used by ``quality.hidden_duplicates``,
read from Spark's event log (written to a fresh scratch folder).

    python tools/shuffle_bytes.py [sf_dir]
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

from starbuild.operators import quality as Q  # noqa: E402


def _bytes_by_group(log_dir: str) -> dict[str, int]:
    files = [f for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
             if os.path.isfile(f)]
    stage_group: dict[int, str | None] = {}
    total: dict[str, int] = {}
    for path in files:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for st in ev.get("Stage IDs", []):
                        stage_group[st] = group
                elif ev.get("Event") == "SparkListenerTaskEnd":
                    w = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    g = stage_group.get(ev["Stage ID"])
                    if g:
                        total[g] = total.get(g, 0) + w.get("Shuffle Bytes Written", 0)
    return total


def main(sf_dir: str) -> None:
    log_dir = tempfile.mkdtemp(prefix="starbuild-eventlog-")
    spark = (SparkSession.builder.master("local[8]").appName("shuffle-bytes")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.compress", "false")
             .config("spark.eventLog.dir", log_dir)
             .config("spark.sql.shuffle.partitions", "8")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    plain = (docs.groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
             .filter(F.col("copies") >= 2))
    for label, df in (("group_on_text", plain),
                      ("hash_first", Q.hidden_duplicates(docs, ["text"]))):
        spark.sparkContext.setJobGroup(label, label)
        df.write.format("noop").mode("overwrite").save()
    spark.stop()
    for label, b in _bytes_by_group(log_dir).items():
        print(json.dumps({"variant": label, "shuffle_bytes_written": b}))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
