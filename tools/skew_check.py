"""Skew check: derive a hot-user events table from the driver's data (every
third event moved to one user, so one session holds a third of all rows),
run the feature job with Spark's event log in a scratch folder, and print
per-stage records read by the largest and the median task.

    python tools/skew_check.py /root/testdata/sf0.1 [bucket_seconds]
"""

import glob
import io
import json
import os
import statistics
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from sessionlab.operators.features import build_features  # noqa: E402
from sessionlab.session import get_spark  # noqa: E402
from sessionlab.sources.adapter import clicks_from_events  # noqa: E402
from sessionlab.sources.store import stage  # noqa: E402


def stage_balance(log_dir: str, job_desc: str) -> list[tuple]:
    import zstandard
    stages, tasks = set(), defaultdict(list)
    for path in sorted(glob.glob(f"{log_dir}/*/events_*")):
        with open(path, "rb") as fh:
            stream = fh if not path.endswith(".zstd") else zstandard.ZstdDecompressor().stream_reader(fh)
            for line in io.TextIOWrapper(stream, encoding="utf-8"):
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart" and \
                        (e.get("Properties") or {}).get("spark.job.description") == job_desc:
                    stages.update(e["Stage IDs"])
                elif e["Event"] == "SparkListenerTaskEnd":
                    m = e.get("Task Metrics") or {}
                    n = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    tasks[e["Stage ID"]].append(n)
    return [(s, len(tasks[s]), max(tasks[s]), int(statistics.median(tasks[s])))
            for s in sorted(stages) if len(tasks.get(s, [])) > 1]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    bucket = float(sys.argv[2]) if len(sys.argv) > 2 else 3600.0
    scratch = tempfile.mkdtemp(prefix="skew-check-")
    os.makedirs(f"{scratch}/ev")
    spark = get_spark("local[8]", 32, extra={"spark.eventLog.enabled": "true",
                                             "spark.eventLog.dir": f"{scratch}/ev",
                                             "spark.sql.adaptive.enabled": "false"})
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    clicks = stage(clicks_from_events(hot), "hot_clicks")
    top = clicks.groupBy("user_session").count().orderBy(F.desc("count")).first()
    print(f"largest session {top['user_session']}: {top['count']} of {clicks.count()} rows")
    spark.sparkContext.setJobDescription("FEATURES")
    build_features(clicks, ["base", "behavioral", "temporal"], bucket_seconds=bucket) \
        .write.format("noop").mode("overwrite").save()
    spark.stop()
    for s, n, mx, med in stage_balance(f"{scratch}/ev", "FEATURES"):
        print(f"stage {s}: {n} tasks, records read max {mx}, median {med}")


if __name__ == "__main__":
    main()
