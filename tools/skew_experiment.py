"""Skew experiment for the sequence operator (not a registered query).

One user is given a third of the events (rows are relabelled, none dropped),
then ``lead`` per user is computed with the grouped window and with the split
strategy. Spark's event log (written to a fresh scratch folder; no UI) gives
the largest number of shuffle records read by one task in each run.

Usage: python tools/skew_experiment.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window
from pyspark.sql import functions as F  # noqa: E402

from consentflow.operators.sequence import with_neighbour  # noqa: E402
from consentflow.plans.graph import ModelGraph  # noqa: E402
from consentflow.session import get_session  # noqa: E402


def stage_stats(log_dir: str, job_group: str) -> list[dict]:
    """Per stage of a job group: tasks, largest and total shuffle records read."""
    stages, names, per_stage = set(), {}, {}
    events = []
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if not os.path.isfile(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path, encoding="utf-8") as fh:
            events += [json.loads(line) for line in fh if line.strip()]
    for e in events:
        if e.get("Event") == "SparkListenerJobStart" and \
                e.get("Properties", {}).get("spark.jobGroup.id") == job_group:
            stages.update(e.get("Stage IDs", []))
            for info in e.get("Stage Infos", []):
                names[info["Stage ID"]] = info.get("Stage Name", "")
    for e in events:
        if e.get("Event") == "SparkListenerTaskEnd" and e.get("Stage ID") in stages:
            recs = e.get("Task Metrics", {}).get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            st = per_stage.setdefault(e["Stage ID"], {"stage": e["Stage ID"], "tasks": 0, "max": 0, "sum": 0})
            st["tasks"] += 1
            st["max"] = max(st["max"], recs)
            st["sum"] += recs
    return [per_stage[k] for k in sorted(per_stage) if per_stage[k]["sum"] > 0]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="skew-eventlog-")
    spark = get_session("local[8]", shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    fe = ModelGraph(spark, sf).fct_event.select("user_id", "event_dttm", "event_id", "event_type")
    hot = fe.withColumn("user_id", F.when(F.col("event_id").cast("long") % 3 == 0, F.lit("hot"))
                        .otherwise(F.col("user_id")))
    n = hot.count()
    results = {}
    order = ["event_dttm", "event_id"]
    for strategy in ("window", "ranges"):
        spark.sparkContext.setJobGroup(strategy, strategy)
        if strategy == "window":
            out = hot.withColumn("event_type_next", F.lead("event_type").over(Window.partitionBy("user_id").orderBy(*order)))
        else:
            out = with_neighbour(hot, ["user_id"], order, ["event_type"], "next", num_ranges=16)
        out.write.format("noop").mode("overwrite").save()
    spark.stop()
    summary = {}
    for strategy in ("window", "ranges"):
        stages = stage_stats(log_dir, strategy)
        full = [st for st in stages if st["sum"] >= 0.9 * n]
        window_stage = full[-1]  # the exchange feeding the window is the last full read
        summary[strategy] = {"window_tasks": window_stage["tasks"],
                             "max_rows_one_task": window_stage["max"],
                             "mean_rows_per_task": window_stage["sum"] // window_stage["tasks"],
                             "full_passes_over_input": len(full)}
    print(json.dumps({"rows": n, "hot_user_rows": n // 3, "strategies": summary}))


if __name__ == "__main__":
    main()
