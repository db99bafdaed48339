"""Progress of running scans, by the tasks of the stages that are under way."""

from __future__ import annotations

from pyspark.sql import SparkSession


def scan_progress(spark: SparkSession, group: str | None = None) -> float:
    """Percent of the tasks of all active jobs (or of a job group's) that are done; 100 where nothing runs."""
    tracker = spark.sparkContext.statusTracker()
    jobs = tracker.getActiveJobsIds() if group is None else [j for j in tracker.getJobIdsForGroup(group) if j in set(tracker.getActiveJobsIds())]
    done = total = 0
    for job in jobs:
        info = tracker.getJobInfo(job)
        for stage in info.stageIds if info else []:
            s = tracker.getStageInfo(stage)
            if s:
                done, total = done + s.numCompletedTasks, total + s.numTasks
    return 100.0 if not jobs else 100.0 * done / max(1, total)
