"""Spark session settings used by the jobs, the tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job relies on.  Session zone is pinned so that string timestamps with an
# offset parse to the same wall-clock value everywhere; all NTZ arithmetic in
# aerolake.functions is zone-free anyway.
_JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "aerolake", master: str | None = None, shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return a session with the job settings.

    Without ``master`` (jobs under spark-submit / on a cluster) the master, executors and
    shuffle sizing come from the launcher and cluster configuration; only job-level SQL
    settings are applied.  With an explicit ``master`` (tests, benchmark) a local session is
    built with local sizing.
    """
    if master is None:
        active = SparkSession.getActiveSession()
        if active is None:
            builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
            for k, v in _JOB_CONF.items():
                builder = builder.config(k, v)
            active = builder.getOrCreate()
        for k, v in _JOB_CONF.items():
            active.conf.set(k, v)
        return active
    builder = SparkSession.builder.appName(app).master(master)
    conf = dict(_JOB_CONF)
    conf.update({
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or 8),
        "spark.driver.memory": "8g",
    })
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
