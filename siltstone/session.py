"""Sessions: take the active one, or build a local one that is stopped again by who built it."""

from __future__ import annotations

import os
import warnings
from collections.abc import Mapping

from pyspark.sql import SparkSession

_owned: list[SparkSession] = []


def preflight(system: str = os.name, home: str | None = None) -> list[str]:
    """What is missing on this machine for writing files from Spark; on Windows Hadoop needs native helpers."""
    home = os.environ.get("HADOOP_HOME") if home is None else home
    if system != "nt":
        return []
    if not home:
        return ["HADOOP_HOME is not set"]
    return [f"{name} is missing in {home}/bin" for name in ("winutils.exe", "hadoop.dll") if not os.path.exists(os.path.join(home, "bin", name))]


def get_spark(app: str = "siltstone", threads: str = "*", shuffle_partitions: int | None = None, conf: Mapping[str, str] | None = None) -> SparkSession:
    """The active session as it is (on a cluster, its settings are the cluster's), else a new local one in UTC."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    for problem in preflight():
        warnings.warn(problem, stacklevel=2)
    if "SPARK_REMOTE" not in os.environ and "MASTER" not in os.environ:
        builder = builder.master(f"local[{threads}]").config("spark.driver.host", "127.0.0.1").config("spark.ui.enabled", "false")
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or os.cpu_count() or 8))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    _owned.append(spark)
    return spark


def stop_spark(spark: SparkSession) -> None:
    """Stop a session that ``get_spark`` built; leave others alone."""
    if spark in _owned:
        _owned.remove(spark)
        spark.stop()
