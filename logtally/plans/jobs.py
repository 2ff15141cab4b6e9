"""Independent Spark jobs at the same time."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def together(spark: SparkSession, *jobs: Callable) -> list:
    """Results of ``jobs``, run side by side; the first failure is raised.

    Each job starts Spark actions of its own, so small ones share the cluster
    instead of waiting for one another.
    """
    with ThreadPoolExecutor(len(jobs)) as pool:
        inherit = inheritable_thread_target(spark)
        started = [pool.submit(inherit(job)) for job in jobs]
        return [s.result() for s in started]
