"""Independent Spark jobs at the same time."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def together(spark: SparkSession, *tasks: Callable[[], object]) -> list:
    """The results of ``tasks``, which start their jobs from a thread each.

    Small writes spend most of their time on planning and committing; at once, they share the
    cluster.  All have ended when this returns or raises the first error.
    """
    with ThreadPoolExecutor(max(1, len(tasks))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(task)) for task in tasks]
    return [job.result() for job in running]
