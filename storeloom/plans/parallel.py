"""Submitting independent Spark jobs at the same time."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def run_together(spark: SparkSession, jobs: Sequence[Callable[[], object]],
                 at_once: int = 8) -> list[object]:
    """Run jobs that do not depend on each other; the first failure is raised.

    Small jobs leave executors idle at their end; the next job fills them.
    """
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [f.result() for f in futures]
