"""Submitting independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import Hashable, TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

K = TypeVar("K", bound=Hashable)
T = TypeVar("T")

WORKERS = 8


def run_together(spark: SparkSession, actions: Mapping[K, Callable[[], T]], workers: int = WORKERS) -> dict[K, T]:
    """Run the actions from a few threads, so that the last tasks of one job do not leave the cluster idle.

    Results come in the order of ``actions``.  The first failure is raised once the running actions have ended.
    """

    def start(pool: ThreadPoolExecutor, action: Callable[[], T]):
        return pool.submit(inheritable_thread_target(spark)(action))

    with ThreadPoolExecutor(workers) as pool:
        started = {name: start(pool, action) for name, action in actions.items()}
        return {name: future.result() for name, future in started.items()}
