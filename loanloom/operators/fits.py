"""Several model fits side by side in one session."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

Job = TypeVar("Job")
Result = TypeVar("Result")


def side_by_side(
    spark: SparkSession, fit: Callable[[Job], Result], jobs: Sequence[Job],
    at_once: int = 4, attempts: int = 3, pool: str = "fits",
) -> list[Result]:
    """``fit(job)`` for all jobs, in the order of ``jobs`` whatever order they end in.

    At most ``at_once`` fits run at a time.  Each thread submits its Spark jobs to a pool of its
    own (``fits-0``, ``fits-1``, ...), which share executors evenly where the session has
    ``spark.scheduler.mode=FAIR``.  A fit that fails is repeated alone, up to ``attempts`` times
    in all; others go on meanwhile.  Once one has failed for good no further ones start, those
    that run come to their end, and its error is raised.
    """
    if at_once < 1 or attempts < 1:
        raise ValueError("at_once and attempts must be positive")
    context = spark.sparkContext
    free, lock = list(range(at_once)), threading.Lock()
    stopped = threading.Event()

    def run(job: Job) -> Result | None:
        if stopped.is_set():
            return None
        with lock:
            slot = free.pop()
        context.setLocalProperty("spark.scheduler.pool", f"{pool}-{slot}")
        try:
            for attempt in range(1, attempts + 1):
                try:
                    return fit(job)
                except Exception:
                    if attempt == attempts or stopped.is_set():
                        stopped.set()
                        raise
                    log.warning("fit %r failed, attempt %d of %d", job, attempt, attempts, exc_info=True)
        finally:
            context.setLocalProperty("spark.scheduler.pool", None)
            with lock:
                free.append(slot)

    with ThreadPoolExecutor(max_workers=at_once) as threads:
        # threads carry the caller's job group, so that cancelling it cancels the fits
        started = [threads.submit(inheritable_thread_target(spark)(run), job) for job in jobs]
        wait(started, return_when=FIRST_EXCEPTION)
    for one in started:
        if one.exception():
            raise one.exception()
    return [one.result() for one in started]
