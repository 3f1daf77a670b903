"""Progress of a load while it runs, and a way to stop it."""

from __future__ import annotations

import logging
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)


class LoadStopped(RuntimeError):
    """The listener of a load asked for its end."""


@dataclass(frozen=True)
class LoadProgress:
    """Tasks of the stages that a load has begun, and how many of them are done or under way."""

    alias: str
    seconds: float
    tasks: int
    done: int
    running: int


def _tasks(spark: SparkSession, tag: str, seen: dict[int, tuple[int, int, int]]) -> tuple[int, int, int]:
    """Tasks, done and running ones of all jobs with a tag; stages that Spark has forgotten keep their last numbers."""
    context = spark.sparkContext
    tracker = context.statusTracker()
    for job in list(context._jsc.sc().statusTracker().getJobIdsForTag(tag)):
        info = tracker.getJobInfo(job)
        for stage in info.stageIds if info else ():
            found = tracker.getStageInfo(stage)
            if found:
                seen[stage] = (found.numTasks, found.numCompletedTasks, found.numActiveTasks)
    return tuple(sum(s[k] for s in seen.values()) for k in range(3)) if seen else (0, 0, 0)


@contextmanager
def watched_load(
    spark: SparkSession, alias: str, progress: Callable[[LoadProgress], bool | None], every: float = 0.5
) -> Iterator[None]:
    """Tell ``progress`` of the jobs that the block starts in this thread, each ``every`` seconds and at the end.

    The jobs carry a tag of their own. When ``progress`` returns False, or fails, jobs with that tag are cancelled and the block
    ends with ``LoadStopped``; later jobs of the block are cancelled too.
    """
    context = spark.sparkContext
    tag, began, over = f"tidemark-{uuid.uuid4().hex}", time.monotonic(), threading.Event()
    stopped: list[BaseException | None] = []
    seen: dict[int, tuple[int, int, int]] = {}

    def tell() -> None:
        try:
            tasks, done, running = _tasks(spark, tag, seen)
            if progress(LoadProgress(alias, time.monotonic() - began, tasks, done, running)) is False:
                stopped.append(None)
        except Exception as failure:  # the listener's own
            stopped.append(failure)

    def poll() -> None:
        while not over.wait(every):
            if not stopped:
                tell()
            if stopped:
                context.cancelJobsWithTag(tag)

    thread = threading.Thread(target=poll, name=f"progress of {alias}", daemon=True)
    context.addJobTag(tag)
    thread.start()
    failed = None
    try:
        yield
    except Exception as failure:
        failed = failure
    finally:
        over.set()
        thread.join()
        context.removeJobTag(tag)
    if failed is not None:
        if stopped:
            raise LoadStopped(f"{alias}: stopped by its listener") from (stopped[0] or failed)
        raise failed
    tell()
