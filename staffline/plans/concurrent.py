"""Independent tables of a run as parallel Spark jobs, along their dependencies."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

#: jobs that run at the same time; each keeps the cluster busy by itself once its input is large
PARALLEL_TABLES = 6


def run_along(spark: SparkSession, steps: Mapping[str, tuple[Sequence[str], Callable[[dict[str, Any]], Any]]],
              parallel: int = PARALLEL_TABLES) -> dict[str, Any]:
    """Results by name. A step is (names it needs, function of the results so far) and starts when those are done.

    Each step's jobs run in a scheduler pool of its name (they share the executors
    fairly where ``spark.scheduler.mode`` is FAIR). The first failure is raised
    after the steps already running have ended; no further step starts.
    """
    unknown = {n for needs, _ in steps.values() for n in needs} - set(steps)
    if unknown:
        raise ValueError(f"steps need {sorted(unknown)}, which no step makes")
    done: dict[str, Any] = {}
    running: dict[Future, str] = {}
    waiting = dict(steps)

    def job(name: str, make: Callable[[dict[str, Any]], Any], so_far: dict[str, Any]):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        spark.sparkContext.setJobDescription(f"publish {name}")
        return make(so_far)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        while waiting or running:
            ready = [n for n, (needs, _) in waiting.items() if all(x in done for x in needs)]
            if not ready and not running:
                raise ValueError(f"steps need each other: {sorted(waiting)}")
            for name in ready:
                _, make = waiting.pop(name)
                running[pool.submit(inheritable_thread_target(spark)(job), name, make, dict(done))] = name
            ended, _ = wait(running, return_when=FIRST_COMPLETED)
            for future in ended:
                name = running.pop(future)
                done[name] = future.result()
    return done
