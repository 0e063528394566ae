"""Running independent jobs side by side, so that small ones do not leave a cluster idle."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context


def together(jobs: Iterable[Callable[[], object]], at_once: int = 4) -> list:
    """The results in order; the first failure is raised once all have ended.

    The jobs see the context variables of their caller.
    """
    with ThreadPoolExecutor(at_once) as pool:
        running = [pool.submit(copy_context().run, job) for job in jobs]
    return [job.result() for job in running]
