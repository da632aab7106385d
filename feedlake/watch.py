"""Work beside the caller whose Spark jobs can be ended: deadlines, and faults seen while it runs."""

import logging
import threading
import time
import uuid
from collections.abc import Callable

from pyspark import InheritableThread
from pyspark.sql import SparkSession

log = logging.getLogger("feedlake.watch")


class GivenUp(RuntimeError):
    """The caller has stopped waiting for this work."""


class DeadlineExceeded(RuntimeError):
    """Raised by work that ran out of the time it set itself."""


class Marker(str):
    """Why a part has no value: ``error``, ``timeout`` or ``deadline``; with the fault it broke down with, if any."""

    fault: BaseException | None = None

    @classmethod
    def of(cls, text: str, fault: BaseException | None = None) -> "Marker":
        marker = cls(text)
        marker.fault = fault
        return marker


class Watched:
    """A function that runs in a thread of its own, all of its Spark jobs under one tag.

    ``work`` gets this object and calls ``check`` before each step that must not happen any more
    when the caller has given up.
    """

    def __init__(self, spark: SparkSession, name: str, work: Callable[["Watched"], object]):
        self.name = name
        self._context = spark.sparkContext
        self._tag = f"feedlake-{name}-{uuid.uuid4().hex}"
        self._over, self._given_up = threading.Event(), threading.Event()
        self._value, self._fault = None, None
        InheritableThread(target=self._run, args=(work,), daemon=True, name=self._tag).start()

    def _run(self, work) -> None:
        try:
            self._context.addJobTag(self._tag)
            self._context.setInterruptOnCancel(True)
            self._value = work(self)
        except BaseException as fault:  # handed to whoever asks for the result
            self._fault = fault
        finally:
            self._over.set()
        if self._given_up.is_set():
            log.warning("%s ended after it was given up: %s", self.name, self._fault or "without a fault")

    def check(self) -> None:
        if self._given_up.is_set():
            raise GivenUp(self.name)

    def wait(self, seconds: float | None = None) -> bool:
        """Whether it is over, after so many seconds at most."""
        return self._over.wait(seconds)

    def result(self):
        """Its value when it is over, or its fault raised."""
        self._over.wait()
        if self._fault is not None:
            raise self._fault
        return self._value

    def give_up(self, grace: float = 10.0) -> None:
        """End its jobs, also those begun meanwhile, and wait for it so many seconds.

        A thread that hangs outside of Spark lives on; the next ``check`` stops it.
        """
        self._given_up.set()
        until = time.monotonic() + grace
        while not self._over.is_set() and time.monotonic() < until:
            self._context.cancelJobsWithTag(self._tag)
            self._over.wait(0.2)


def side_by_side(
    spark: SparkSession, parts: dict[str, Callable[[Watched], object]], *, timeout: float | None = None,
    deadlines: dict[str, float] | None = None,
) -> tuple[dict[str, object], dict[str, Marker]]:
    """Values of the parts that worked, and a marker for each other one, both in the order of ``parts``.

    All parts begin at once and share ``timeout`` seconds; one that is not over by then is given up
    and marked ``timeout``. ``deadlines`` gives single parts less time: ``deadline``, as for a part that
    raises DeadlineExceeded. Any other fault is ``error``. Without its markers the result is not whole: who
    does not judge them raises (``plans.collect.require_all``).
    """
    begun = time.monotonic()
    watched = {name: Watched(spark, name, work) for name, work in parts.items()}
    limits = {}
    for name in watched:
        own = (deadlines or {}).get(name)
        given = [(t, m) for t, m in ((own, "deadline"), (timeout, "timeout")) if t is not None]
        limits[name] = min(given) if given else (None, "")
    late = {}
    for name in sorted(watched, key=lambda n: (limits[n][0] is None, limits[n][0] or 0)):
        seconds, marker = limits[name]
        left = None if seconds is None else max(0.0, begun + seconds - time.monotonic())
        if not watched[name].wait(left):
            late[name] = marker
            log.error("%s is not over after %s seconds", name, seconds)
            # in the background: the time of the others runs on
            threading.Thread(target=watched[name].give_up, daemon=True).start()
    values, markers = {}, {}
    for name, part in watched.items():
        if name in late:
            part.wait(10.0)  # its last job ends before the caller clears its folder
            markers[name] = Marker.of(late[name])
            continue
        try:
            values[name] = part.result()
        except DeadlineExceeded as fault:
            log.error("%s ran out of its own time", name)
            markers[name] = Marker.of("deadline", fault)
        except Exception as fault:
            log.exception("%s broke down", name)
            markers[name] = Marker.of("error", fault)
    return values, markers
