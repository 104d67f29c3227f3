"""Calls of a user's function with many in flight inside a task.

A task keeps a bounded window of calls in flight on threads, hands answers out in the order of the
questions, tries failures again by kind, gives up calls that outlast their deadline, and starts
calls no faster than its share of a rate that all tasks of the job have together.
"""

from __future__ import annotations

import asyncio
import heapq
import inspect
import queue
import sys
import threading
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

from pyspark import cloudpickle

# Workers get the code of this module with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Answer = tuple[str | None, str | None]


class Throttled(Exception):
    """A scorer raises this when the service asks for fewer calls; ``wait`` is what it asked for."""

    def __init__(self, message: str = "throttled", wait: float | None = None) -> None:
        super().__init__(message)
        self.wait = wait


class DeadlineMissed(Exception):
    """A call that gave no answer in time. It is tried again only if a retry class names it."""


@dataclass(frozen=True)
class Retry:
    """Failures of ``kinds`` are tried again, up to ``attempts`` calls, after waits that double."""

    kinds: tuple[type[BaseException], ...]
    attempts: int = 3
    first_wait: float = 2.0
    longest_wait: float = 10.0

    def wait(self, problem: BaseException, failures: int) -> float:
        asked = getattr(problem, "wait", None)
        return asked if asked is not None else min(
            self.first_wait * 2 ** (failures - 1), self.longest_wait)


@dataclass(frozen=True)
class CallPolicy:
    """How a scorer is called.

    ``in_flight`` calls at once in a task; ``deadline`` seconds for one call; ``retries`` by kind
    of failure, the first class that fits; ``calls_per_second`` of the whole job, dealt to its
    tasks in equal shares. A thread cannot be stopped: a call of a plain function that missed its
    deadline holds its thread until it returns, and once ``stuck`` calls of a task do so, further
    questions fail unasked until one returns. Coroutine functions are cancelled instead.
    """

    in_flight: int = 16
    deadline: float = 60.0
    retries: tuple[Retry, ...] = (Retry((Throttled,), attempts=6, longest_wait=60.0),
                                  Retry((ConnectionError, TimeoutError)))
    calls_per_second: float | None = None
    stuck: int = 64

    def retry(self, problem: BaseException, failures: int) -> float | None:
        """Seconds to wait before the next try, or None when there is none."""
        for kind in self.retries:
            if isinstance(problem, kind.kinds):
                return kind.wait(problem, failures) if failures < kind.attempts else None
        return None

    def pause(self, tasks: int) -> float:
        """Seconds between the starts of calls in each of ``tasks`` tasks that run at once."""
        return tasks / self.calls_per_second if self.calls_per_second else 0.0


class Calls:
    """The calls of one task."""

    def __init__(self, ask: Callable[[str], str], policy: CallPolicy, pause: float = 0.0,
                 ahead: int = 1024) -> None:
        self.policy, self.pause, self.ahead = policy, pause, max(ahead, policy.in_flight)
        self._ask, self._grace = ask, 0.0
        if inspect.iscoroutinefunction(ask):
            # coroutines end by themselves at the deadline; they get a moment to do so
            self._ask, self._grace = self._awaited(ask), 1.0
        self._jobs: queue.SimpleQueue = queue.SimpleQueue()
        self._done: queue.SimpleQueue = queue.SimpleQueue()
        self._running: dict[int, tuple[int, str, int, float]] = {}   # the oldest call comes first
        self._lost: set[int] = set()
        self._threads = self._calls = 0
        self._next_start = 0.0

    def _awaited(self, ask: Callable) -> Callable[[str], str]:
        deadline = self.policy.deadline

        def call(text: str) -> str:
            async def limited() -> str:
                try:
                    async with asyncio.timeout(deadline) as limit:
                        return await ask(text)
                except TimeoutError:
                    if limit.expired():
                        raise DeadlineMissed(f"no answer in {deadline:g} s") from None
                    raise
            return asyncio.run(limited())
        return call

    def _serve(self) -> None:
        while (job := self._jobs.get()) is not None:
            call, text = job
            try:
                self._done.put((call, self._ask(text), None))
            except BaseException as problem:  # handed to the task, which decides
                self._done.put((call, None, problem))

    def _start(self, index: int, text: str, failures: int, now: float) -> None:
        self._calls += 1
        self._running[self._calls] = (index, text, failures, now + self.policy.deadline)
        # threads of lost calls are busy until these return
        if self._threads - len(self._lost) < len(self._running):
            self._threads += 1
            threading.Thread(target=self._serve, daemon=True).start()
        self._jobs.put((self._calls, text))

    def answers(self, texts: Iterable[str]) -> Iterator[Answer]:
        """(reply, error) for each text, in order; at most ``ahead`` texts are read in advance."""
        source = iter(texts)
        answers: dict[int, Answer] = {}
        again: list[tuple[float, int, str, int]] = []
        read = given = 0
        more = True

        def failed(index: int, text: str, failures: int, problem: BaseException) -> None:
            if not isinstance(problem, Exception):
                raise problem               # a request to stop ends the task
            wait = self.policy.retry(problem, failures + 1)
            if wait is None:
                answers[index] = (None, str(problem))
            else:
                heapq.heappush(again, (time.monotonic() + wait, index, text, failures + 1))

        try:
            while more or self._running or again or given < read:
                while given in answers:
                    yield answers.pop(given)
                    given += 1
                now = time.monotonic()
                while len(self._running) < self.policy.in_flight and now >= self._next_start:
                    if again and again[0][0] <= now:
                        _, index, text, failures = heapq.heappop(again)
                    elif more and read - given < self.ahead:
                        text = next(source, None)
                        if text is None:
                            more = False
                            continue
                        index, failures, read = read, 0, read + 1
                        now = time.monotonic()
                    else:
                        break
                    if len(self._lost) >= self.policy.stuck:
                        answers[index] = (None, f"not asked: {len(self._lost)} calls hang")
                        continue
                    self._start(index, text, failures, now)
                    self._next_start = max(self._next_start, now) + self.pause
                if given in answers:
                    continue
                waits = []
                if self._running:
                    waits.append(next(iter(self._running.values()))[3] + self._grace)
                if len(self._running) < self.policy.in_flight:
                    if again:
                        waits.append(max(again[0][0], self._next_start))
                    if more and read - given < self.ahead:
                        waits.append(self._next_start)
                if not waits:
                    continue
                try:
                    call, reply, problem = self._done.get(
                        timeout=max(min(waits) - time.monotonic(), 0.0005))
                    if call in self._lost:
                        self._lost.discard(call)
                    else:
                        index, text, failures, _ = self._running.pop(call)
                        if problem is None:
                            answers[index] = (reply, None)
                        else:
                            failed(index, text, failures, problem)
                except queue.Empty:
                    pass
                now = time.monotonic()
                while self._running:
                    call, (index, text, failures, limit) = next(iter(self._running.items()))
                    if limit + self._grace > now:
                        break
                    del self._running[call]
                    self._lost.add(call)
                    failed(index, text, failures, DeadlineMissed(
                        f"no answer in {self.policy.deadline:g} s"))
        finally:
            for _ in range(self._threads):
                self._jobs.put(None)
