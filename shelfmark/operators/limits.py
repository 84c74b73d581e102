"""Calls with a time limit that also ends what never returns."""

from __future__ import annotations

import multiprocessing
import os
import pickle
import signal
from collections.abc import Callable
from multiprocessing.connection import Connection

# Seconds after which a child whose parent has gone ends by itself, beyond the limit of its call.
_ORPHANED = 30.0


class OverTime(Exception):
    """The time limit of a call is over."""


def _serve(work: Callable, load: Callable[[], object], calls: Connection, parents_end: Connection) -> None:
    parents_end.close()  # so that the end of the parent is the end of the pipe
    signal.signal(signal.SIGALRM, signal.SIG_DFL)
    try:
        load()
        calls.send(("ready", None))
        while True:
            seconds, args = calls.recv()
            signal.setitimer(signal.ITIMER_REAL, seconds + _ORPHANED)
            try:
                answer = "done", work(*args)
            except Exception as error:  # goes to the caller
                answer = "failed", _portable(error)
            signal.setitimer(signal.ITIMER_REAL, 0)
            calls.send(answer)
    except EOFError:
        pass
    except Exception as error:  # the model cannot be loaded
        calls.send(("failed", _portable(error)))
    finally:
        os._exit(0)  # nothing of the worker's own shutdown belongs here


def _portable(error: Exception) -> Exception:
    try:
        pickle.loads(pickle.dumps(error))
        return error
    except Exception:  # an error that cannot travel is told by its name
        return RuntimeError(f"{type(error).__name__}: {error}")


class LimitedCalls:
    """Calls ``work`` in a child process of this worker, which is killed when a call exceeds its limit.

    The child is forked on first use, so that ``work`` need not be pickled,
    and again after a kill. ``load`` runs in every new child before the first
    call and does not count towards its limit. Errors of ``work`` are raised here.
    """

    def __init__(self, work: Callable, load: Callable[[], object] = lambda: None) -> None:
        self._work, self._load = work, load
        self._child: multiprocessing.Process | None = None
        self._calls: Connection | None = None

    def __call__(self, seconds: float, *args: object) -> object:
        if self._child is None or not self._child.is_alive():
            self._start()
        try:
            self._calls.send((seconds, args))
            if not self._calls.poll(seconds):
                raise OverTime
            kind, answer = self._calls.recv()
        except OverTime:
            self.close()
            raise
        except (EOFError, OSError) as error:
            self.close()
            raise RuntimeError("the process of the call has ended") from error
        if kind == "failed":
            raise answer
        return answer

    def _start(self) -> None:
        self.close()
        fork = multiprocessing.get_context("fork")
        self._calls, theirs = fork.Pipe()
        self._child = fork.Process(target=_serve, args=(self._work, self._load, theirs, self._calls), daemon=True)
        self._child.start()
        theirs.close()
        try:
            kind, answer = self._calls.recv()
        except EOFError as error:
            self.close()
            raise RuntimeError("the process of the call has ended") from error
        if kind == "failed":
            self.close()
            raise answer

    def close(self) -> None:
        """End the child, whatever it does."""
        if self._child is not None:
            self._child.kill()
            self._child.join()
            self._child = None
        if self._calls is not None:
            self._calls.close()
            self._calls = None
