"""Running one plug-in converter safely: exceptions, time limit, child process.

These helpers run inside a Spark task, one document at a time; those that take long go on beside it.
"""

from __future__ import annotations

import contextlib
import math
import multiprocessing
import signal
import time
import traceback
from collections.abc import Iterator
from multiprocessing import connection as connections

from pyspark import cloudpickle

from docflow.config import ConvertConfig
from docflow.sources.filesystem import Unread


class DocumentTimeout(BaseException):
    """Raised inside a converter whose time is up.

    Not an ``Exception``, so a converter that catches everything cannot swallow it.
    """


def _waited() -> float:
    """Seconds for which this process was ready and had no core, as far as the system tells."""
    try:
        with open("/proc/self/schedstat") as file:
            return int(file.read().split()[1]) / 1e9
    except (OSError, ValueError, IndexError):
        return 0.0


@contextlib.contextmanager
def time_limit(seconds: float | None, fair: bool = False):
    """Interrupt the block after ``seconds``; works for anything but native code.

    With ``fair``, time spent waiting for a core does not count.
    """
    if not seconds:
        yield
        return
    start, waited = time.monotonic(), _waited() if fair else 0.0

    def on_alarm(signum, frame):
        left = seconds - (time.monotonic() - start - (_waited() - waited)) if fair else 0
        if left > 0.001:
            signal.setitimer(signal.ITIMER_REAL, left)
        else:
            raise DocumentTimeout(f"timed out after {seconds:g} s")

    previous = signal.signal(signal.SIGALRM, on_alarm)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, previous)


def failure_text(path: str, message: str, trace: str | None = None) -> str:
    # Fixed value: the format of the error text of a failed conversion.
    text = f"Error processing {path}: {message}"
    return f"{text}\nTraceback: {trace}" if trace else text


class ConverterNotBuilt(RuntimeError):
    """The converter cannot be built here; the task fails, and Spark tries it elsewhere."""


@contextlib.contextmanager
def content_of(content) -> Iterator[list]:
    """A list with the content; that of a file which is not read yet is read first, outside any document's time."""
    if isinstance(content, Unread):
        with content.held() as held:
            yield held
    else:
        yield [content]


class InProcess:
    """Builds the converter on first use and calls it in this process."""

    def __init__(self, pickled: bytes, config: ConvertConfig) -> None:
        self._pickled, self._timeout_s = pickled, config.timeout_s
        self._converter = None

    def build(self) -> None:
        if self._converter is None:
            try:
                self._converter = cloudpickle.loads(self._pickled)()
            except (Exception, SystemExit) as error:
                raise ConverterNotBuilt(f"cannot build converter: {error}") from error

    def __call__(self, path: str, content, fair: bool = False) -> tuple[object, str | None]:
        """``(result, None)`` or ``(None, error text)``."""
        self.build()
        try:
            with content_of(content) as held, time_limit(self._timeout_s, fair):
                return self._converter(path, held.pop()), None
        except DocumentTimeout as error:
            return None, failure_text(path, str(error), traceback.format_exc())
        except (Exception, SystemExit) as error:
            return None, failure_text(path, str(error), traceback.format_exc())

    def soon(self, path: str, content, seconds: float) -> tuple[object, str | None] | None:
        """The same, or None if it takes more than ``seconds``."""
        self.build()
        try:
            with content_of(content) as held, time_limit(seconds):
                return self._converter(path, held.pop()), None
        except DocumentTimeout:
            return None
        except (Exception, SystemExit) as error:
            return None, failure_text(path, str(error), traceback.format_exc())

    def close(self) -> None:
        self._converter = None


def _serve(connection, pickled: bytes, timeout_s: float | None = None) -> None:
    """Body of the child process: convert what comes in until the pipe closes.

    Without ``timeout_s`` the parent keeps the time and ends the child. With it, a result
    that cannot be sent is answered by None.
    """
    convert = InProcess(pickled, ConvertConfig(timeout_s=timeout_s))
    try:
        convert.build()
    except ConverterNotBuilt as error:
        connection.send_bytes(str(error).encode("utf-8", "backslashreplace"))
        return
    connection.send_bytes(b"")
    while True:
        try:
            path, content = connection.recv()
        except EOFError:
            return
        with content_of(content) as held:
            if isinstance(content, Unread):
                # The document's time starts now.
                connection.send_bytes(b"")
            result = convert(path, held.pop(), fair=True)
        try:
            answer = cloudpickle.dumps(result)
        except Exception as error:
            text = failure_text(path, str(error), traceback.format_exc())
            answer = cloudpickle.dumps(None if timeout_s else (None, text))
        connection.send_bytes(answer)


#: Imported before children are forked. ``multiprocessing`` runs the program's module in each
#: child anew, and that of Spark's workers imports most of PySpark.
PRELOADED = [__name__, "pyspark.serializers", "pyspark.worker"]


class InChild:
    """Calls the converter in a child process, replaced after a crash or a timeout."""

    def __init__(self, pickled: bytes, config: ConvertConfig, own_limit: bool = False) -> None:
        self._pickled, self._timeout_s, self._build_s = pickled, config.timeout_s, config.build_timeout_s
        self._own_s = config.timeout_s if own_limit else None
        # Children are forked from a clean server process, one per Python worker:
        # replacing a child takes milliseconds and inherits nothing from the worker.
        self._context = multiprocessing.get_context("forkserver")
        self._context.set_forkserver_preload(PRELOADED)
        self._child = self._connection = None

    def _start(self) -> None:
        """Start a child and wait until its converter is built, outside any document's time."""
        self._connection, remote = self._context.Pipe()
        self._child = self._context.Process(
            target=_serve, args=(remote, self._pickled, self._own_s), daemon=True
        )
        self._child.start()
        remote.close()
        try:
            if self._connection.poll(self._build_s or None):
                problem = self._connection.recv_bytes().decode()
            else:
                problem = f"cannot build converter: timed out after {self._build_s:g} s"
        except (EOFError, OSError):
            problem = f"cannot build converter: {self._exit_text()}"
        if problem:
            self.close()
            raise ConverterNotBuilt(problem)

    def _exit_text(self) -> str:
        self._child.join(5)
        return f"converter process ended with exit code {self._child.exitcode}"

    def __call__(self, path: str, content) -> tuple[object, str | None]:
        if self._child is None:
            self._start()
        try:
            self._connection.send((path, content))
            if isinstance(content, Unread):
                self._connection.recv_bytes()
        except (EOFError, OSError):
            return self._failed(path, self._exit_text())
        return self._answer(path, self._timeout_s or None)

    def _answer(self, path: str, wait_s: float | None) -> tuple[object, str | None]:
        try:
            if self._connection.poll(wait_s):
                return cloudpickle.loads(self._connection.recv_bytes())
            message = f"timed out after {self._timeout_s:g} s"
        except (EOFError, OSError):
            message = self._exit_text()
        return self._failed(path, message)

    def _failed(self, path: str, message: str) -> tuple[None, str]:
        self.close()
        return None, failure_text(path, message)

    def close(self) -> None:
        if self._child is not None:
            self._child.kill()
            self._child.join()
            self._connection.close()
            self._child = self._connection = None


class _Started(InChild):
    """A child that keeps the time itself, with the document it is at."""

    at: tuple | None = None

    def begin(self, tag, path: str, content, deadline: float) -> None:
        if self._child is None:
            self._start()
        self.at = tag, path, content, deadline
        with contextlib.suppress(OSError):
            # A child that is gone is told by its answer.
            self._connection.send((path, content))

    @property
    def connection(self):
        return self._connection

    def end(self) -> tuple | None:
        _, path, _, deadline = self.at
        return self._answer(path, max(0.0, deadline - time.monotonic()))

    def has_read(self, limit_s: float) -> bool:
        """Whether it only tells that it has read its file, so that its time starts."""
        tag, path, content, deadline = self.at
        if not isinstance(content, Unread) or deadline < math.inf:
            return False
        self.at = tag, path, content, time.monotonic() + limit_s
        with contextlib.suppress(EOFError, OSError):
            self._connection.recv_bytes()
            return True
        return False


class Overtime:
    """Converts in this process; what takes long goes on in child processes, several at once.

    A document that a tenth of its time was not enough for begins again in a child, with
    all its time, while this process converts others: documents that hang wait together.
    No more than ``most`` do so, with ``MOST_HELD`` bytes or one document. A child keeps the
    time that it does not wait for a core. What no child can be built for, or what cannot
    be sent back, is converted here.
    """

    #: The part of its time after which a document counts as long.
    PART = 10
    #: Bytes of the documents that are in child processes.
    MOST_HELD = 64 << 20

    def __init__(self, pickled: bytes, config: ConvertConfig) -> None:
        self._here = InProcess(pickled, config)
        self._pickled, self._config = pickled, config
        self._most, self._limit = config.overtime, config.timeout_s
        self._children: list[_Started] = []

    def begin(self, tag, path: str, content) -> Iterator[tuple]:
        """``tag, result, error`` of documents that are done: this one, or earlier ones."""
        if not (self._most and self._limit):
            yield tag, *self._here(path, content)
            return
        done = self._here.soon(path, content, self._limit / self.PART)
        if done is not None:
            yield tag, *done
        else:
            yield from self._set_aside(tag, path, content)
        yield from self._finished(0)

    def _longest(self) -> float:
        """Seconds in which a document has had its time, also if all of them want the same core."""
        return self._limit * (self._most + 2)

    def _busy(self) -> list[_Started]:
        return [c for c in self._children if c.at]

    def _set_aside(self, tag, path: str, content) -> Iterator[tuple]:
        size = lambda c: c.size if isinstance(c, Unread) else len(c or "")
        while (busy := self._busy()) and (len(busy) >= self._most or size(content) + sum(size(c.at[2]) for c in busy) > self.MOST_HELD):
            yield from self._finished(None)
        child = next((c for c in self._children if not c.at), None)
        if child is None:
            child = _Started(self._pickled, self._config, own_limit=True)
            self._children.append(child)
        deadline = math.inf if isinstance(content, Unread) else time.monotonic() + self._longest()
        try:
            child.begin(tag, path, content, deadline)
        except (ConverterNotBuilt, OSError):
            self._children.remove(child)
            self._most = len(self._children)
            yield tag, *self._here(path, content)

    def _finished(self, wait_s: float | None) -> Iterator[tuple]:
        """Of the documents in child processes those that are done, after ``wait_s`` or, for None, at least one."""
        busy = self._busy()
        if not busy:
            return
        now = time.monotonic()
        first = max(0.0, min(c.at[3] for c in busy) - now)
        wait_s = wait_s if wait_s is not None else first if first < math.inf else None
        ready = connections.wait([c.connection for c in busy], wait_s)
        for child in busy:
            if child.connection in ready and child.has_read(self._longest()):
                continue
            if child.connection in ready or child.at[3] <= time.monotonic():
                tag, path, content, _ = child.at
                outcome = child.end()
                child.at = None
                yield tag, *(self._here(path, content) if outcome is None else outcome)

    def rest(self) -> Iterator[tuple]:
        """What is still in child processes, once it is done."""
        while self._busy():
            yield from self._finished(None)

    def drop(self) -> None:
        """Ends the documents of a task that is given up."""
        for child in self._busy():
            child.at = None
            child.close()

    def close(self) -> None:
        for child in self._children:
            child.close()
        self._children = []
        self._here.close()


class Isolated:
    """Converts one document after another in a child process."""

    def __init__(self, pickled: bytes, config: ConvertConfig) -> None:
        self._child = InChild(pickled, config)

    def begin(self, tag, path: str, content) -> Iterator[tuple]:
        yield tag, *self._child(path, content)

    def rest(self) -> Iterator[tuple]:
        yield from ()

    def drop(self) -> None:
        pass

    def close(self) -> None:
        self._child.close()


_held: tuple[tuple, Overtime | Isolated] | None = None


def worker_converter(pickled: bytes, config: ConvertConfig) -> Overtime | Isolated:
    """The converter of this Python worker, kept from task to task.

    A worker holds one; another factory or other options replace it.
    """
    global _held
    key = (pickled, config)
    if _held is None or _held[0] != key:
        if _held is not None:
            _held[1].close()
        _held = key, (Isolated if config.isolate else Overtime)(pickled, config)
    return _held[1]
