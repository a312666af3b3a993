"""Converters that misbehave, as factories; the document's text says how."""

import os
import signal
import sys
import time

from docflow.operators.convert import Converted


def well_behaved():
    return lambda path, content: Converted(content.upper(), 3, 0.93, {"k": 1})


def misbehaving():
    def convert(path, content):
        if content == "raise":
            raise ValueError("bad\nfile")
        if content == "hang":
            while True:
                try:
                    time.sleep(30)
                except Exception:
                    pass
        if content == "crash":
            os.kill(os.getpid(), signal.SIGSEGV)
        if content == "exit":
            sys.exit(3)
        if content == "none":
            return None
        if content == "surrogate":
            return "a\ud800b"
        if content == "nulls":
            return Converted("n", None, None, None)
        return content

    return convert


def misbehaving_on_bytes():
    convert = misbehaving()
    return lambda path, content: convert(path, content.decode())


def never_built():
    raise RuntimeError("no model")


def crash_when_built():
    os.kill(os.getpid(), signal.SIGKILL)


def counting():
    """Every conversion tells which build of the converter did it."""
    token = f"{os.getpid()}-{time.monotonic_ns()}"
    return lambda path, content: token


def opens_path():
    def convert(path, content):
        assert content is None
        with open(path, "rb") as file:
            return str(len(file.read()))

    return convert


def slow_once_in_process():
    """Takes a while for some texts, never returns for others, and tells its process."""

    def convert(path, content):
        if content == "hang":
            time.sleep(1000)
        if content == "slow":
            time.sleep(1)
        if content == "odd":
            time.sleep(1)
            return Converted("odd", document_metadata=(i for i in "not to be sent"))
        return str(os.getpid())

    return convert


def dies_when_long():
    parent = os.getpid()

    def convert(path, content):
        if content == "die":
            time.sleep(1)
            os.kill(os.getpid(), signal.SIGKILL)
        return str(parent)

    return convert


def telling_its_time():
    used = time.process_time()

    def convert(path, content):
        if content == "crash":
            os.kill(os.getpid(), signal.SIGKILL)
        return str(used)

    return convert
