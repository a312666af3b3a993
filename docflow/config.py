"""Conversion options."""

from __future__ import annotations

from dataclasses import dataclass, replace

IMAGE_MODES = ("embedded", "referenced", "placeholder")


@dataclass(frozen=True)
class ConvertConfig:
    """Options of one conversion run.

    Frozen, so the copy that travels to the executors in a closure can never
    drift from the one the driver holds. An unknown option is a ``TypeError``.

    timeout_s
        Seconds one document may take in a plug-in converter; ``None`` or 0
        switches the limit off.
    image_mode
        ``embedded`` keeps images whose source is a ``data:`` URI,
        ``referenced`` keeps images whose source is any other URI, and
        ``placeholder`` keeps none. An image that is not kept leaves
        ``<!-- image -->`` behind.
    tables
        Render ``<table>`` as Markdown pipe tables; otherwise only the text of
        the cells is kept.
    drop_boilerplate
        Leave out ``<nav>`` and ``<footer>``.
    isolate
        Run a plug-in converter in a child process, so that a native crash or
        hang costs one document and not the job.
    overtime
        How many documents that a tenth of ``timeout_s`` was not enough for each Python
        worker converts beside others, each in a process with a converter of its own and
        with all its time. 0 keeps them in the worker, one after another.
    build_timeout_s
        Seconds a child process may take to build the converter; then the task
        fails and is tried elsewhere. ``None`` or 0 switches the limit off.
    page_metadata
        Let the built-in converter give ``document_metadata``: a page's title and its
        named ``<meta>`` contents, as JSON.
    """

    timeout_s: float | None = 300.0
    image_mode: str = "embedded"
    tables: bool = True
    drop_boilerplate: bool = True
    isolate: bool = False
    overtime: int = 8
    build_timeout_s: float | None = 600.0
    page_metadata: bool = False

    def __post_init__(self) -> None:
        if self.image_mode not in IMAGE_MODES:
            raise ValueError(f"image_mode must be one of {IMAGE_MODES}, not {self.image_mode!r}")
        if self.timeout_s is not None and self.timeout_s < 0:
            raise ValueError("timeout_s must not be negative")
        if self.overtime < 0:
            raise ValueError("overtime must not be negative")

    def updated(self, **options) -> ConvertConfig:
        """A copy with some options replaced."""
        return replace(self, **options)
