"""Column functions: built-in expressions only, evaluated inside the JVM."""

from docflow.functions.html import html_to_markdown
from docflow.functions.metadata import build_metadata, file_metadata, stringify_metadata
from docflow.functions.pages import page_metadata
from docflow.functions.paths import file_name, suffix, url_path

__all__ = [
    "build_metadata",
    "file_metadata",
    "file_name",
    "html_to_markdown",
    "page_metadata",
    "stringify_metadata",
    "suffix",
    "url_path",
]
