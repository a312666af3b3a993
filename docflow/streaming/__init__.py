"""Conversion of files as they arrive."""

from docflow.sources.datasource import stream_every_document
from docflow.streaming.files import missing_documents, stream_documents, stream_results

__all__ = ["missing_documents", "stream_documents", "stream_every_document", "stream_results"]
