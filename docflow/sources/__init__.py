"""Where documents come from: folders, path lists, tables."""

from docflow.sources.content import opened, read_content, with_content
from docflow.sources.datasource import read_documents
from docflow.sources.dealing import deal_by_size
from docflow.sources.listing import (
    InputNotFound,
    NoDocuments,
    checked_documents,
    documents_from_paths,
    list_documents,
)
from docflow.sources.tables import balance, documents_from_table

__all__ = [
    "InputNotFound",
    "NoDocuments",
    "balance",
    "checked_documents",
    "deal_by_size",
    "documents_from_paths",
    "documents_from_table",
    "list_documents",
    "opened",
    "read_content",
    "read_documents",
    "with_content",
]
