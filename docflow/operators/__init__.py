"""What is done with documents: validate, convert, report, take apart."""

from docflow.operators.convert import Converted, convert_documents, convert_html, decode_content, result_struct
from docflow.operators.results import (
    failures,
    failures_report,
    flatten_results,
    preview,
    status_counts,
    successes,
    summarize,
)
from docflow.operators.structure import document_blocks, document_tables
from docflow.operators.validate import (
    Rule,
    ends_with,
    exists,
    file_rules,
    has_suffix,
    is_file,
    not_empty,
    validate,
)

__all__ = [
    "Converted",
    "Rule",
    "convert_documents",
    "convert_html",
    "decode_content",
    "document_blocks",
    "document_tables",
    "ends_with",
    "exists",
    "failures",
    "failures_report",
    "file_rules",
    "flatten_results",
    "has_suffix",
    "is_file",
    "not_empty",
    "preview",
    "result_struct",
    "status_counts",
    "successes",
    "summarize",
    "validate",
]
