"""Where results go."""

from docflow.sinks.jsonl import write_chunk, write_jsonl, write_results
from docflow.sinks.manifest import Manifest, read_results
from docflow.sinks.publish import recover, replace_folder

__all__ = ["Manifest", "read_results", "recover", "replace_folder", "write_chunk", "write_jsonl", "write_results"]
