"""docflow: large collections of documents to structured text, as Spark jobs."""

from docflow.config import ConvertConfig
from docflow.operators import *  # noqa: F403
from docflow.plans.convert import convert_directory, convert_one, convert_pages, convert_valid
from docflow.plans.job import JobReport, run_job
from docflow.session import build_session, scratch_dir, ship_package
from docflow.sinks import read_results, write_jsonl, write_results
from docflow.sources import *  # noqa: F403
from docflow.streaming import missing_documents, stream_documents, stream_every_document, stream_results

__version__ = "0.1.0"
