"""Whole conversions and the batch job."""

from docflow.plans.convert import convert_directory, convert_one, convert_pages, convert_valid
from docflow.plans.job import JobReport, run_job

__all__ = ["JobReport", "convert_directory", "convert_one", "convert_pages", "convert_valid", "run_job"]
