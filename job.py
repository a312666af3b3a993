"""spark-submit entry: ``spark-submit job.py --input <folder> --output <folder>``."""

from docflow.plans.job import main

if __name__ == "__main__":
    raise SystemExit(main())
