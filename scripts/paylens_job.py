"""spark-submit launcher: ``spark-submit --py-files paylens.zip scripts/paylens_job.py ingest|analyze ...``."""

import sys

from paylens.plans.cli import main

if __name__ == "__main__":
    sys.exit(main())
