"""Jobs (ingest, analysis), the command line and the registered test-data queries."""

from paylens.plans.analysis import analysis_results, run_analysis
from paylens.plans.ingest import run_ingest, validated_from_raw, write_validated

__all__ = ["analysis_results", "run_analysis", "run_ingest", "validated_from_raw", "write_validated"]
