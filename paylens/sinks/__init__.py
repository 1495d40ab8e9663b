"""Sinks: Parquet and CSV writers, analysis result tables, shared scratch paths."""

from paylens.sinks.writers import (
    checkpoint_root,
    scratch_path,
    write_csv,
    write_parquet,
    write_results,
)

__all__ = ["checkpoint_root", "scratch_path", "write_csv", "write_parquet", "write_results"]
