"""Command-line entry points (for ``spark-submit`` or ``python -m paylens.plans.cli``).

    ingest <input_csv> <output_parquet> [partition_columns]
        partition columns comma separated, default year,month,day
    analyze <processed_parquet> <output_base>
    generate <output_csv> [rows] [seed]
        synthetic payments as headed CSV, 10,000 rows by default

Exit code 1 on misuse or failure; the session is always stopped.
"""

from __future__ import annotations

import json
import logging
import sys

from paylens.config import DEFAULT_PARTITION_COLUMNS
from paylens.session import build_session

log = logging.getLogger("paylens")

INGEST_USAGE = "usage: ingest <input_csv_path> <output_parquet_path> [partition_columns]"
GENERATE_USAGE = "usage: generate <output_csv_path> [rows] [seed]"
ANALYZE_USAGE = "usage: analyze <processed_parquet_path> <output_path>"


def ingest_main(argv: list[str]) -> int:
    if len(argv) < 2:
        print(INGEST_USAGE)
        return 1
    input_path, output_path = argv[0], argv[1]
    partition_by = argv[2].split(",") if len(argv) > 2 else list(DEFAULT_PARTITION_COLUMNS)
    spark = build_session("paylens-ingest")
    try:
        from paylens.plans.ingest import run_ingest

        _, report, aggs = run_ingest(spark, input_path, output_path, partition_by)
        print(json.dumps({"quality_report": report, "aggregations": aggs}, default=str))
        return 0
    except Exception:  # noqa: BLE001 - a job reports any failure through its exit code
        log.exception("ingest failed")
        return 1
    finally:
        spark.stop()


def analysis_main(argv: list[str]) -> int:
    if len(argv) != 2:
        print(ANALYZE_USAGE)
        return 1
    spark = build_session("paylens-analysis")
    try:
        from paylens.plans.analysis import run_analysis

        print(json.dumps(run_analysis(spark, argv[0], argv[1])))
        return 0
    except Exception:  # noqa: BLE001
        log.exception("analysis failed")
        return 1
    finally:
        spark.stop()


def generate_main(argv: list[str]) -> int:
    if not 1 <= len(argv) <= 3 or not all(a.isdigit() for a in argv[1:]):
        print(GENERATE_USAGE)
        return 1
    spark = build_session("paylens-generate")
    try:
        from paylens.sinks.writers import write_csv
        from paylens.sources.generator import generate_payments

        rows, seed = int(argv[1]) if len(argv) > 1 else 10_000, int(argv[2]) if len(argv) > 2 else 42
        write_csv(generate_payments(spark, rows, seed=seed), argv[0])
        return 0
    except Exception:  # noqa: BLE001
        log.exception("generate failed")
        return 1
    finally:
        spark.stop()


def main(argv: list[str] | None = None) -> int:
    argv = list(sys.argv[1:] if argv is None else argv)
    commands = {"ingest": ingest_main, "analyze": analysis_main, "generate": generate_main}
    if not argv or argv[0] not in commands:
        print(__doc__)
        return 1
    return commands[argv[0]](argv[1:])


if __name__ == "__main__":
    sys.exit(main())
