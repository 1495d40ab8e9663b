"""Class-style entry points with the method names users of the original
two-class payments job already call, mapped onto the lazy operators.

Differences, all deliberate: nothing here runs an action unless the method
returns Python values (reports, aggregates) or writes; ``as_of`` pins the
future-timestamp check. Without a session one is built. The rule attributes can be
overridden in a subclass or on an object.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from paylens.config import BIC_PATTERN, RAW_SCHEMA, VALID_CURRENCIES, VALID_MESSAGE_TYPES
from paylens.operators.anomaly import detect_anomalies
from paylens.operators.clean import clean
from paylens.operators.quality import quality_report_dict
from paylens.operators.rollups import aggregations_dict, country_statistics, daily_volumes, top_parties
from paylens.operators.validate import validate
from paylens.plans.analysis import analysis_results
from paylens.plans.ingest import run_ingest
from paylens.session import build_session
from paylens.sinks.writers import write_parquet, write_results
from paylens.sources.payments import read_payments_csv, read_processed


class PaymentIngestor:
    """Read, clean, validate, report on and write raw payment CSV."""

    VALID_CURRENCIES = list(VALID_CURRENCIES)
    VALID_MESSAGE_TYPES = list(VALID_MESSAGE_TYPES)
    BIC_PATTERN = BIC_PATTERN

    def __init__(self, spark: SparkSession | None = None, as_of: Column | str | None = None):
        self.spark, self.as_of = spark or build_session(), as_of

    def rules(self) -> dict[str, Any]:
        return {"currencies": self.VALID_CURRENCIES, "msg_types": self.VALID_MESSAGE_TYPES, "bic_pattern": self.BIC_PATTERN}

    def define_schema(self) -> StructType:
        return RAW_SCHEMA

    def read_csv(self, input_path: str) -> DataFrame:
        return read_payments_csv(self.spark, input_path)

    def transform_data(self, df: DataFrame) -> DataFrame:
        return clean(df, as_of=self.as_of)

    def validate_data(self, df: DataFrame) -> DataFrame:
        return validate(df, as_of=self.as_of, **self.rules())

    def generate_quality_report(self, df: DataFrame) -> dict[str, Any]:
        return quality_report_dict(df)

    def perform_aggregations(self, df: DataFrame) -> dict[str, Any]:
        return aggregations_dict(df)

    def write_parquet(self, df: DataFrame, output_path: str, partition_by: list[str] | None = None) -> None:
        write_parquet(df, output_path, partition_by)

    def process(self, input_path: str, output_path: str, partition_by: list[str] | None = None):
        return run_ingest(self.spark, input_path, output_path, partition_by, self.as_of, rules=self.rules())

    def stop(self) -> None:
        self.spark.stop()


class PaymentAnalyzer:
    """The four analyses (five result tables) over processed payments."""

    def __init__(self, spark: SparkSession | None = None):
        self.spark = spark or build_session()

    def read_processed_data(self, input_path: str) -> DataFrame:
        return read_processed(self.spark, input_path)

    def analyze_daily_volumes(self, df: DataFrame) -> DataFrame:
        return daily_volumes(df)

    def analyze_top_senders_receivers(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        return top_parties(df, "sender"), top_parties(df, "receiver")

    def analyze_country_statistics(self, df: DataFrame) -> DataFrame:
        return country_statistics(df)

    def detect_anomalies(self, df: DataFrame) -> DataFrame:
        return detect_anomalies(df)

    def write_analysis_results(self, df: DataFrame, output_path: str, analysis_name: str) -> None:
        write_results({analysis_name: df}, output_path, [analysis_name])

    def run_full_analysis(self, input_path: str, output_path: str) -> None:
        results = analysis_results(self.read_processed_data(input_path), ordered=False)
        write_results(results, output_path, parallel=len(results))

    def stop(self) -> None:
        self.spark.stop()
