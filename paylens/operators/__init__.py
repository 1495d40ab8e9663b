"""DataFrame -> DataFrame operators. All lazy; none runs an action, but for ``apply_changes``, which writes."""

from paylens.operators.anomaly import amount_stats, detect_anomalies, score_amounts
from paylens.operators.buckets import ordered_buckets
from paylens.operators.clean import clean
from paylens.operators.duplicates import near_in_time_duplicates, without_duplicates
from paylens.operators.quality import quality_report, quality_report_dict
from paylens.operators.robust import group_quantile, robust_anomalies, robust_statistics
from paylens.operators.rollups import (
    aggregation_sets,
    aggregations,
    aggregations_dict,
    by_currency,
    by_msg_type,
    country_statistics,
    daily_volumes,
    overall_stats,
    top_parties,
    top_receivers,
    top_senders,
    valid_only,
    with_countries,
)
from paylens.operators.sequence import sender_sequence
from paylens.operators.snapshots import apply_changes, multiset_difference
from paylens.operators.states import daily_states, merge_states, state_figures
from paylens.operators.temporal_joins import asof_join, interval_join
from paylens.operators.validate import validate
from paylens.operators.velocity import sender_velocity

__all__ = [
    "amount_stats", "detect_anomalies", "score_amounts", "clean", "quality_report",
    "quality_report_dict", "aggregation_sets", "aggregations", "aggregations_dict", "by_currency", "by_msg_type",
    "country_statistics", "daily_volumes", "overall_stats", "top_parties", "top_receivers",
    "top_senders", "valid_only", "with_countries", "validate", "sender_sequence",
    "ordered_buckets", "near_in_time_duplicates", "without_duplicates", "asof_join", "interval_join", "sender_velocity",
    "apply_changes", "multiset_difference", "daily_states", "merge_states", "state_figures",
    "group_quantile", "robust_anomalies", "robust_statistics",
]
