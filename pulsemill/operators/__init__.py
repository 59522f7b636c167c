from pulsemill.operators.dedup import latest_by_key
from pulsemill.operators.distinct import conditional_distinct_counts
from pulsemill.operators.ranking import HOT_ROWS, sequence_within, top_n_within
from pulsemill.operators.spine import date_spine, missing_dates
from pulsemill.operators.upsert import replace_where_matched, upsert

__all__ = [
    "HOT_ROWS",
    "conditional_distinct_counts",
    "date_spine",
    "latest_by_key",
    "missing_dates",
    "replace_where_matched",
    "sequence_within",
    "top_n_within",
    "upsert",
]
