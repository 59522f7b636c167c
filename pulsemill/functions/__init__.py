from pulsemill.functions.buckets import flag, guarded_ratio, ladder, labelled
from pulsemill.functions.temporal import (
    as_of_date,
    as_of_timestamp,
    days_between,
    hours_between,
    months_between_boundaries,
    whole_months_between,
    years_between,
)
from pulsemill.functions.text import capture, coalesce_null, full_name_from_file_safe, surrogate_key
from pulsemill.functions.variants import array_length, field, is_present, member, subdocument, typed_document

__all__ = [
    "array_length",
    "as_of_date",
    "as_of_timestamp",
    "capture",
    "coalesce_null",
    "days_between",
    "field",
    "flag",
    "full_name_from_file_safe",
    "guarded_ratio",
    "hours_between",
    "is_present",
    "labelled",
    "ladder",
    "member",
    "months_between_boundaries",
    "subdocument",
    "surrogate_key",
    "typed_document",
    "whole_months_between",
    "years_between",
]
