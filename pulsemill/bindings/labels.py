"""Steps that values are labelled by, for the SQL that the results are held against."""

from __future__ import annotations

FAR = 10**15

# Measure, lowest value, first value of the next step, label.
STEPS = [
    ("title length", 0, 30, "Short"),
    ("title length", 30, 80, "Medium"),
    ("comments", 0, 1, "No comments"),
    ("comments", 1, 6, "Low activity"),
    ("comments", 6, 21, "Medium activity"),
    ("days since push", -FAR, 7, "Very Active"),
    ("days since push", 7, 30, "Active"),
    ("days since push", 30, 90, "Moderate"),
    ("days since push", 90, 365, "Low Activity"),
    ("stars", 100, 1000, "Growing (100-1K stars)"),
    ("stars", 1000, 10000, "Popular (1K-10K stars)"),
    ("stars", 10000, FAR, "Very Popular (10K+ stars)"),
    ("hours to close", -FAR, 1, "Closed <1 hour"),
    ("hours to close", 1, 24, "Closed <1 day"),
    ("days to close", -FAR, 7, "Closed <1 week"),
    ("days to close", 7, 30, "Closed <1 month"),
    ("open days", 31, 91, "Long-running"),
    ("open days", 91, FAR, "Stale"),
]

# Label of a value without a step, unknown ones included.
OTHERWISE = {
    "title length": "Long",
    "comments": "High activity",
    "days since push": "Inactive",
    "stars": "Emerging (<100 stars)",
    "days to close": "Closed >1 month",
    "open days": "Active",
}

STEPS_SQL = "steps(measure, low, high, label) AS (VALUES " + ", ".join(map(str, STEPS)) + ")"


def join_step(alias: str, measure: str, value: str) -> str:
    """SQL that joins the step of ``value``."""
    return f"LEFT JOIN steps {alias} ON {alias}.measure = '{measure}' AND {value} >= {alias}.low AND {value} < {alias}.high"


def step_label(alias: str, measure: str) -> str:
    return f"coalesce({alias}.label, '{OTHERWISE[measure]}')"


def join_resolution(created: str, closed: str) -> str:
    """SQL that joins the steps for how long an issue took, by hours and by days."""
    hours, days = f"datediff('hour', {created}, {closed})", f"datediff('day', {created}, {closed})"
    return join_step("hours", "hours to close", hours) + " " + join_step("days", "days to close", days)


def resolution_label(closed: str) -> str:
    """SQL for the label of ``join_resolution``: by hours within the first day, by days after it."""
    return f"CASE WHEN {closed} IS NULL THEN 'Open' ELSE coalesce(hours.label, {step_label('days', 'days to close')}) END"


def rate(part: str, whole: str) -> str:
    """SQL for a ratio to four places, 0 without a whole."""
    return f"CASE WHEN {whole} > 0 THEN round(CAST({part} AS DOUBLE) / {whole}, 4) ELSE 0.0 END"
