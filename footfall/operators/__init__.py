"""DataFrame-to-DataFrame operators. None of them runs a Spark action."""

from footfall.operators.cohorts import assign_cohorts
from footfall.operators.funnel import first_touch, funnel, funnel_from_weeks, user_weeks
from footfall.operators.quality import (
    CHECKS,
    Check,
    accepted_values,
    not_null,
    require_passing,
    run_checks,
    unique,
)
from footfall.operators.retention import retention, retention_from_weeks
from footfall.operators.sampling import sample_fidelity, sample_users
from footfall.operators.sessions import sessionize
from footfall.operators.sketches import active_users, daily_sketches, relative_error
from footfall.operators.staging import stage_events, staging_sql

__all__ = [
    "CHECKS",
    "Check",
    "accepted_values",
    "active_users",
    "assign_cohorts",
    "daily_sketches",
    "first_touch",
    "funnel",
    "funnel_from_weeks",
    "not_null",
    "relative_error",
    "require_passing",
    "retention",
    "retention_from_weeks",
    "run_checks",
    "sample_fidelity",
    "sample_users",
    "sessionize",
    "stage_events",
    "staging_sql",
    "unique",
    "user_weeks",
]
