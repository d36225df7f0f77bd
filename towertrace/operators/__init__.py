"""Operators: stays from events, overlap and contacts, checks, reshaping."""

from .intervals import (
    intervals, robust, adjacent, ordinal, first_exit, with_previous, with_ordinal, RULES,
)
from .asof import asof_join
from .groups import apply_sorted
from .contacts import (
    event_cuts, find_contacts, overlap_counts, overlapping_stays, subject_events, tag_subjects,
)

__all__ = [
    "intervals", "robust", "adjacent", "ordinal", "first_exit", "with_previous",
    "with_ordinal", "RULES", "subject_events", "tag_subjects", "overlapping_stays",
    "find_contacts", "overlap_counts", "event_cuts", "asof_join", "apply_sorted",
]
