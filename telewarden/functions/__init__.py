"""Column builders shared by the operators."""

from .readings import (
    ISO_TIMESTAMP,
    NULL_TOKENS,
    event_time,
    is_number,
    null_tokens,
    slice_of,
)
from .text import fmt_value, quoted
from .thresholds import (
    PRIORITY_RANK,
    is_known_priority,
    normal_priority,
    op_case,
    op_column,
    priority_rank,
)

__all__ = [
    "ISO_TIMESTAMP",
    "NULL_TOKENS",
    "PRIORITY_RANK",
    "event_time",
    "fmt_value",
    "is_known_priority",
    "is_number",
    "normal_priority",
    "null_tokens",
    "op_case",
    "op_column",
    "priority_rank",
    "quoted",
    "slice_of",
]
