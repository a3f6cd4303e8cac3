"""Column expressions and small DataFrame helpers shared by the operators."""

from stopwise.functions.columns import (
    calendar_columns,
    event_key,
    local_hour,
    on_time_flag,
    round_half_away,
    shifted_hour,
)
from stopwise.functions.numbering import number_rows, number_within, running_total

__all__ = [
    "calendar_columns",
    "event_key",
    "local_hour",
    "number_rows",
    "number_within",
    "on_time_flag",
    "round_half_away",
    "running_total",
    "shifted_hour",
]
