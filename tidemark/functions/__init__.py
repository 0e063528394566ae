from tidemark.functions.columns import (
    FAR_FUTURE,
    conform,
    fingerprint,
    instant,
    line_total,
    or_label,
    proper_name,
    strip_suffix,
    with_calendar,
    with_suffix,
)

__all__ = [
    "FAR_FUTURE", "conform", "fingerprint", "instant", "line_total", "or_label",
    "proper_name", "strip_suffix", "with_calendar", "with_suffix",
]
