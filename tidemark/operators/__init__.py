from tidemark.operators.history import Merged, classify, first_versions, merge_open, merge_versions
from tidemark.operators.keys import number_rows
from tidemark.operators.latest import latest_of_few_repeats, latest_per_key, newer_than, newest_of_runs, past_mark
from tidemark.operators.skew import frequent_values, spread_left_join
from tidemark.operators.staging import right_side, stored
from tidemark.operators.temporal import join_as_of, long_histories

__all__ = [
    "Merged", "classify", "first_versions", "frequent_values", "join_as_of", "latest_of_few_repeats", "latest_per_key",
    "merge_open", "long_histories", "merge_versions", "newer_than", "newest_of_runs", "number_rows", "past_mark", "right_side", "spread_left_join", "stored",
]
