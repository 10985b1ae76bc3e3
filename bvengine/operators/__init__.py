"""Generic DataFrame -> DataFrame operators.

They take column names as parameters, never the domain's, so they run on any
table; the business rules in ``bvengine.plans`` compose them.
"""

from .aggregate import flag_pivot, has_all
from .gates import blocked_keys, exclude_unless_stale, hot_key_salt, log_state, merge_log_state
from .joins import SALTS, dealt_join, hot_keys, join_on_first_key, left_join_on, qcol, role_join, salt_of, with_member_flag
from .limit import top_distinct
from .membership import attach_flags, member_summary
from .window import latest_per_key, row_number_desc

__all__ = [
    "SALTS",
    "attach_flags",
    "blocked_keys",
    "dealt_join",
    "exclude_unless_stale",
    "flag_pivot",
    "has_all",
    "hot_key_salt",
    "hot_keys",
    "join_on_first_key",
    "latest_per_key",
    "left_join_on",
    "log_state",
    "member_summary",
    "merge_log_state",
    "qcol",
    "role_join",
    "row_number_desc",
    "salt_of",
    "top_distinct",
    "with_member_flag",
]
