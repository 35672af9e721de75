from tidemark.operators.digests import digest_diff, write_digested
from tidemark.operators.intervals import point_in_time
from tidemark.operators.ordered import latest_per_key
from tidemark.operators.scd2 import (
    scd2_apply,
    scd2_as_of,
    scd2_check,
    scd2_current,
    scd2_extend,
    scd2_from_history,
    scd2_initial,
    scd2_merge,
    scd2_point_in_time,
    scd2_splice,
    scd2_splice_log,
    snapshot_diff,
)

__all__ = [
    "digest_diff", "latest_per_key", "point_in_time", "scd2_apply", "scd2_as_of", "scd2_check",
    "scd2_current", "scd2_extend", "scd2_from_history", "scd2_initial", "scd2_merge",
    "scd2_point_in_time", "scd2_splice", "scd2_splice_log", "snapshot_diff", "write_digested",
]
