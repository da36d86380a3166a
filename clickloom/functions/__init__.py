"""Column expressions: hashing and id codec, time keys, text and array tools."""

from clickloom.functions.hashing import compact_id_decode, compact_id_encode, md5_hex, md5_signed64
from clickloom.functions.text import (
    before,
    after_last,
    blank_to_null,
    join_sorted,
    join_sorted_distinct,
    let,
    none_marker,
    safe_map,
)
from clickloom.functions.times import epoch_minute, hour_list, previous_day, previous_hour
from clickloom.functions.weights import affinity

__all__ = [
    "affinity",
    "after_last",
    "before",
    "blank_to_null",
    "compact_id_decode",
    "compact_id_encode",
    "epoch_minute",
    "hour_list",
    "join_sorted",
    "join_sorted_distinct",
    "let",
    "md5_hex",
    "md5_signed64",
    "none_marker",
    "previous_day",
    "previous_hour",
    "safe_map",
]
