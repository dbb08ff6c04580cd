from snowloom.functions.columns import (
    as_schema,
    blank_to_null,
    decoded,
    in_list,
    joined_when,
    null_safe_equal,
    remapped,
    row_hash,
    split_code,
    trimmed,
    typed,
)

__all__ = [
    "as_schema", "blank_to_null", "decoded", "in_list", "joined_when", "null_safe_equal", "remapped", "row_hash",
    "split_code", "trimmed", "typed",
]
