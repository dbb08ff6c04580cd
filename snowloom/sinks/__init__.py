from snowloom.sinks.commits import Commit, Conflict, at
from snowloom.sinks.current import live, merge, tidy
from snowloom.sinks.tables import (
    Layout,
    append,
    batches,
    consumed,
    copy_tables,
    create_table,
    drop_partitions,
    ensure_database,
    extend,
    filled,
    holding,
    insert,
    land,
    mark_consumed,
    partitions_last,
    pending,
    pin,
    publish,
    replace_slice,
    retire,
    shown,
    stamp,
    unconsumed,
    versions,
)

__all__ = [
    "Commit", "Conflict", "Layout", "append", "at", "batches", "consumed", "copy_tables", "create_table", "drop_partitions", "ensure_database", "extend",
    "filled", "holding", "insert", "land", "live", "mark_consumed", "merge", "partitions_last", "pending", "pin", "publish",
    "replace_slice", "retire", "shown", "stamp", "tidy", "unconsumed", "versions",
]
