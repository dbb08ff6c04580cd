from snowloom.sources.checked import Checked, plain_name, read_csv_checked, read_json_checked
from snowloom.sources.readers import (
    current,
    jdbc_options,
    read_code_list,
    read_csv,
    read_csv_text,
    read_jdbc,
    read_table,
    seed,
    table_or_none,
)

__all__ = [
    "Checked", "current", "jdbc_options", "plain_name", "read_csv_checked", "read_json_checked", "read_code_list", "read_csv", "read_csv_text", "read_jdbc", "read_table", "seed",
    "table_or_none",
]
