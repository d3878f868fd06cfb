from tablewright.plans.flows import (
    aggregate_and_process,
    clean_table,
    flatten_folder,
    merge_tables,
    slim_table,
)

__all__ = ["aggregate_and_process", "clean_table", "flatten_folder", "merge_tables", "slim_table"]
