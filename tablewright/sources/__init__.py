from tablewright.sources.delimited import read_delimited
from tablewright.sources.readers import (
    read_csv_with_xml,
    read_folder_union,
    read_id_list,
    read_id_response_log,
    read_text_table,
    read_typed_csv,
    read_xml_batches,
    records_to_table,
)
from tablewright.sources.writers import (
    write_csv,
    write_cycle_dumps,
    write_id_list,
    write_tsv,
    write_with_column_mapping,
)

__all__ = [
    "read_csv_with_xml",
    "read_delimited",
    "read_folder_union",
    "read_id_list",
    "read_id_response_log",
    "read_text_table",
    "read_typed_csv",
    "read_xml_batches",
    "records_to_table",
    "write_csv",
    "write_cycle_dumps",
    "write_id_list",
    "write_tsv",
    "write_with_column_mapping",
]
