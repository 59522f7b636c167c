from pulsemill.sources.config import enabled_repositories, extraction_settings
from pulsemill.sources.landing import enrich, raw_documents, row_documents, write_landing
from pulsemill.sources.raw import (
    array_rejects,
    dated_glob,
    documents_from_text,
    line_rejects,
    read_landing,
    read_raw_arrays,
    read_raw_dates,
    read_raw_lines,
    rejected_files,
    with_path_parts,
)
from pulsemill.sources.tables import (
    consumed_files,
    files_of,
    merge_partitions,
    not_consumed,
    publish_table,
    publish_view,
    read_table,
    replace_partitions,
    stored,
)

__all__ = [
    "array_rejects",
    "consumed_files",
    "dated_glob",
    "documents_from_text",
    "enabled_repositories",
    "enrich",
    "extraction_settings",
    "files_of",
    "line_rejects",
    "merge_partitions",
    "not_consumed",
    "publish_table",
    "publish_view",
    "raw_documents",
    "read_landing",
    "read_raw_arrays",
    "read_raw_dates",
    "read_raw_lines",
    "read_table",
    "rejected_files",
    "replace_partitions",
    "row_documents",
    "stored",
    "with_path_parts",
    "write_landing",
]
