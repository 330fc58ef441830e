"""Sources and sinks: delimited text, term lists, CSV tables, staged parquet."""

from quarry.sources.delimited import (  # noqa: F401
    read_csv_table,
    read_delimited,
    read_delimited_rejects,
    read_lines,
    read_terms,
    sort_out,
    split_fields,
)
from quarry.sources.sinks import (  # noqa: F401
    format_report,
    recover_folder,
    replace_folder,
    stage,
    stage_observed,
    to_lines,
    write_csv,
    write_delimited,
)
