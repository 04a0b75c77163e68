"""Sources and sinks: raw JSON landing, recipe CSV, Parquet logs, tables,
text reports."""

from pricelens.sources.raw import (read_raw, flatten_response, stamp_run,
                                   write_landing, write_runs, read_landing, load_date,
                                   quarantine, read_checked)
from pricelens.sources.published import compact, publish_dates, read_published, vacuum
from pricelens.sources.tables import (read_recipe, read_log, write_parquet,
                                      register_tables)
from pricelens.sources.report import merge_report, read_report, write_report

__all__ = ["read_raw", "flatten_response", "stamp_run", "write_landing", "write_runs",
           "read_landing", "load_date", "read_recipe", "read_log",
           "write_parquet", "register_tables", "write_report", "compact", "publish_dates",
           "read_published", "vacuum", "quarantine", "read_checked",
           "merge_report", "read_report"]
