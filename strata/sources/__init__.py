"""Scans, sinks, settings and the fixture views over the driver's test tables."""

from strata.sources.files import (file_contract, scan_landed,
                                  source_id, typed_rows)
from strata.sources.tables import (read_optional, read_table, settings_frame,
                                   settings_lookup)
from strata.sources.writers import append_evolved, write_csv, write_table

__all__ = [
    "file_contract", "scan_landed", "source_id", "typed_rows",
    "read_optional", "read_table", "settings_frame", "settings_lookup",
    "append_evolved", "write_csv", "write_table",
]
