"""Readers for raw files, layered tables and the driver's fixture tables."""

from terrace.sources.files import (  # noqa: F401
    MissingTableError,
    read_source,
    read_table,
    require_table,
    table_exists,
    try_read_table,
)
