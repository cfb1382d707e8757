"""Scans and sources: driver tables, file streams, the message bus."""

from pulsehouse.sources.tables import read_table, table_path
from pulsehouse.sources.files import (csv_stream, file_stream, json_stream,
                                      parquet_stream, read_json, table_stream)
from pulsehouse.sources.bus import bus_available, bus_stream, write_envelopes

__all__ = ["read_table", "table_path", "csv_stream", "file_stream", "json_stream",
           "parquet_stream", "read_json", "table_stream", "bus_stream",
           "bus_available", "write_envelopes"]
