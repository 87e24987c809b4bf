"""Scans and sinks."""
from .tables import TABLES, nan_to_null, read_csv, read_table, write_predictions, write_stage  # noqa: F401
