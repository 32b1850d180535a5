"""Sinks: CSV export of one table or of a list of tables."""

from starloom.sinks.csv import export_all, export_csv, read_exported_csv

__all__ = ["export_all", "export_csv", "read_exported_csv"]
