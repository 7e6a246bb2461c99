"""Scans: driver parquet tables, fixtures derived from them, and file readers."""
