"""Scans: Parquet in three modes, text, and file inventory."""
