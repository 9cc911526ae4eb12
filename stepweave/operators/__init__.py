"""Operators on DataFrames: columns, lookups, publication, catalog, job log."""
