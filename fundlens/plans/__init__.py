"""Whole jobs: table mapping, batch load, incremental load, reports."""
