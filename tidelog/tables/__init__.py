"""Keyed tables on plain parquet and catalog jobs."""
