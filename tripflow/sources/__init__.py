"""Inputs: test-table fixtures mapped onto the trip domain, parquet/CSV scans,
file streams, schema evolution and rescued data."""
