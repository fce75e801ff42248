"""Readers: measurement views over the driver tables, text and parquet scans."""
