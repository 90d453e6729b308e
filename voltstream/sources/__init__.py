"""Readers and writers: raw OCPP / master CSV, parquet tables, snapshot tables."""
